"""Registered queries: streaming (S1-S4), each an AvailableNow run over files
derived from the driver tables; oracles are the equivalent batch SQL."""

from pyspark.sql import functions as F

from estatelens.operators import ingest as IG
from estatelens.plans import standin
from estatelens.plans import oracle_sql as O
from estatelens.plans.q_ingest import CHANGE_SQL, CUT, events
from estatelens.plans.q_scoring import SCORED_CTE
from estatelens.plans.q_features import FEAT_CTES, engineered
from estatelens.plans.q_spatial import boundary_candidates as cands
from estatelens.plans.registry import register
from estatelens.session import scratch_dir
from estatelens.streaming import micro_batch as MB

N_CHUNKS, FILES = 5, 4


def land_in_order(chunks, source_dir, key):
    """Test-fixture landing: each chunk (a slice of a driver table) becomes
    several files, written after those of the chunk before, so arrival order =
    chunk order; the records of one key share a file of their chunk.  Upstream
    producers land real input; the stream jobs never depend on this helper."""
    for c in chunks:
        c.repartition(FILES, key).write.mode("append").parquet(source_dir)


def _landed_events(spark, sf_dir, where=None):
    """All events, cut by quantiles of their time; those without one arrive last."""
    e = events(spark, sf_dir)
    if where is not None:
        e = e.where(where)
    src = scratch_dir(spark, "events-src")
    cuts = e.agg(F.percentile_approx("ts", [i / N_CHUNKS for i in range(1, N_CHUNKS)]).alias("c")).first()["c"] or []
    chunk = F.when(F.col("ts").isNull(), F.lit(N_CHUNKS)).otherwise(
        sum([(F.col("ts") > F.lit(c)).cast("int") for c in cuts], F.lit(0)))
    land_in_order([e.where(chunk == i) for i in range(N_CHUNKS + 1)], src, "user_id")
    return src, e.schema


def _changes(spark, sf_dir, where=None, stored=None):
    src, schema = _landed_events(spark, sf_dir, where)
    out = MB.change_stream(spark, src, schema, scratch_dir(spark, "changes"), "user_id", ["ts", "event_id"],
                           ["event_type", "bucket"], bootstrap=stored, files_per_batch=FILES)
    return out.select("event_id", "user_id", "event_type", "bucket")


@register("change_stream", CHANGE_SQL)
def q_change_stream(spark, sf_dir):
    return _changes(spark, sf_dir)


@register("change_stream_bootstrap", f"""
WITH e AS (SELECT event_id, ts, user_id, event_type, CAST(floor(value / 50) AS BIGINT) AS bucket FROM events),
l AS (SELECT *, lag(event_type) OVER w AS pt, lag(bucket) OVER w AS pb, lag(event_id) OVER w AS pe FROM e
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, event_type, bucket FROM l
WHERE ts >= {CUT} AND (pe IS NULL OR pt IS DISTINCT FROM event_type OR pb IS DISTINCT FROM bucket)""")
def q_change_bootstrap(spark, sf_dir):
    e = events(spark, sf_dir)
    stored = IG.keep_last(e.where(F.col("ts") < F.expr(CUT)), ["user_id"], ["ts", "event_id"])
    return _changes(spark, sf_dir, F.col("ts") >= F.expr(CUT), stored)


@register("boundary_resume", O.with_listings(f"""
, cand AS (SELECT {', '.join(f'{e} AS {n}' for n, e in standin.BOUNDARY_COLS)} FROM listings),
c AS (SELECT *, upper(trim(suburb)) AS suburb_key FROM cand),
r AS (SELECT *, row_number() OVER (PARTITION BY suburb_key ORDER BY
        CASE WHEN class = 'boundary' OR type = 'administrative' THEN 0 ELSE 1 END, pos) AS rn FROM c)
SELECT suburb_key, geom_type, coordinates FROM r WHERE rn = 1 AND geom_type IN ('Polygon', 'MultiPolygon')"""))
def q_boundary_resume(spark, sf_dir):
    c = cands(spark, sf_dir)
    src = scratch_dir(spark, "cand-src")
    # whole suburbs per file: a suburb's candidates always arrive together
    chunks = [c.where(F.pmod(F.xxhash64(F.upper(F.trim("suburb"))), F.lit(4)) == i) for i in range(4)]
    land_in_order(chunks, src, "suburb")
    return MB.boundary_stream(spark, src, c.schema, scratch_dir(spark, "boundary-sink"),
                              scratch_dir(spark, "boundary-work"))


@register("rescore", O.with_cleaned(FEAT_CTES + SCORED_CTE + """
SELECT Property_ID, Last_Updated, Predicted_Price, Predicted_Price_Lower, Predicted_Price_Upper,
       Interval_Width_Pct, Deal_Signal FROM signals"""))
def q_rescore(spark, sf_dir):
    from estatelens.operators import scoring as SC
    fs = engineered(spark, sf_dir).where("Status = 'For Sale'")
    src = scratch_dir(spark, "forsale-src")
    land_in_order([fs.where(F.pmod(F.xxhash64("Property_ID"), F.lit(2)) == i) for i in range(2)], src, "Property_ID")

    def score(batch):
        b = batch.withColumns({"pt": F.expr(standin.PRED), "q10": F.expr(standin.Q10),
                               "q90": F.expr(standin.Q90)})
        return SC.postprocess(b, "pt", "q10", "q90").select(
            "Property_ID", "Last_Updated", "Predicted_Price", "Predicted_Price_Lower",
            "Predicted_Price_Upper", "Interval_Width_Pct", "Deal_Signal")
    return MB.rescore_stream(spark, src, fs.schema, scratch_dir(spark, "rescored"),
                             scratch_dir(spark, "rescore-work"), score)


@register("change_stream_stateful", CHANGE_SQL)
def q_change_stateful(spark, sf_dir):
    """S1 with one file a micro-batch: the records of a key of one chunk share a file, so the result is the same."""
    src, schema = _landed_events(spark, sf_dir)
    out = MB.change_stream(spark, src, schema, scratch_dir(spark, "change-state"), "user_id", ["ts", "event_id"],
                           ["event_type", "bucket"])
    return out.select("event_id", "user_id", "event_type", "bucket")


@register("rescore_model")
def q_rescore_model(spark, sf_dir):
    """S4 with the stored production model, loaded once for the whole run: the rows of ``batch_score``."""
    from estatelens.operators import scoring as SC
    from estatelens.plans import q_models as Q
    fs = engineered(spark, sf_dir).where("Status = 'For Sale'")
    src = scratch_dir(spark, "forsale-src")
    land_in_order([fs.where(F.pmod(F.xxhash64("Property_ID"), F.lit(2)) == i) for i in range(2)], src, "Property_ID")
    model = Q.boosted(spark, sf_dir, "full")
    return MB.rescore_stream(spark, src, fs.schema, scratch_dir(spark, "rescored"), scratch_dir(spark, "rescore-work"),
                             lambda batch: SC.prediction_view(Q.scored(spark, sf_dir, batch, model=model)))
