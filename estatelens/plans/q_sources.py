"""Registered queries: sources and sinks.

Each query writes data derived from the driver tables to a fresh folder
under the shared checkpoint directory and reads it back through the
reader under test; the oracle is the underlying SQL.
"""

from pyspark.sql import functions as F

from estatelens.operators import clean as C
from estatelens.operators import enrich as EN
from estatelens.operators import spatial as SP
from estatelens.plans import base, standin
from estatelens.plans import oracle_sql as O
from estatelens.plans import q_enrich as QE
from estatelens.plans.q_spatial import boundary_candidates
from estatelens.plans.registry import register
from estatelens.session import scratch_dir
from estatelens.sources import readers as R
from estatelens.sources import sinks as W

RAW_COLS = [f.name for f in R.ENRICHED_SCHEMA.fields]


@register("csv_dialect_scan", O.with_listings(" UNION ALL ".join(
    f"SELECT '{d}' AS dialect, * FROM listings" for d in ("bom_comma", "tab", "latin1"))))
def q_csv_dialect(spark, sf_dir):
    l = base.listings(spark, sf_dir).select(*RAW_COLS)
    outs = []
    for dialect, sep, enc, bom in (("bom_comma", ",", "UTF-8", True), ("tab", "\t", "UTF-8", False),
                                   ("latin1", ",", "ISO-8859-1", False)):
        path = scratch_dir(spark, f"csv-{dialect}")
        src = l.withColumnRenamed("Property_ID", "\ufeffProperty_ID") if bom else l
        W.write_csv(src, path, sep, enc)
        outs.append(R.read_listings_csv(spark, path).select(F.lit(dialect).alias("dialect"), *RAW_COLS))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


@register("reference_scan", O.with_listings(QE.DIM_CTES + "SELECT * FROM census"))
def q_reference_scan(spark, sf_dir):
    p02, p01 = scratch_dir(spark, "g02"), scratch_dir(spark, "g01")
    W.write_csv(QE.g02(spark, sf_dir), p02)
    W.write_csv(QE.g01(spark, sf_dir), p01)
    return EN.census_table(R.read_string_table(spark, p02), R.read_string_table(spark, p01))


@register("offence_scan", O.with_listings(QE.DIM_CTES + "SELECT * FROM offences"))
def q_offence_scan(spark, sf_dir):
    p = scratch_dir(spark, "offences")
    raw = QE.offences_raw(spark, sf_dir).select(
        F.col("Year").alias(" Year "), "Postcode", "Suburb/Town Name", "Offence Count")
    W.write_csv(raw, p)
    df = R.read_string_table(spark, p)
    df = df.toDF(*[c.strip() for c in df.columns])
    return EN.offences_by_postcode(df)


@register("feed_scan", O.with_listings(QE.RAIL_SQL))
def q_feed_scan(spark, sf_dir):
    root = scratch_dir(spark, "gtfs")
    routes, trips, stop_times, stops = QE.feeds(spark, sf_dir)
    for name, df in (("routes", routes), ("trips", trips), ("stop_times", stop_times), ("stops", stops)):
        # one folder per feed and table, as unpacked feeds are laid out
        df.write.mode("overwrite").partitionBy("feed_id").option("header", True) \
            .csv(f"{root}/{name}.txt.d")
    tabs = {name: R.read_feed_table(spark, f"{root}/{name}.txt.d", "part-*")
            for name in ("routes", "trips", "stop_times", "stops")}
    return EN.rail_stops(tabs["routes"], tabs["trips"], tabs["stop_times"], tabs["stops"])


@register("parquet_roundtrip", O.with_cleaned(
    "SELECT * REPLACE (round_even(LandSize_sqm, 4) AS LandSize_sqm) FROM cleaned"))
def q_parquet_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "cleaned")
    W.write_parquet(base.cleaned(spark, sf_dir), path, ["Status"])
    check = W.check_outputs(spark, {path: ["Property_ID", "Status", "is_land"]}).first()
    if not (check["exists"] and check["columns_ok"]):
        raise RuntimeError(f"output check failed for {path}")
    back = spark.read.parquet(path)
    return back.withColumn("LandSize_sqm", F.bround("LandSize_sqm", 4))


@register("csv_mirror", O.with_cleaned(f"""
SELECT Property_ID, Status, Suburb, Postcode, Property_Type, Numeric_Price,
  round_even({standin.PRED}, -3) AS Predicted_Price, Last_Updated, URL FROM cleaned WHERE Status = 'For Sale'"""))
def q_csv_mirror(spark, sf_dir):
    from estatelens.operators.scoring import prediction_view
    c = base.cleaned(spark, sf_dir).where("Status = 'For Sale'") \
        .withColumn("Predicted_Price", F.bround(F.expr(standin.PRED), -3))
    v = prediction_view(c)
    v = v.select("Property_ID", "Status", "Suburb", "Postcode", "Property_Type", "Numeric_Price",
                 "Predicted_Price", "Last_Updated", "URL")
    path = scratch_dir(spark, "predictions-csv")
    W.write_csv(v, path)
    return spark.read.schema(v.schema).option("header", True).csv(path)


@register("params_roundtrip", O.with_cleaned(f"""
SELECT name, value FROM (
  SELECT 'data_snapshot_date' AS name, CAST(max(Date_parsed) AS STRING) AS value FROM cleaned WHERE Status = 'Sold'
  UNION ALL SELECT 'price_floor', '20000' UNION ALL SELECT 'price_ceiling', '20000000'
  UNION ALL SELECT 'rare_property_types', coalesce(string_agg(Property_Type, '|' ORDER BY Property_Type), '')
    FROM (SELECT Property_Type FROM cleaned GROUP BY Property_Type HAVING count(*) < 50) r
  UNION ALL SELECT 'cap:' || Property_Type, CAST(CAST(round_even(cap, 0) AS BIGINT) AS STRING) FROM caps) t"""))
def q_params(spark, sf_dir):
    res = base.cleaned_result(spark, sf_dir)
    cleaned, caps = res.cleaned, res.caps
    snap = cleaned.where("Status = 'Sold'").agg(F.max("Date_parsed").cast("string").alias("value")) \
        .select(F.lit("data_snapshot_date").alias("name"), "value")
    fixed = spark.createDataFrame([("price_floor", "20000"), ("price_ceiling", "20000000")],
                                  "name string, value string")
    rare = C.rare_types(cleaned).agg(F.coalesce(F.array_join(F.array_sort(F.collect_list("Property_Type")),
                                                             "|"), F.lit("")).alias("value")) \
        .select(F.lit("rare_property_types").alias("name"), "value")
    capt = caps.select(F.concat(F.lit("cap:"), "Property_Type").alias("name"),
                       F.bround("cap", 0).cast("bigint").cast("string").alias("value"))
    table = snap.unionByName(fixed).unionByName(rare).unionByName(capt)
    path = scratch_dir(spark, "decisions")
    table.coalesce(1).write.mode("overwrite").json(path)
    return spark.read.schema("name string, value string").json(path)


@register("metrics_sink", O.with_cleaned(f"""
, rare AS (SELECT Property_Type FROM cleaned GROUP BY Property_Type HAVING count(*) < 50)
, t AS (SELECT Numeric_Price AS y, {standin.PRED} AS p FROM cleaned
        WHERE Status = 'Sold' AND Numeric_Price IS NOT NULL AND Date_parsed IS NOT NULL)
SELECT 'standin' AS run_id, 'all' AS fold, metric, value FROM (
  SELECT 'rmse' AS metric, round_even(sqrt(avg((y - p) * (y - p))), 4) AS value FROM t
  UNION ALL SELECT 'mae', round_even(avg(abs(y - p)), 4) FROM t
  UNION ALL SELECT 'mape', round_even(avg(abs((y - p) / y)) * 100, 6) FROM t) m"""))
def q_metrics_sink(spark, sf_dir):
    from estatelens.operators.features import trainable
    from estatelens.operators.scoring import regression_metrics
    t = trainable(base.cleaned(spark, sf_dir)).withColumn("p", F.expr(standin.PRED))
    m = regression_metrics(t, "Numeric_Price", "p")
    long = m.select(F.lit("standin").alias("run_id"), F.lit("all").alias("fold"),
                    F.explode(F.array(
                        F.struct(F.lit("rmse").alias("metric"), F.bround("rmse", 4).alias("value")),
                        F.struct(F.lit("mae").alias("metric"), F.bround("mae", 4).alias("value")),
                        F.struct(F.lit("mape").alias("metric"), F.bround("mape", 6).alias("value")))).alias("r"))
    long = long.select("run_id", "fold", "r.metric", "r.value")
    path = scratch_dir(spark, "metrics")
    W.write_parquet(long, path)
    return spark.read.parquet(path)


@register("geojson_roundtrip", O.with_listings(f"""
, cand AS (SELECT {', '.join(f'{e} AS {n}' for n, e in standin.BOUNDARY_COLS)} FROM listings),
c AS (SELECT *, upper(trim(suburb)) AS suburb_key FROM cand),
r AS (SELECT *, row_number() OVER (PARTITION BY suburb_key ORDER BY
        CASE WHEN class = 'boundary' OR type = 'administrative' THEN 0 ELSE 1 END, pos) AS rn FROM c)
SELECT suburb_key, geom_type, coordinates FROM r WHERE rn = 1 AND geom_type IN ('Polygon', 'MultiPolygon')"""))
def q_geojson(spark, sf_dir):
    path = scratch_dir(spark, "boundaries")
    picked = SP.pick_boundary(boundary_candidates(spark, sf_dir))
    first = picked.where("suburb_key < 'S2'")
    W.write_geojson_features(first, path, "overwrite")
    done = R.read_geojson_features(spark, path).select(F.col("suburb_key").alias("suburb"))
    rest = SP.pick_boundary(boundary_candidates(spark, sf_dir), done)   # resume: skip done
    W.write_geojson_features(rest, path, "append")
    return R.read_geojson_features(spark, path)


@register("suburb_names", O.with_listings(
    "SELECT DISTINCT upper(trim(Suburb)) AS suburb FROM listings WHERE Suburb IS NOT NULL ORDER BY suburb"))
def q_suburb_names(spark, sf_dir):
    l = base.listings(spark, sf_dir)
    return l.where("Suburb IS NOT NULL").select(F.upper(F.trim("Suburb")).alias("suburb")) \
        .distinct().orderBy("suburb")
