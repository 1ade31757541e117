"""Registered queries: models (K3-K14, M1, B18).  No SQL oracle: the driver
checks rows; the tests check early stopping, the stored models, ridge against
its closed form and the intervals.

Production models have the locked settings, with the rounds that early stopping on
the validation fold finds (661 at most).  Each model is fitted once, saved in the
shared folder and loaded by path by every later query."""

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import functions as F

from estatelens.operators import features as FE
from estatelens.operators import models as M
from estatelens.operators import scoring as SC
from estatelens.operators.common import materialize
from estatelens.params import DEFAULT, FLAG_FEATURES, NUMERIC_FEATURES, TIME_FEATURES
from estatelens.plans import base
from estatelens.plans import oracle_sql as O
from estatelens.plans import standin
from estatelens.plans.q_features import FEAT_CTES, engineered, split
from estatelens.plans.registry import register
from estatelens.session import scratch_dir

# Forest configurations of the registered queries; the reference's grid of 36
# (200 and 500 trees, depth to 30) is ``models.FOREST_GRID``.  The README has the
# measured time of that grid, which is why it is not run by default.
FOREST_CONFIGS = [{"numTrees": 40, "maxDepth": 10, "minInstancesPerNode": 1,
                   "featureSubsetStrategy": "0.5"},
                  {"numTrees": 40, "maxDepth": 10, "minInstancesPerNode": 5,
                   "featureSubsetStrategy": "sqrt"}]


SEGMENT = "Property_Type"   # of the interval scales
#: Columns of a listing that the models read besides key and date, and bytes of orders beyond which no others are sorted and written for the split.
MODEL_COLUMNS = (*NUMERIC_FEATURES, *TIME_FEATURES, *FLAG_FEATURES, "Suburb", "Property_Type", "Numeric_Price")
NARROW_BYTES = 8 << 20


def columns(spark, sf_dir):
    """MODEL_COLUMNS of many orders, None (all) of fewer: a fit's samples go by the place of a row in the split's files, and
    small tables keep theirs (no job is run to tell, as the split's ranges go by the jobs before it)."""
    return MODEL_COLUMNS if base.input_bytes(spark, sf_dir) > NARROW_BYTES else None


def folds(spark, sf_dir):
    """The assembled folds and the preprocessor of the training fold."""
    def build():
        sp = split(spark, sf_dir, columns(spark, sf_dir))
        prep = FE.fit_preprocessor(sp.where("fold = 'train'"))
        fm = FE.transform(sp, prep, keep=("Property_ID", "fold", "Numeric_Price", "Property_Type"))
        return M.fold_vectors(fm, prep.feature_order, keep=("Property_ID", "Property_Type")), prep
    return base.once(spark, sf_dir, "folds", build)


def tuned(spark, sf_dir):
    """The tuning result of the boosting grid, written once."""
    def build():
        fd, _ = folds(spark, sf_dir)
        return M.tune_boosting(spark, fd.train, fd.val)
    return base.stage(spark, sf_dir, "boost-grid", build)


def _locked(spark, sf_dir):
    """(settings, path): early stopping finds the rounds and fits the model of the training fold on the way; it is saved."""
    def build():
        fd, _ = folds(spark, sf_dir)
        found, model = M.locked_model(fd.train, fd.val)
        path = scratch_dir(spark, "model-boost-train")
        model.write().save(path)
        return found, path
    return base.once(spark, sf_dir, "locked", build)


def locked(spark, sf_dir):
    """The locked settings of the production models, rounds included."""
    return _locked(spark, sf_dir)[0]


def boosted(spark, sf_dir, part):
    """The stored model of ``train``, ``train+val`` or ``full`` (all Sold rows, the preprocessor refitted on them)."""
    if part == "train":
        return GBTRegressionModel.load(_locked(spark, sf_dir)[1])

    def fit():
        fd, _ = folds(spark, sf_dir)
        data = {"train+val": lambda: fd.train.unionByName(fd.val),
                "full": lambda: full_sold(spark, sf_dir)[0]}[part]()
        return M.fit_boosting(locked(spark, sf_dir), data)
    return base.model(spark, sf_dir, f"boost-{part.replace('+', '-')}", fit, GBTRegressionModel)


def full_sold(spark, sf_dir):
    def build():
        sp = split(spark, sf_dir, columns(spark, sf_dir))
        prep = FE.fit_preprocessor(sp)
        full = M.assemble(FE.transform(sp, prep, keep=("Property_ID", "Numeric_Price")), prep.feature_order, ["Property_ID"])
        return M.sized(materialize(full, "full-vectors")), prep
    return base.once(spark, sf_dir, "full-sold", build)


def offsets(spark, sf_dir):
    """Conformal offsets by property type, of the training fold's model on the validation fold, written once."""
    return base.stage(spark, sf_dir, "interval-offsets", lambda: M.scaled_offsets(
        M.residuals(boosted(spark, sf_dir, "train"), folds(spark, sf_dir)[0].val), SEGMENT))


@register("ridge_grid")
def q_ridge(spark, sf_dir):
    sp = split(spark, sf_dir)
    prep = FE.fit_preprocessor(sp.where("fold = 'train'"))
    fm = FE.transform(sp, prep, keep=("Property_ID", "fold", "Numeric_Price"))
    cols = prep.feature_order
    tr, (va,) = M.standardize(fm.where("fold = 'train'"), [fm.where("fold = 'val'")], cols)
    fd_tr = M.assemble(tr, cols, ["Property_ID"])
    fd_va = M.assemble(va, cols, ["Property_ID"])
    return M.ridge_grid(spark, fd_tr, fd_va)


@register("forest_grid")
def q_forest(spark, sf_dir):
    fd, _ = folds(spark, sf_dir)
    return M.tune(spark, M.forest, FOREST_CONFIGS, fd.train, fd.val)


@register("boost_grid")
def q_boost(spark, sf_dir):
    """K7 + F-5: 24 configurations, up to 2 000 rounds each, stopped after 50 without a better validation error."""
    return tuned(spark, sf_dir)


@register("intervals")
def q_intervals(spark, sf_dir):
    """K9: point model on train, scaled conformal offsets on val, coverage per segment on test."""
    fd, _ = folds(spark, sf_dir)
    model, offs = boosted(spark, sf_dir, "train"), offsets(spark, sf_dir)
    pred = M.predict_with_interval(model, fd.test.withColumn(M.PRICE, F.expm1(M.LABEL)), offs, SEGMENT)
    return M.segment_coverage(pred, SEGMENT).join(offs, SEGMENT, "left")


@register("interval_segments", O.with_cleaned(FEAT_CTES + f"""
, res AS (SELECT Property_Type, ln(1 + Numeric_Price) - ln(1 + {standin.PRED}) AS r FROM split WHERE fold = 'val'),
whole AS (SELECT count(*) AS n, sum(abs(r)) AS t FROM res),
seg AS (SELECT Property_Type, count(*) AS n_calib, sum(abs(r)) AS s FROM res GROUP BY Property_Type),
own AS (SELECT Property_Type, n_calib, (s + {M.SCALE_SHRINKAGE} * t / n) / (n_calib + {M.SCALE_SHRINKAGE}) AS scale
        FROM seg, whole WHERE Property_Type IS NOT NULL),
cuts AS (SELECT quantile_cont(r / coalesce(scale, t / n), 0.1) AS a, quantile_cont(r / coalesce(scale, t / n), 0.9) AS b
         FROM res LEFT JOIN own USING (Property_Type), whole),
test AS (SELECT Property_Type, Numeric_Price AS y, {standin.PRED} AS pt, ln(1 + {standin.PRED}) AS p,
                coalesce(scale, t / n) AS sc, a, b
         FROM split LEFT JOIN own USING (Property_Type), whole, cuts WHERE fold = 'test'),
iv AS (SELECT *, exp(p + a * sc) - 1 AS lo, exp(p + b * sc) - 1 AS hi FROM test)
SELECT Property_Type, CAST(count(*) AS BIGINT) AS n, round_even(avg(CASE WHEN y BETWEEN lo AND hi THEN 1.0 ELSE 0.0 END) * 100, 4) AS coverage_pct,
  round_even(quantile_cont((hi - lo) / pt * 100, 0.5), 4) AS median_width_pct, round_even(any_value(sc), 6) AS scale
FROM iv WHERE Property_Type IS NOT NULL GROUP BY Property_Type"""))
def q_interval_segments(spark, sf_dir):
    """K9 with the deterministic stand-in prediction: the scales of the validation fold, coverage on the test fold."""
    rows = materialize(split(spark, sf_dir, ("Property_Type", M.PRICE)).where("fold <> 'train'").select(
        "Property_Type", "fold", M.PRICE, F.log1p(F.expr(standin.PRED)).alias("prediction")), "interval-rows")
    res = rows.where("fold = 'val'").withColumn("residual", F.log1p(M.PRICE) - F.col("prediction"))
    offs = materialize(M.scaled_offsets(res, SEGMENT), "interval-segments")
    pred = M.interval_prices(rows.where("fold = 'test'"), offs, SEGMENT)
    found = M.with_segment(M.segment_coverage(pred, SEGMENT), offs.select(SEGMENT, "scale"), SEGMENT, ["scale"])
    return found.select(SEGMENT, "n", *[F.bround(c, 4).alias(c) for c in ("coverage_pct", "median_width_pct")],
                        F.bround("scale", 6).alias("scale"))


@register("protocol")
def q_protocol(spark, sf_dir):
    """Evaluate on val (fit train), refit train+val and evaluate
    on test, for the three families; the table names the winner."""
    fd, _ = folds(spark, sf_dir)
    trv = fd.train.unionByName(fd.val)
    st = fd.train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(M.LABEL).alias("s")).first()
    st2 = trv.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(M.LABEL).alias("s")).first()
    rows = []
    fits = {
        "ridge": lambda part: M.fit_ridge(*{"train": (fd.train, 1000.0, st["n"], st["s"]),
                                            "train+val": (trv, 1000.0, st2["n"], st2["s"])}[part]),
        "forest": lambda part: M.fit_forest(FOREST_CONFIGS[0], {"train": fd.train, "train+val": trv}[part]),
        "boost": lambda part: boosted(spark, sf_dir, part),
    }
    for name, fit in fits.items():
        rows.append({"family": name, "fold": "val", **M.evaluate(fit("train"), fd.val)})
        rows.append({"family": name, "fold": "test", **M.evaluate(fit("train+val"), fd.test)})
    t = spark.createDataFrame(rows)
    best = t.where("fold = 'val'").agg(F.min_by("family", "rmse").alias("__w"))
    return t.crossJoin(F.broadcast(best)).withColumn("is_winner", F.col("family") == F.col("__w")) \
        .drop("__w")


def scored(spark, sf_dir, for_sale, p=DEFAULT, model=None):
    """Engineered listings scored by the stored production model and offsets, with intervals and signals."""
    _, prep = full_sold(spark, sf_dir)
    dated = for_sale.withColumns({"Year": F.lit(p.as_of.year), "Month": F.lit(p.as_of.month)})
    vectors = M.assemble(FE.transform(dated, prep, keep=("Property_ID", SEGMENT)), prep.feature_order, ["Property_ID", SEGMENT])
    pred = M.predict_with_interval(model or boosted(spark, sf_dir, "full"), vectors, offsets(spark, sf_dir), SEGMENT)
    return SC.postprocess(dated.join(pred.select("Property_ID", "point", "q_lo", "q_hi"), "Property_ID"), "point", "q_lo", "q_hi", p)


def batch_score(spark, sf_dir, p=DEFAULT, only=None):
    """K12 + B18 + M1: For Sale listings at the as-of date, scored by the stored model of all Sold rows.
    ``only`` names the columns of a listing that are read of the result, as for ``split``."""
    return SC.prediction_view(scored(spark, sf_dir, engineered(spark, sf_dir, only).where("Status = 'For Sale'"), p))


@register("batch_score")
def q_batch_score(spark, sf_dir):
    return batch_score(spark, sf_dir)


@register("importance")
def q_importance(spark, sf_dir):
    _, prep = folds(spark, sf_dir)
    return M.importances(spark, boosted(spark, sf_dir, "train"), prep.feature_order, 20)


@register("attribution")
def q_attribution(spark, sf_dir, rows=None):
    """K14 over the test fold; ``rows`` (default: all of them) bounds it to a hash sample."""
    from estatelens.operators.profile import hash_sample
    fd, prep = folds(spark, sf_dir)
    test = fd.test if rows is None else hash_sample(fd.test, rows, "Property_ID")
    return M.permutation_importance(boosted(spark, sf_dir, "train"), test, prep.feature_order, "Property_ID")


@register("shapley")
def q_shapley(spark, sf_dir):
    """Each feature's mean absolute contribution, and its mean, over the whole test fold."""
    fd, prep = folds(spark, sf_dir)

    def build():
        values = M.shapley_values(boosted(spark, sf_dir, "train"), fd.test, fd.train, prep.feature_order, "Property_ID")
        return values.groupBy("feature").agg(F.count("*").alias("n"), F.avg(F.abs("contribution")).alias("mean_abs"),
                                             F.avg("contribution").alias("mean"))
    return base.stage(spark, sf_dir, "shapley", build)


@register("score_requests")
def q_score_requests(spark, sf_dir):
    """V4 re-aimed: on-demand estimates as batch scoring of a request table
    (here: every For Sale listing as a request) with interval, suburb-median
    comparison (C13) and weak-segment warnings (H20)."""
    from estatelens.operators.spatial import suburb_stats
    from estatelens.operators.timeseries import sold_priced
    view = batch_score(spark, sf_dir, only=columns(spark, sf_dir))
    st = suburb_stats(sold_priced(base.cleaned(spark, sf_dir, only=columns(spark, sf_dir))), 30)
    known = split(spark, sf_dir, columns(spark, sf_dir)).where("fold = 'train'").select("Suburb")
    out = SC.warnings(SC.suburb_compare(view, st), known)
    return out.select("Property_ID", "Suburb", "Predicted_Price", "Predicted_Price_Lower",
                      "Predicted_Price_Upper", "suburb_median", "vs_suburb_pct", "warnings")


@register("weekly_update")
def q_weekly(spark, sf_dir):
    """M1 end to end: clean -> train -> score -> publish (outputs checked)."""
    from estatelens.plans.weekly import weekly_update
    out = weekly_update(spark, base.listings(spark, sf_dir), scratch_dir(spark, "weekly"),
                        boost=locked(spark, sf_dir))
    return spark.read.parquet(out["predictions"])
