"""End-to-end weekly update (M1): clean -> train -> score -> publish.

The same stages the reference runs as three processes, as one Spark
application: every stage reads the previous stage's written tables, so a
failure restarts from the last written stage, not from the raw input.

    python -m estatelens.plans.weekly --listings <csv or parquet dir> --out <dir>
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelens.operators import clean as C
from estatelens.operators import features as FE
from estatelens.operators import models as M
from estatelens.operators import scoring as SC
from estatelens.operators.common import materialize
from estatelens.params import DEFAULT, Params
from estatelens.sources import readers as R
from estatelens.sources import sinks as W


SEGMENT = "Property_Type"   # of the interval scales

def decisions_table(spark: SparkSession, cleaned: DataFrame, caps: DataFrame,
                    p: Params) -> DataFrame:
    """The decision parameters as a (name, value) table."""
    snap = cleaned.where("Status = 'Sold'").agg(F.max("Date_parsed").cast("string").alias("value")) \
        .select(F.lit("data_snapshot_date").alias("name"), "value")
    fixed = W.params_table(spark, {
        "price_floor": str(int(p.price_floor)), "price_ceiling": str(int(p.price_ceiling)),
        "land_property_types": "|".join(sorted(p.land_types)),
        "apt_like_types": "|".join(sorted(p.apt_like_types)),
        "rural_large_types": "|".join(sorted(p.rural_large_types)),
        "new_build_types": "|".join(sorted(p.new_build_types)),
        "metro_envelope": f"{p.lat_min},{p.lat_max},{p.lon_min},{p.lon_max}",
        "target_transform": "log1p", "split_strategy": "time_based",
        "split_ratios": f"{p.split_train},{p.split_val},{1 - p.split_train - p.split_val:.2f}"})
    rare = C.rare_types(cleaned).agg(
        F.coalesce(F.array_join(F.array_sort(F.collect_list("Property_Type")), "|"), F.lit(""))
        .alias("value")).select(F.lit("rare_property_types").alias("name"), "value")
    capt = caps.select(F.concat(F.lit("cap:"), "Property_Type").alias("name"),
                       F.bround("cap", 0).cast("bigint").cast("string").alias("value"))
    return snap.unionByName(fixed).unionByName(rare).unionByName(capt)


def weekly_update(spark: SparkSession, listings: DataFrame, out_dir: str,
                  p: Params = DEFAULT, boost: dict | None = None) -> dict:
    """Run all stages; returns the written table paths and the metrics."""
    boost = boost or M.LOCKED_BOOST
    # 1. clean (cleaned Parquet partitioned by status + decisions)
    res = C.clean(listings, p)
    W.write_parquet(res.cleaned, f"{out_dir}/cleaned", ["Status"])
    cleaned = spark.read.parquet(f"{out_dir}/cleaned")
    decisions_table(spark, cleaned, res.caps, p).coalesce(1).write.mode("overwrite") \
        .json(f"{out_dir}/decisions")
    # 2. train: folds, evaluate on val and test, refit on everything
    eng = FE.add_engineered(cleaned, C.rare_types(cleaned), p)
    split = FE.chronological_split(FE.trainable(eng), p)
    prep_tr = FE.fit_preprocessor(split.where("fold = 'train'"))
    fd = M.fold_vectors(FE.transform(split, prep_tr, keep=("Property_ID", "fold", "Numeric_Price", SEGMENT)),
                        prep_tr.feature_order, keep=("Property_ID", SEGMENT))
    m_val = M.boosting(boost).fit(fd.train)
    metrics = [{"fold": "val", **M.evaluate(m_val, fd.val)}]
    m_test = M.boosting(boost).fit(fd.train.unionByName(fd.val))
    metrics.append({"fold": "test", **M.evaluate(m_test, fd.test)})
    offsets = M.scaled_offsets(M.residuals(m_val, fd.val), SEGMENT)
    prep_all = FE.fit_preprocessor(split)
    full = M.assemble(FE.transform(split, prep_all, keep=("Property_ID", "Numeric_Price")),
                      prep_all.feature_order, ["Property_ID"])
    full = M.sized(materialize(full, "full-vectors"))
    model = M.boosting(boost).fit(full)
    model.write().overwrite().save(f"{out_dir}/models/point")
    W.write_parquet(prep_all.medians, f"{out_dir}/models/numeric_medians")
    W.write_parquet(prep_all.suburb_freq, f"{out_dir}/models/suburb_freq")
    W.write_parquet(offsets, f"{out_dir}/models/interval_offsets")
    mdf = spark.createDataFrame(metrics)
    long = mdf.select("fold", F.explode(F.array(*[
        F.struct(F.lit(k).alias("metric"), F.col(k).cast("double").alias("value"))
        for k in ("n", "rmse", "mae", "mape", "r2_log")])).alias("m")).select("fold", "m.*")
    W.write_parquet(long, f"{out_dir}/models/metrics")
    # 3. score For Sale at the as-of date
    fs = eng.where("Status = 'For Sale'").withColumns(
        {"Year": F.lit(p.as_of.year), "Month": F.lit(p.as_of.month)})
    X = M.assemble(FE.transform(fs, prep_all, keep=("Property_ID", SEGMENT)), prep_all.feature_order,
                   ["Property_ID", SEGMENT])
    pred = M.predict_with_interval(model, X, offsets, SEGMENT).select("Property_ID", "point", "q_lo", "q_hi")
    view = SC.prediction_view(SC.postprocess(fs.join(pred, "Property_ID"), "point", "q_lo", "q_hi", p))
    W.write_parquet(view, f"{out_dir}/predictions_for_sale")
    W.write_csv(spark.read.parquet(f"{out_dir}/predictions_for_sale"), f"{out_dir}/predictions_csv")
    # 4. M3: every output present with its columns
    check = W.check_outputs(spark, {
        f"{out_dir}/cleaned": ["Property_ID", "Status", "is_land", "out_of_metro"],
        f"{out_dir}/predictions_for_sale": ["Predicted_Price", "Deal_Signal"],
        f"{out_dir}/models/metrics": ["fold", "metric", "value"],
        f"{out_dir}/models/interval_offsets": ["off_lo", "off_hi"]})
    bad = check.where("NOT (exists AND columns_ok)").count()
    if bad:
        raise RuntimeError(f"{bad} pipeline outputs missing or incomplete under {out_dir}")
    return {"predictions": f"{out_dir}/predictions_for_sale", "metrics": metrics}


def main(argv=None) -> None:
    from estatelens.session import get_session
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--listings", required=True, help="enriched listings (CSV dir/file or Parquet)")
    ap.add_argument("--out", required=True)
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    spark = get_session(a.master)
    src = spark.read.parquet(a.listings) if a.listings.rstrip("/").endswith(".parquet") \
        else R.read_listings_csv(spark, a.listings)
    out = weekly_update(spark, src, a.out)
    print(out["metrics"])


if __name__ == "__main__":
    main()
