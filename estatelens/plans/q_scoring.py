"""Registered queries: scoring post-processing with a deterministic stand-in
prediction (H13-H17, H19, H20, D25, D26, D28, D29, E8, V1, B19, C13)."""

from pyspark.sql import functions as F

from estatelens.operators import scoring as SC
from estatelens.operators.quantiles import exact_percentiles
from estatelens.operators.spatial import suburb_stats
from estatelens.operators.timeseries import sold_priced, top_k_values
from estatelens.plans import base, standin
from estatelens.plans import oracle_sql as O
from estatelens.plans.q_features import FEAT_CTES, engineered, split
from estatelens.plans.q_spatial import SUBSTATS_SQL
from estatelens.plans.registry import register

SCORED_CTE = f"""
, fsr AS (SELECT *, {standin.PRED} AS pt, {standin.Q10} AS q10, {standin.Q90} AS q90
          FROM eng WHERE Status = 'For Sale'),
ordered AS (SELECT *, least(q10, pt) AS lo, greatest(q90, pt) AS hi FROM fsr),
scored AS (SELECT *, round_even(CASE WHEN pt > 0 THEN (hi - lo) / pt * 100 ELSE 0 END, 1) AS Interval_Width_Pct,
    round_even(pt, -3) AS Predicted_Price, round_even(lo, -3) AS Predicted_Price_Lower,
    round_even(hi, -3) AS Predicted_Price_Upper FROM ordered),
signals AS (SELECT *, CASE WHEN Numeric_Price IS NULL THEN 'No Asking Price'
    WHEN Numeric_Price < Predicted_Price * (1 - 0.1) THEN 'Good Deal'
    WHEN Numeric_Price > Predicted_Price * (1 + 0.1) THEN 'Overpriced' ELSE 'Fair' END AS Deal_Signal FROM scored)"""


def scored(spark, sf_dir):
    fs = engineered(spark, sf_dir).where("Status = 'For Sale'")
    fs = fs.withColumns({"pt": F.expr(standin.PRED), "q10": F.expr(standin.Q10),
                         "q90": F.expr(standin.Q90)})
    return SC.postprocess(fs, "pt", "q10", "q90")


@register("interval_post", O.with_cleaned(FEAT_CTES + SCORED_CTE + """
SELECT Property_ID, Last_Updated, Predicted_Price, Predicted_Price_Lower, Predicted_Price_Upper,
       Interval_Width_Pct, Deal_Signal FROM signals"""))
def q_interval(spark, sf_dir):
    return scored(spark, sf_dir).select("Property_ID", "Last_Updated", "Predicted_Price",
                                        "Predicted_Price_Lower", "Predicted_Price_Upper",
                                        "Interval_Width_Pct", "Deal_Signal")


@register("deal_signal_dist", O.with_cleaned(FEAT_CTES + SCORED_CTE + """
SELECT Deal_Signal, CAST(count(*) AS BIGINT) AS n,
  round_even(count(*) * 100.0 / (SELECT count(*) FROM signals), 4) AS pct FROM signals GROUP BY Deal_Signal"""))
def q_signal_dist(spark, sf_dir):
    return SC.signal_distribution(scored(spark, sf_dir))


@register("median_interval_width", O.with_cleaned(FEAT_CTES + SCORED_CTE + """
SELECT quantile_cont(Interval_Width_Pct, 0.5) AS median_width, CAST(count(*) AS BIGINT) AS n FROM signals"""))
def q_median_width(spark, sf_dir):
    s = scored(spark, sf_dir).withColumn("__k", F.lit(1))
    m = exact_percentiles(s, ["__k"], "Interval_Width_Pct", {"median_width": 0.5}, count_alias="n")
    return m.select("median_width", "n")


@register("sample_per_signal", O.with_cleaned(FEAT_CTES + SCORED_CTE + """
SELECT Deal_Signal, Property_ID, Predicted_Price, Numeric_Price FROM (
  SELECT *, row_number() OVER (PARTITION BY Deal_Signal ORDER BY Property_ID) AS rn FROM signals) t
WHERE rn <= 3"""))
def q_sample_per_signal(spark, sf_dir):
    s = scored(spark, sf_dir).select("Deal_Signal", "Property_ID", "Predicted_Price", "Numeric_Price")
    return SC.first_k_per_group(s, "Deal_Signal", ["Property_ID"], 3)


@register("listing_points", O.with_cleaned(FEAT_CTES + SCORED_CTE + """
SELECT Property_ID, Status, Suburb, Postcode, Property_Type, Beds, Baths, Car_Spaces,
  round_even(LandSize_sqm, 4) AS LandSize_sqm, Latitude, Longitude, Distance_to_CBD_km, Raw_Price,
  Numeric_Price, Predicted_Price, Predicted_Price_Lower, Predicted_Price_Upper, Interval_Width_Pct,
  Deal_Signal, is_land, out_of_metro, is_new_build, abs_median_age, abs_median_income_weekly,
  crime_rate_per_100k, dist_nearest_train_km, Last_Updated, URL FROM signals"""))
def q_listing_points(spark, sf_dir):
    v = SC.prediction_view(scored(spark, sf_dir))
    return v.withColumn("LandSize_sqm", F.bround("LandSize_sqm", 4))


@register("error_columns", O.with_cleaned(FEAT_CTES + f"""
SELECT Property_ID, abs(Numeric_Price - {standin.PRED}) AS abs_err,
  round_even(abs(Numeric_Price - {standin.PRED}) / Numeric_Price * 100, 6) AS pct_err FROM split WHERE fold = 'test'"""))
def q_error_columns(spark, sf_dir):
    from estatelens.functions import scalars as S
    t = split(spark, sf_dir).where("fold = 'test'").withColumn("pred", F.expr(standin.PRED))
    return t.select("Property_ID", S.abs_error("Numeric_Price", "pred").alias("abs_err"),
                    F.bround(S.pct_error("Numeric_Price", "pred"), 6).alias("pct_err"))


@register("regression_metrics", O.with_cleaned(FEAT_CTES + f"""
, t AS (SELECT Numeric_Price AS y, {standin.PRED} AS p FROM split WHERE fold = 'test')
SELECT CAST(count(*) AS BIGINT) AS n, round_even(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
  round_even(avg(abs(y - p)), 4) AS mae, round_even(avg(abs((y - p) / y)) * 100, 6) AS mape,
  round_even(1 - sum((ln(1 + y) - ln(1 + p)) * (ln(1 + y) - ln(1 + p))) / (var_pop(ln(1 + y)) * count(*)), 6) AS r2_log,
  round_even(sqrt(avg((ln(1 + y) - ln(1 + p)) * (ln(1 + y) - ln(1 + p)))), 6) AS rmse_log,
  round_even(avg(abs(ln(1 + y) - ln(1 + p))), 6) AS mae_log
FROM t"""))
def q_metrics(spark, sf_dir):
    t = split(spark, sf_dir).where("fold = 'test'").withColumn("pred", F.expr(standin.PRED))
    m = SC.regression_metrics(t, "Numeric_Price", "pred")
    return m.select("n", F.bround("rmse", 4).alias("rmse"), F.bround("mae", 4).alias("mae"),
                    *[F.bround(c, 6).alias(c) for c in ("mape", "r2_log", "rmse_log", "mae_log")])


@register("segment_errors", O.with_cleaned(FEAT_CTES + f"""
, t AS (SELECT *, {standin.PRED} AS p FROM split WHERE fold = 'test'),
top AS (SELECT Property_Type FROM t WHERE Property_Type IS NOT NULL GROUP BY Property_Type
        ORDER BY count(*) DESC, Property_Type LIMIT 8),
b AS (SELECT *, CASE WHEN Numeric_Price > 0 AND Numeric_Price <= 500000 THEN '<500k'
    WHEN Numeric_Price > 500000 AND Numeric_Price <= 750000 THEN '500-750k'
    WHEN Numeric_Price > 750000 AND Numeric_Price <= 1000000 THEN '750k-1M'
    WHEN Numeric_Price > 1000000 AND Numeric_Price <= 1500000 THEN '1-1.5M'
    WHEN Numeric_Price > 1500000 AND Numeric_Price <= 2500000 THEN '1.5-2.5M'
    WHEN Numeric_Price > 2500000 AND Numeric_Price <= 20000000 THEN '>2.5M' END AS bucket FROM t),
segs AS (
  SELECT 'type' AS kind, Property_Type AS segment, count(*) AS n, sqrt(avg((Numeric_Price - p) * (Numeric_Price - p))) AS rmse,
    avg(abs((Numeric_Price - p) / Numeric_Price)) * 100 AS mape FROM b
    WHERE Property_Type IN (SELECT Property_Type FROM top) GROUP BY Property_Type
  UNION ALL
  SELECT 'bucket', bucket, count(*), sqrt(avg((Numeric_Price - p) * (Numeric_Price - p))),
    avg(abs((Numeric_Price - p) / Numeric_Price)) * 100 FROM b WHERE bucket IS NOT NULL GROUP BY bucket
  UNION ALL
  SELECT 'year', CAST(Year AS STRING), count(*), sqrt(avg((Numeric_Price - p) * (Numeric_Price - p))),
    avg(abs((Numeric_Price - p) / Numeric_Price)) * 100 FROM b WHERE Year IS NOT NULL GROUP BY Year),
allb AS (SELECT 'bucket' AS kind, x AS segment FROM (VALUES ('<500k'), ('500-750k'), ('750k-1M'), ('1-1.5M'),
    ('1.5-2.5M'), ('>2.5M')) v(x))
SELECT kind, segment, CAST(n AS BIGINT) AS n, round_even(rmse, 4) AS rmse, round_even(mape, 6) AS mape FROM segs
UNION ALL
SELECT kind, segment, CAST(0 AS BIGINT), NULL, NULL FROM allb
WHERE segment NOT IN (SELECT segment FROM segs WHERE kind = 'bucket')"""))
def q_segment_errors(spark, sf_dir):
    t = split(spark, sf_dir).where("fold = 'test'").withColumn("pred", F.expr(standin.PRED))
    top = top_k_values(t, "Property_Type", 8)
    s = SC.segment_errors(t, "Numeric_Price", "pred", top)
    return s.select("kind", "segment", "n", F.bround("rmse", 4).alias("rmse"),
                    F.bround("mape", 6).alias("mape"))


@register("warnings", O.with_cleaned(FEAT_CTES + SCORED_CTE + """
, ks AS (SELECT DISTINCT Suburb FROM train)
SELECT Property_ID, Last_Updated, coalesce(Predicted_Price > 2500000, false) AS warn_luxury,
  coalesce(Predicted_Price < 500000, false) AS warn_budget, coalesce(is_new_build = 1, false) AS warn_new_build,
  Suburb NOT IN (SELECT Suburb FROM ks WHERE Suburb IS NOT NULL) OR Suburb IS NULL AS warn_cold_suburb
FROM signals"""))
def q_warnings(spark, sf_dir):
    known = split(spark, sf_dir).where("fold = 'train'").select("Suburb")
    w = SC.warnings(scored(spark, sf_dir), known)
    return w.select("Property_ID", "Last_Updated", "warn_luxury", "warn_budget", "warn_new_build",
                    "warn_cold_suburb")


@register("suburb_compare", O.with_cleaned(FEAT_CTES + SCORED_CTE + SUBSTATS_SQL.format(min_n=30) + """
SELECT s.Property_ID, s.Suburb, s.Predicted_Price, m.median_price AS suburb_median,
  round_even((s.Predicted_Price / m.median_price - 1) * 100, 1) AS vs_suburb_pct
FROM signals s LEFT JOIN substats m ON s.Suburb = m.Suburb"""))
def q_suburb_compare(spark, sf_dir):
    st = suburb_stats(sold_priced(base.cleaned(spark, sf_dir)), 30)
    c = SC.suburb_compare(scored(spark, sf_dir), st)
    return c.select("Property_ID", "Suburb", "Predicted_Price", "suburb_median", "vs_suburb_pct")


@register("filtered_listings", O.with_cleaned(FEAT_CTES + SCORED_CTE + """
SELECT Property_ID, Suburb, Property_Type, Beds, Predicted_Price, Deal_Signal FROM signals
WHERE Property_Type IN ('House', 'Townhouse') AND Predicted_Price BETWEEN 400000 AND 1200000
  AND Beds BETWEEN 2 AND 5 AND Deal_Signal IN ('Good Deal', 'Fair')"""))
def q_filtered(spark, sf_dir):
    v = SC.prediction_view(scored(spark, sf_dir))
    f = SC.filter_listings(v, types=["House", "Townhouse"], price_range=(400000, 1200000),
                           beds_range=(2, 5), signals=["Good Deal", "Fair"])
    return f.select("Property_ID", "Suburb", "Property_Type", "Beds", "Predicted_Price", "Deal_Signal")


SCATTER = ["Beds", "Baths", "Car_Spaces", "LandSize_sqm", "Distance_to_CBD_km", "crime_rate_per_100k", "dist_nearest_train_km"]


@register("scatter_samples", O.with_cleaned(FEAT_CTES + SCORED_CTE + ", points AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, Property_ID, Predicted_Price FROM signals WHERE {c} IS NOT NULL"
    for c in SCATTER) + """),
ranged AS (SELECT *, min(value) OVER (PARTITION BY feature) AS lo, max(value) OVER (PARTITION BY feature) AS hi FROM points),
binned AS (SELECT *, CAST(CASE WHEN hi > lo THEN least(19, floor((value - lo) / (hi - lo) * 20)) ELSE 0 END AS INT) AS bin FROM ranged),
taken AS (SELECT *, row_number() OVER (PARTITION BY feature, bin ORDER BY md5(CAST(Property_ID AS VARCHAR)), Property_ID) AS rn FROM binned)
SELECT feature, bin, round_even(value, 4) AS value, Property_ID, Predicted_Price FROM taken WHERE rn <= 25"""))
def q_scatter(spark, sf_dir):
    """V3: predicted price against seven features, a bounded sample of each part of their ranges."""
    return SC.scatter_samples(scored(spark, sf_dir), "Property_ID", "Predicted_Price", SCATTER).withColumn("value", F.bround("value", 4))
