"""Registered queries: drift and cold start."""

from pyspark.sql import functions as F

from estatelens.operators import drift as D
from estatelens.plans import base
from estatelens.plans import oracle_sql as O
from estatelens.plans.registry import register

DRIFT_COLS = ["Beds", "Baths", "Car_Spaces", "LandSize_sqm", "Distance_to_CBD_km",
              "dist_nearest_train_km", "abs_median_income_weekly", "abs_median_age",
              "abs_population", "crime_rate_per_100k"]


def _ks_sql():
    parts = []
    for c in DRIFT_COLS:
        parts.append(f"""SELECT '{c}' AS feature, v, CASE WHEN Status = 'Sold' THEN 1 ELSE 0 END AS a,
  CASE WHEN Status = 'For Sale' THEN 1 ELSE 0 END AS b FROM (SELECT Status, CAST({c} AS DOUBLE) AS v
  FROM cleaned) t WHERE v IS NOT NULL""")
    meds = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, quantile_cont({c}, 0.5) FILTER (WHERE Status = 'Sold') AS median_a, "
        f"quantile_cont({c}, 0.5) FILTER (WHERE Status = 'For Sale') AS median_b FROM cleaned" for c in DRIFT_COLS)
    return O.with_cleaned(f"""
, long AS ({' UNION ALL '.join(parts)}),
cnt AS (SELECT feature, v, sum(a) AS na, sum(b) AS nb FROM long GROUP BY feature, v),
cum AS (SELECT feature, v, sum(na) OVER (PARTITION BY feature ORDER BY v) AS ca,
          sum(nb) OVER (PARTITION BY feature ORDER BY v) AS cb,
          sum(na) OVER (PARTITION BY feature) AS Na, sum(nb) OVER (PARTITION BY feature) AS Nb FROM cnt),
st AS (SELECT feature, max(abs(ca / Na - cb / Nb)) AS ks_stat, min(Na) AS Na, min(Nb) AS Nb FROM cum GROUP BY feature),
meds AS ({meds})
SELECT st.feature, median_a, median_b, round_even(ks_stat, 9) AS ks_stat,
  CAST(Na AS BIGINT) AS n_a, CAST(Nb AS BIGINT) AS n_b
FROM st JOIN meds ON st.feature = meds.feature""")


@register("ks_drift", _ks_sql())
def q_ks(spark, sf_dir):
    k = D.ks_drift(base.cleaned(spark, sf_dir), DRIFT_COLS, "Status", "Sold", "For Sale")
    return k.select("feature", "median_a", "median_b", F.bround("ks_stat", 9).alias("ks_stat"),
                    "n_a", "n_b")


def _ks_p_sql():
    base_sql = _ks_sql()
    head = base_sql[:base_sql.index("\nSELECT st.feature")]
    return head + """,
lam AS (SELECT feature, ks_stat, Na, Nb,
          (sqrt(Na * Nb / (Na + Nb)) + 0.12 + 0.11 / sqrt(Na * Nb / (Na + Nb))) * ks_stat AS lam FROM st),
pv AS (SELECT feature, CASE WHEN lam = 0 THEN 1.0 ELSE greatest(1 - sqrt(2 * pi()) / lam
          * sum(exp(0 - ((2 * k - 1) * pi()) ** 2 / (8 * greatest(lam, 1e-9) ** 2))), 0.0) END AS p_value
       FROM lam, range(1, 2001) t(k) GROUP BY feature, lam)
SELECT lam.feature, median_a, median_b, round_even(ks_stat, 9) AS ks_stat, round_even(p_value, 9) AS p_value,
  CAST(Na AS BIGINT) AS n_a, CAST(Nb AS BIGINT) AS n_b
FROM lam JOIN meds ON lam.feature = meds.feature JOIN pv ON lam.feature = pv.feature"""


@register("ks_drift_pvalues", _ks_p_sql())
def q_ks_p(spark, sf_dir):
    k = D.ks_drift(base.cleaned(spark, sf_dir), DRIFT_COLS, "Status", "Sold", "For Sale")
    return k.select("feature", "median_a", "median_b", F.bround("ks_stat", 9).alias("ks_stat"),
                    F.bround("p_value", 9).alias("p_value"), "n_a", "n_b") \
        .orderBy(F.desc("ks_stat"), "feature")


def _cold_sql(col):
    return f"""SELECT '{col}' AS dimension,
  CAST(count(*) FILTER (WHERE na > 0) AS BIGINT) AS n_values_a,
  CAST(count(*) FILTER (WHERE nb > 0) AS BIGINT) AS n_values_b,
  CAST(count(*) FILTER (WHERE na > 0 AND nb > 0) AS BIGINT) AS n_shared,
  CAST(count(*) FILTER (WHERE na = 0 AND nb > 0) AS BIGINT) AS n_cold_start,
  CAST(count(*) FILTER (WHERE na > 0 AND nb = 0) AS BIGINT) AS n_absent,
  CAST(coalesce(sum(nb) FILTER (WHERE na = 0), 0) AS BIGINT) AS cold_rows,
  CAST(sum(nb) AS BIGINT) AS rows_b
FROM (SELECT {col}, count(*) FILTER (WHERE Status = 'Sold') AS na,
        count(*) FILTER (WHERE Status = 'For Sale') AS nb FROM cleaned WHERE {col} IS NOT NULL GROUP BY {col}) t"""


@register("cold_start", O.with_cleaned(_cold_sql("Suburb") + " UNION ALL " + _cold_sql("Property_Type")))
def q_cold(spark, sf_dir):
    c = base.cleaned(spark, sf_dir)
    return D.cold_start(c, "Suburb", "Status", "Sold", "For Sale").unionByName(
        D.cold_start(c, "Property_Type", "Status", "Sold", "For Sale"))


@register("cold_start_examples", O.with_cleaned("""
SELECT DISTINCT Suburb FROM cleaned WHERE Status = 'For Sale' AND Suburb IS NOT NULL
  AND Suburb NOT IN (SELECT Suburb FROM cleaned WHERE Status = 'Sold' AND Suburb IS NOT NULL)
ORDER BY Suburb LIMIT 10"""))
def q_cold_examples(spark, sf_dir):
    return D.cold_start_examples(base.cleaned(spark, sf_dir), "Suburb", "Status", "Sold", "For Sale")


@register("id_overlap", O.with_listings("""
SELECT Property_ID FROM listings WHERE Status = 'Sold'
INTERSECT SELECT Property_ID FROM listings WHERE Status = 'For Sale'"""))
def q_overlap(spark, sf_dir):
    return D.id_overlap(base.listings(spark, sf_dir), "Property_ID", "Status", "Sold", "For Sale")
