"""Registered queries: time series."""

from pyspark.sql import functions as F

from estatelens.operators import timeseries as T
from estatelens.plans import base
from estatelens.plans import oracle_sql as O
from estatelens.plans.registry import register

BIG_TYPES = ["House", "Apartment / Unit / Flat", "Townhouse", "Vacant land"]
SP = "(SELECT * FROM cleaned WHERE Status = 'Sold' AND Numeric_Price IS NOT NULL)"


@register("yearly_median_yoy", O.with_cleaned(f"""
, y AS (SELECT Year, CAST(count(*) AS BIGINT) AS n, quantile_cont(Numeric_Price, 0.5) AS median
        FROM {SP} s GROUP BY Year HAVING count(*) >= 200)
SELECT Year, n, round_even(median, 4) AS median, lag(Year) OVER (ORDER BY Year) AS prev_year,
  round_even((median / lag(median) OVER (ORDER BY Year) - 1) * 100, 1) AS yoy_pct FROM y"""))
def q_yearly(spark, sf_dir):
    y = T.yearly_median_yoy(T.sold_priced(base.cleaned(spark, sf_dir)))
    return y.withColumn("median", F.bround("median", 4))


@register("year_type_median", O.with_cleaned(f"""
SELECT Year, Property_Type, CAST(count(*) AS BIGINT) AS n,
  round_even(quantile_cont(Numeric_Price, 0.5), 4) AS median
FROM {SP} s WHERE Property_Type IN ('House', 'Apartment / Unit / Flat', 'Townhouse', 'Vacant land')
GROUP BY Year, Property_Type HAVING count(*) >= 50"""))
def q_year_type(spark, sf_dir):
    s = T.sold_priced(base.cleaned(spark, sf_dir)).where(F.col("Property_Type").isin(*BIG_TYPES))
    m = T.median_by(s, ["Year", "Property_Type"], min_n=50)
    return m.select("Year", "Property_Type", "n", F.bround("median", 4).alias("median"))


@register("month_seasonality", O.with_cleaned(f"""
, m AS (SELECT Month, count(*) AS n, quantile_cont(Numeric_Price, 0.5) AS median FROM {SP} s GROUP BY Month),
o AS (SELECT quantile_cont(Numeric_Price, 0.5) AS overall FROM {SP} s2),
months AS (SELECT CAST(range AS INT) AS Month FROM range(1, 13))
SELECT months.Month, CAST(coalesce(n, 0) AS BIGINT) AS n, round_even(median, 0) AS median_price,
  round_even((median / overall - 1) * 100, 1) AS vs_overall_pct
FROM months LEFT JOIN m ON months.Month = m.Month CROSS JOIN o"""))
def q_month(spark, sf_dir):
    return T.month_seasonality(spark, T.sold_priced(base.cleaned(spark, sf_dir)))


@register("type_median_top8", O.with_cleaned(f"""
, top AS (SELECT Property_Type FROM {SP} s WHERE Property_Type IS NOT NULL GROUP BY Property_Type
          ORDER BY count(*) DESC, Property_Type LIMIT 8)
SELECT Property_Type, CAST(count(*) AS BIGINT) AS n, round_even(quantile_cont(Numeric_Price, 0.5), 4) AS median
FROM {SP} s2 WHERE Property_Type IN (SELECT Property_Type FROM top) GROUP BY Property_Type"""))
def q_type_top8(spark, sf_dir):
    m = T.median_for_top_types(T.sold_priced(base.cleaned(spark, sf_dir)), 8)
    return m.select("Property_Type", "n", F.bround("median", 4).alias("median"))
