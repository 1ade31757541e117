"""Registered queries: profiling (D1-D6, D19-D24, D30-D34, F-1..F-3, F-6, M4)."""

from pyspark.sql import functions as F

from estatelens.operators import clean as C
from estatelens.operators import profile as PR
from estatelens.operators.quantiles import exact_percentiles
from estatelens.params import DEFAULT
from estatelens.plans import base
from estatelens.plans import oracle_sql as O
from estatelens.plans.registry import register

# The columns of the correlation matrix, in their published order.
CORR_COLS = ["Numeric_Price", "Beds", "Baths", "Car_Spaces", "LandSize_sqm",
             "Distance_to_CBD_km", "dist_nearest_train_km", "Propertycount",
             "abs_median_income_weekly", "abs_median_age", "abs_population",
             "crime_rate_per_100k"]
ENRICH_COLS = ["abs_median_income_weekly", "abs_median_age", "abs_population",
               "crime_offence_count", "crime_rate_per_100k", "dist_nearest_train_km"]
RAW_COLS = ["Property_Type", "Date", "Beds", "Baths", "Car_Spaces", "LandSize_sqm",
            "Raw_Price", "Numeric_Price", "Latitude", "Longitude", "Distance_to_CBD_km",
            "abs_median_income_weekly", "abs_population", "crime_rate_per_100k"]
DESCRIBE_Q = {"p01": 0.01, "p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75,
              "p95": 0.95, "p99": 0.99}


def _r(c, n=4):
    return F.bround(c, n)


@register("status_counts", O.with_listings(
    "SELECT Status, CAST(count(*) AS BIGINT) AS n FROM listings GROUP BY Status"))
def q_status_counts(spark, sf_dir):
    return PR.value_counts(base.listings(spark, sf_dir), "Status")


@register("type_counts_top15", O.with_cleaned(
    "SELECT Property_Type, CAST(count(*) AS BIGINT) AS n FROM cleaned GROUP BY Property_Type "
    "ORDER BY n DESC, Property_Type LIMIT 15"))
def q_type_counts(spark, sf_dir):
    vc = PR.value_counts(base.cleaned(spark, sf_dir), "Property_Type")
    return PR.top_n(vc, [F.desc("n"), "Property_Type"], 15)


@register("raw_price_top20", O.with_listings(
    "SELECT Raw_Price, CAST(count(*) AS BIGINT) AS n FROM listings WHERE Raw_Price IS NOT NULL "
    "GROUP BY Raw_Price ORDER BY n DESC, Raw_Price LIMIT 20"))
def q_raw_price_top(spark, sf_dir):
    vc = PR.value_counts(base.listings(spark, sf_dir), "Raw_Price")
    return PR.top_n(vc, [F.desc("n"), "Raw_Price"], 20)


@register("type_share_pivot", O.with_cleaned("""
SELECT Property_Type,
  round_even(coalesce(count(*) FILTER (WHERE Status = 'Sold'), 0) * 100.0
     / (SELECT count(*) FROM cleaned WHERE Status = 'Sold'), 4) AS sold_pct,
  round_even(coalesce(count(*) FILTER (WHERE Status = 'For Sale'), 0) * 100.0
     / (SELECT count(*) FROM cleaned WHERE Status = 'For Sale'), 4) AS for_sale_pct
FROM cleaned GROUP BY Property_Type"""))
def q_type_share(spark, sf_dir):
    return PR.share_pivot(base.cleaned(spark, sf_dir), "Property_Type", "Status",
                          ["Sold", "For Sale"], ["sold_pct", "for_sale_pct"])


def _missing_sql():
    parts = []
    for c in RAW_COLS:
        parts.append(f"SELECT Status, '{c}' AS column, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT)"
                     f" AS n_null, round_even(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 4)"
                     f" AS pct_null FROM listings GROUP BY Status")
    return O.with_listings("SELECT * FROM (" + " UNION ALL ".join(parts) + ") t WHERE n_null > 0")


@register("missingness", _missing_sql())
def q_missingness(spark, sf_dir):
    return PR.missingness(base.listings(spark, sf_dir), RAW_COLS)


@register("fill_rate", O.with_listings(" UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count({c}) AS BIGINT) AS n_filled, CAST(count(*) AS BIGINT) AS n_rows, "
    f"round_even(count({c}) * 100.0 / count(*), 4) AS pct_filled FROM listings" for c in ENRICH_COLS)))
def q_fill_rate(spark, sf_dir):
    return PR.fill_rate(base.listings(spark, sf_dir), ENRICH_COLS)


@register("duplicate_counts", O.with_listings("""
SELECT Status, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT Property_ID) AS BIGINT) AS n_ids,
       CAST(count(*) - count(DISTINCT Property_ID) AS BIGINT) AS n_duplicates
FROM listings GROUP BY Status
UNION ALL
SELECT 'ALL', CAST(count(*) AS BIGINT), CAST(count(DISTINCT Property_ID) AS BIGINT),
       CAST(count(*) - count(DISTINCT Property_ID) AS BIGINT) FROM listings"""))
def q_dup_counts(spark, sf_dir):
    return PR.duplicate_counts(base.listings(spark, sf_dir), "Property_ID")


@register("duplicate_rows", O.with_listings("""
SELECT Property_ID, Status, Last_Updated, Numeric_Price FROM listings
WHERE Property_ID IN (SELECT Property_ID FROM listings GROUP BY Property_ID HAVING count(*) > 1)"""))
def q_dup_rows(spark, sf_dir):
    d = PR.duplicated_rows(base.listings(spark, sf_dir), "Property_ID")
    return d.select("Property_ID", "Status", "Last_Updated", "Numeric_Price")


def _describe_sql():
    qs = ", ".join(f"round_even(quantile_cont(Numeric_Price, {q}), 4) AS {k}"
                   for k, q in DESCRIBE_Q.items())
    return O.with_cleaned(f"""
SELECT Status, CAST(count(Numeric_Price) AS BIGINT) AS count, round_even(avg(Numeric_Price), 4) AS mean,
  round_even(stddev_samp(Numeric_Price), 4) AS std, min(Numeric_Price) AS min,
  max(Numeric_Price) AS max, {qs}
FROM cleaned WHERE Numeric_Price IS NOT NULL GROUP BY Status""")


@register("describe_price", _describe_sql())
def q_describe(spark, sf_dir):
    d = PR.describe(base.cleaned(spark, sf_dir), "Numeric_Price", ["Status"], DESCRIBE_Q)
    return d.select("Status", "count", _r(F.col("mean")).alias("mean"), _r(F.col("std")).alias("std"),
                    "min", "max", *[_r(F.col(k)).alias(k) for k in DESCRIBE_Q])


@register("tail_counts", O.with_cleaned("""
SELECT Status,
  CAST(count(*) FILTER (WHERE Beds > 10) AS BIGINT) AS beds_over_10,
  CAST(count(*) FILTER (WHERE Baths > 10) AS BIGINT) AS baths_over_10,
  CAST(count(*) FILTER (WHERE Car_Spaces > 10) AS BIGINT) AS cars_over_10,
  CAST(count(*) FILTER (WHERE Beds = 0 AND is_land = 0) AS BIGINT) AS zero_beds_not_land,
  CAST(count(*) FILTER (WHERE Beds > 0 AND Baths > 2 * Beds) AS BIGINT) AS baths_over_2x_beds,
  CAST(count(*) FILTER (WHERE LandSize_sqm = 0 AND is_land = 0) AS BIGINT) AS zero_land_not_land
FROM flagged GROUP BY Status"""))
def q_tail_counts(spark, sf_dir):
    fl = base.cleaned_result(spark, sf_dir).flagged
    c = F.col
    return fl.groupBy("Status").agg(
        F.count_if(c("Beds") > 10).alias("beds_over_10"),
        F.count_if(c("Baths") > 10).alias("baths_over_10"),
        F.count_if(c("Car_Spaces") > 10).alias("cars_over_10"),
        F.count_if((c("Beds") == 0) & (c("is_land") == 0)).alias("zero_beds_not_land"),
        F.count_if((c("Beds") > 0) & (c("Baths") > 2 * c("Beds"))).alias("baths_over_2x_beds"),
        F.count_if((c("LandSize_sqm") == 0) & (c("is_land") == 0)).alias("zero_land_not_land"))


@register("distincts", O.with_cleaned("""
SELECT Status, CAST(count(DISTINCT Suburb) AS BIGINT) AS n_suburbs,
       CAST(count(DISTINCT Property_Type) AS BIGINT) AS n_types
FROM cleaned GROUP BY Status"""))
def q_distincts(spark, sf_dir):
    return base.cleaned(spark, sf_dir).groupBy("Status").agg(
        F.count_distinct("Suburb").alias("n_suburbs"),
        F.count_distinct("Property_Type").alias("n_types"))


@register("flag_share", O.with_cleaned(f"""
SELECT Status, round_even(avg(is_land) * 100, 4) AS pct_land,
  round_even(avg(out_of_metro) * 100, 4) AS pct_out_of_metro,
  round_even(avg(CASE WHEN Property_Type IN {O.NEWB} THEN 1 ELSE 0 END) * 100, 4) AS pct_new_build
FROM cleaned GROUP BY Status"""))
def q_flag_share(spark, sf_dir):
    nb = F.col("Property_Type").isin(*DEFAULT.new_build_types).cast("int")
    return base.cleaned(spark, sf_dir).groupBy("Status").agg(
        _r(F.avg("is_land") * 100).alias("pct_land"),
        _r(F.avg("out_of_metro") * 100).alias("pct_out_of_metro"),
        _r(F.avg(nb) * 100).alias("pct_new_build"))


@register("land_type_crosstab", O.with_cleaned("""
SELECT Property_Type, CAST(count(*) AS BIGINT) AS n FROM flagged WHERE is_land = 1
GROUP BY Property_Type ORDER BY n DESC, Property_Type NULLS FIRST LIMIT 10"""))
def q_land_crosstab(spark, sf_dir):
    fl = base.cleaned_result(spark, sf_dir).flagged.where("is_land = 1")
    vc = PR.value_counts(fl, "Property_Type", dropna=False)
    return PR.top_n(vc, [F.desc("n"), F.asc_nulls_first("Property_Type")], 10)


def _corr_sql():
    parts = []
    for i, a in enumerate(CORR_COLS):
        for b in CORR_COLS[i + 1:]:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round_even(corr({a}, {b}), 6) AS r "
                         f"FROM cleaned WHERE Status = 'Sold'")
    return O.with_cleaned(" UNION ALL ".join(parts))


@register("corr_matrix", _corr_sql())
def q_corr(spark, sf_dir):
    c = base.cleaned(spark, sf_dir).where("Status = 'Sold'")
    m = PR.corr_matrix(c, CORR_COLS)
    return m.select("col_a", "col_b", F.bround("r", 6).alias("r"))


@register("histogram_log_price", O.with_cleaned("""
, src AS (SELECT Status, ln(1 + Numeric_Price) AS x FROM cleaned WHERE Numeric_Price IS NOT NULL),
e AS (SELECT min(x) AS lo, max(x) AS hi FROM src),
b AS (SELECT Status, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) / ((hi - lo) / 30)), 29) END AS INT)
        AS bin, lo, hi FROM src, e)
SELECT Status, bin, CAST(count(*) AS BIGINT) AS n,
  round_even(min(lo) + bin * (min(hi) - min(lo)) / 30, 6) AS bin_lo,
  round_even(min(lo) + (bin + 1) * (min(hi) - min(lo)) / 30, 6) AS bin_hi
FROM b GROUP BY Status, bin"""))
def q_hist(spark, sf_dir):
    h = PR.histogram(base.cleaned(spark, sf_dir), "Numeric_Price", "Status", 30, log1p=True)
    return h.select("Status", "bin", "n", F.bround("bin_lo", 6).alias("bin_lo"),
                    F.bround("bin_hi", 6).alias("bin_hi"))


def _box_sql(by, source):
    """Quartiles, whiskers and outliers of ``y`` per ``by`` in ``source`` (a CTE src)."""
    return O.with_cleaned(f"""
, src AS ({source}),
q AS (SELECT {by}, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.5) AS median,
         quantile_cont(y, 0.75) AS q3, count(*) AS n FROM src GROUP BY {by})
SELECT q.{by}, round_even(q1, 6) AS q1, round_even(median, 6) AS median, round_even(q3, 6) AS q3,
  CAST(n AS BIGINT) AS n,
  round_even(min(y) FILTER (WHERE y >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_lo,
  round_even(max(y) FILTER (WHERE y <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_hi,
  CAST(count(*) FILTER (WHERE y < q1 - 1.5 * (q3 - q1) OR y > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS n_outliers
FROM q JOIN src ON q.{by} = src.{by} GROUP BY q.{by}, q1, median, q3, n""")


def _box(src, by):
    b = PR.boxplot(src, "y", by)
    return b.select(by, *[F.bround(k, 6).alias(k) for k in ["q1", "median", "q3"]], "n",
                    F.bround("whisker_lo", 6).alias("whisker_lo"),
                    F.bround("whisker_hi", 6).alias("whisker_hi"), "n_outliers")


def _rooms_sql(by, top):
    return _box_sql(by, f"""SELECT CAST({by} AS INT) AS {by}, ln(1 + Numeric_Price) AS y FROM cleaned
          WHERE Status = 'Sold' AND Numeric_Price IS NOT NULL AND {by} BETWEEN 0 AND {top}""")


def _rooms_box(spark, sf_dir, by, top):
    c = base.cleaned(spark, sf_dir).where(f"Status = 'Sold' AND Numeric_Price IS NOT NULL AND {by} BETWEEN 0 AND {top}")
    return _box(c.select(F.col(by).cast("int").alias(by), F.log1p("Numeric_Price").alias("y")), by)


@register("boxplot_beds", _rooms_sql("Beds", 7))
def q_boxplot(spark, sf_dir):
    return _rooms_box(spark, sf_dir, "Beds", 7)


@register("boxplot_baths", _rooms_sql("Baths", 5))
def q_boxplot_baths(spark, sf_dir):
    return _rooms_box(spark, sf_dir, "Baths", 5)


@register("boxplot_types", _box_sql("Property_Type", """
  SELECT Property_Type, ln(1 + Numeric_Price) AS y FROM cleaned
  WHERE Status = 'Sold' AND Numeric_Price IS NOT NULL AND Property_Type IN (
    SELECT Property_Type FROM cleaned WHERE Status = 'Sold' AND Numeric_Price IS NOT NULL AND Property_Type IS NOT NULL
    GROUP BY Property_Type ORDER BY count(*) DESC, Property_Type LIMIT 8)"""))
def q_boxplot_types(spark, sf_dir):
    """The eight types with most priced sales."""
    sold = base.cleaned(spark, sf_dir).where("Status = 'Sold' AND Numeric_Price IS NOT NULL AND Property_Type IS NOT NULL")
    top = sold.groupBy("Property_Type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "Property_Type").limit(8)
    src = sold.join(F.broadcast(top.select("Property_Type")), "Property_Type", "left_semi")   # eight rows
    return _box(src.select("Property_Type", F.log1p("Numeric_Price").alias("y")), "Property_Type")


@register("sanity", O.with_cleaned("""
SELECT Status, max(Beds) AS max_beds, max(Baths) AS max_baths, max(Car_Spaces) AS max_cars,
  round_even(max(LandSize_sqm), 4) AS max_land, min(Numeric_Price) AS min_price, max(Numeric_Price) AS max_price,
  CAST(count(*) FILTER (WHERE Numeric_Price IS NULL) AS BIGINT) AS null_price,
  CAST(count(*) FILTER (WHERE Beds IS NULL) AS BIGINT) AS null_beds,
  CAST(count(*) FILTER (WHERE LandSize_sqm IS NULL) AS BIGINT) AS null_land
FROM cleaned GROUP BY Status"""))
def q_sanity(spark, sf_dir):
    return base.cleaned(spark, sf_dir).groupBy("Status").agg(
        F.max("Beds").alias("max_beds"), F.max("Baths").alias("max_baths"),
        F.max("Car_Spaces").alias("max_cars"), _r(F.max("LandSize_sqm")).alias("max_land"),
        F.min("Numeric_Price").alias("min_price"), F.max("Numeric_Price").alias("max_price"),
        F.count_if(F.col("Numeric_Price").isNull()).alias("null_price"),
        F.count_if(F.col("Beds").isNull()).alias("null_beds"),
        F.count_if(F.col("LandSize_sqm").isNull()).alias("null_land"))


@register("date_coverage", O.with_listings("""
, parsed AS (SELECT *, CAST(try_strptime(Date, '%d %b %Y') AS DATE) AS Date_parsed FROM listings)
SELECT Status, min(Date_parsed) AS min_date, max(Date_parsed) AS max_date,
  round_even(avg(CASE WHEN Date_parsed IS NULL THEN 1.0 ELSE 0.0 END) * 100, 4) AS pct_null,
  CAST(min(year(Date_parsed)) AS INT) AS min_year, CAST(max(year(Date_parsed)) AS INT) AS max_year
FROM parsed GROUP BY Status"""))
def q_date_coverage(spark, sf_dir):
    p = C.parse_dates(base.listings(spark, sf_dir))
    return p.groupBy("Status").agg(
        F.min("Date_parsed").alias("min_date"), F.max("Date_parsed").alias("max_date"),
        _r(F.avg(F.col("Date_parsed").isNull().cast("double")) * 100).alias("pct_null"),
        F.min("Year").alias("min_year"), F.max("Year").alias("max_year"))


@register("top_suburbs_volume", O.with_cleaned(
    "SELECT Suburb, CAST(count(*) AS BIGINT) AS n FROM cleaned GROUP BY Suburb "
    "ORDER BY n DESC, Suburb LIMIT 10"))
def q_top_suburbs(spark, sf_dir):
    vc = PR.value_counts(base.cleaned(spark, sf_dir), "Suburb")
    return PR.top_n(vc, [F.desc("n"), "Suburb"], 10)


@register("largest_land_non_land", O.with_cleaned(
    "SELECT Property_ID, Status, Last_Updated, Property_Type, LandSize_sqm FROM flagged "
    "WHERE is_land = 0 AND LandSize_sqm IS NOT NULL "
    "ORDER BY LandSize_sqm DESC, Property_ID, Last_Updated LIMIT 10"))
def q_largest_land(spark, sf_dir):
    fl = base.cleaned_result(spark, sf_dir).flagged.where("is_land = 0 AND LandSize_sqm IS NOT NULL")
    return PR.top_n(fl.select("Property_ID", "Status", "Last_Updated", "Property_Type", "LandSize_sqm"),
                    [F.desc("LandSize_sqm"), "Property_ID", "Last_Updated"], 10)


@register("price_bounds", O.with_cleaned("""
SELECT round_even(quantile_cont(ln(1 + Numeric_Price), 0.02), 6) AS lo,
       round_even(quantile_cont(ln(1 + Numeric_Price), 0.98), 6) AS hi
FROM cleaned WHERE Status = 'Sold' AND Numeric_Price IS NOT NULL"""))
def q_price_bounds(spark, sf_dir):
    c = base.cleaned(spark, sf_dir).where("Status = 'Sold' AND Numeric_Price IS NOT NULL")
    q = exact_percentiles(c.select(F.lit(1).alias("k"), F.log1p("Numeric_Price").alias("x")),
                          ["k"], "x", {"lo": 0.02, "hi": 0.98})
    return q.select(F.bround("lo", 6).alias("lo"), F.bround("hi", 6).alias("hi"))


@register("hash_sample")
def q_hash_sample(spark, sf_dir):
    c = base.cleaned(spark, sf_dir).where("Status = 'Sold'")
    return PR.hash_sample(c.select("Property_ID", "Numeric_Price", "Suburb"), 2000, "Property_ID")
