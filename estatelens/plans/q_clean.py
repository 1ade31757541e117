"""Registered queries: cleaning stage."""

from pyspark.sql import functions as F

from estatelens.operators import clean as C
from estatelens.plans import base
from estatelens.plans import oracle_sql as O
from estatelens.plans.registry import register

ROWKEY = ["Property_ID", "Status", "Last_Updated"]
RK = "Property_ID, Status, Last_Updated"


@register("drop_rules", O.with_listings(f"""
, parsed AS (SELECT *, CAST(try_strptime(Date, '%d %b %Y') AS DATE) AS Date_parsed FROM listings)
SELECT {RK}, Date_parsed FROM parsed
WHERE NOT (Status = 'Sold' AND Date_parsed IS NULL)
  AND NOT (Status = 'For Sale' AND Property_Type IS NULL AND LandSize_sqm IS NULL AND Raw_Price IS NULL)
"""))
def q_drop_rules(spark, sf_dir):
    kept = C.apply_drop_rules(C.parse_dates(base.listings(spark, sf_dir)))
    return kept.select(*ROWKEY, "Date_parsed")


@register("dedup_recent", O.with_cleaned(
    "SELECT Property_ID, Last_Updated, Numeric_Price, Raw_Price FROM dedup WHERE Status = 'For Sale'"))
def q_dedup_recent(spark, sf_dir):
    kept = C.apply_drop_rules(C.parse_dates(base.listings(spark, sf_dir)))
    d = C.dedup_recent(kept)
    return d.where(F.col("Status") == "For Sale").select(
        "Property_ID", "Last_Updated", "Numeric_Price", "Raw_Price")


@register("land_flag", O.with_cleaned(f"SELECT {RK}, is_land FROM flagged"))
def q_land_flag(spark, sf_dir):
    return base.cleaned_result(spark, sf_dir).flagged.select(*ROWKEY, "is_land")


@register("land_caps", O.with_cleaned(
    "SELECT Property_Type, round_even(cap, 4) AS cap FROM caps"))
def q_land_caps(spark, sf_dir):
    caps = base.cleaned_result(spark, sf_dir).caps
    return caps.select("Property_Type", F.bround("cap", 4).alias("cap"))


@register("room_caps", O.with_cleaned(f"SELECT {RK}, Beds, Baths, Car_Spaces FROM cleaned"))
def q_room_caps(spark, sf_dir):
    return base.cleaned(spark, sf_dir).select(*ROWKEY, "Beds", "Baths", "Car_Spaces")


@register("land_rules", O.with_cleaned(
    f"SELECT {RK}, Property_Type, round_even(LandSize_sqm, 4) AS LandSize_sqm FROM cleaned"))
def q_land_rules(spark, sf_dir):
    return base.cleaned(spark, sf_dir).select(
        *ROWKEY, "Property_Type", F.bround("LandSize_sqm", 4).alias("LandSize_sqm"))


@register("envelope_flag", O.with_cleaned(f"SELECT {RK}, out_of_metro FROM cleaned"))
def q_envelope(spark, sf_dir):
    return base.cleaned(spark, sf_dir).select(*ROWKEY, "out_of_metro")


@register("price_rules", O.with_cleaned(f"SELECT {RK}, Numeric_Price, Raw_Price FROM cleaned"))
def q_price_rules(spark, sf_dir):
    return base.cleaned(spark, sf_dir).select(*ROWKEY, "Numeric_Price", "Raw_Price")


@register("rare_types", O.with_cleaned(
    "SELECT Property_Type, CAST(count(*) AS BIGINT) AS n FROM cleaned "
    "GROUP BY Property_Type HAVING count(*) < 50"))
def q_rare(spark, sf_dir):
    return C.rare_types(base.cleaned(spark, sf_dir))


@register("clean_union", O.with_cleaned(
    "SELECT * REPLACE (round_even(LandSize_sqm, 4) AS LandSize_sqm) FROM cleaned"))
def q_clean_union(spark, sf_dir):
    c = base.cleaned(spark, sf_dir)
    return c.withColumn("LandSize_sqm", F.bround("LandSize_sqm", 4))


@register("clean_steps", O.with_cleaned("""
, n AS (SELECT (SELECT count(*) FROM listings) AS n0,
  (SELECT count(*) FROM listings WHERE Status IN ('Sold', 'For Sale')) AS n1,
  (SELECT count(*) FROM listings WHERE Status = 'For Sale')
    + (SELECT count(*) FROM kept WHERE Status = 'Sold') AS n2,
  (SELECT count(*) FROM kept) AS n3, (SELECT count(*) FROM dedup) AS n4, (SELECT count(*) FROM cleaned) AS n5),
s AS (
  SELECT 1 AS step_no, 'other_status' AS step, n0 AS a, n1 AS b FROM n
  UNION ALL SELECT 2, 'sold_no_date', n1, n2 FROM n UNION ALL SELECT 3, 'forsale_broken', n2, n3 FROM n
  UNION ALL SELECT 4, 'forsale_repeated', n3, n4 FROM n UNION ALL SELECT 5, 'sold_price_range', n4, n5 FROM n)
SELECT step_no, step, CAST(a AS BIGINT) AS rows_before, CAST(a - b AS BIGINT) AS removed, CAST(b AS BIGINT) AS rows_after FROM s"""))
def q_clean_steps(spark, sf_dir):
    return C.accounted_clean(base.listings(spark, sf_dir))[1]


@register("removal_audit", O.with_listings("""
, parsed AS (SELECT *, CAST(try_strptime(Date, '%d %b %Y') AS DATE) AS Date_parsed FROM listings)
SELECT Status, CAST(count(*) AS BIGINT) AS rows_in,
  CAST(count(*) FILTER (WHERE Status = 'Sold' AND Date_parsed IS NULL) AS BIGINT) AS sold_no_date,
  CAST(count(*) FILTER (WHERE Status = 'For Sale' AND Property_Type IS NULL AND LandSize_sqm IS NULL
        AND Raw_Price IS NULL) AS BIGINT) AS forsale_broken,
  CAST(count(*) FILTER (WHERE Numeric_Price IS NOT NULL
        AND NOT (Numeric_Price BETWEEN 20000 AND 20000000)) AS BIGINT) AS price_out_of_range,
  CAST(count(*) - count(DISTINCT Property_ID) AS BIGINT) AS duplicate_ids
FROM parsed GROUP BY Status
"""))
def q_removal_audit(spark, sf_dir):
    return C.removal_audit(base.listings(spark, sf_dir))
