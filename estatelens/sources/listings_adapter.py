"""LISTINGS adapter: one property listing per ``orders`` row.

The driver tables hold no listings, so we derive them from ``orders`` with
integer arithmetic, ``%``, ``CASE`` and concatenation only.  Each column is
an SQL expression text that both Spark SQL and DuckDB evaluate identically,
so the DuckDB oracle can rebuild the very same input.  Column names follow
the ENRICHED listings schema, so every downstream operator sees the shape a
real enriched listings file has.

``v`` is the version of a row: 0 for the original, 1 for the re-listed copy
that For Sale rows with ``o_orderkey % 50 = 0`` get one day later at a
lower price (duplicates for the keep-most-recent rule).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

K = "k"
P = "p"
STATUS = "(CASE WHEN o_orderstatus = 'O' THEN 'For Sale' ELSE 'Sold' END)"
SUBURB = "suburb"
MONTH_NAME = ("(CASE month(o_orderdate) WHEN 1 THEN 'Jan' WHEN 2 THEN 'Feb' "
              "WHEN 3 THEN 'Mar' WHEN 4 THEN 'Apr' WHEN 5 THEN 'May' "
              "WHEN 6 THEN 'Jun' WHEN 7 THEN 'Jul' WHEN 8 THEN 'Aug' "
              "WHEN 9 THEN 'Sep' WHEN 10 THEN 'Oct' WHEN 11 THEN 'Nov' "
              "ELSE 'Dec' END)")
N = "CAST(floor(o_totalprice) AS BIGINT)"
LAT_NULL = "lat_null"


def _dbl(e: str) -> str:
    return f"CAST({e} AS DOUBLE)"


# Helper columns computed once per row (stage 1), referenced by COLUMNS.
PRE: list[tuple[str, str]] = [
    ("k", "o_orderkey"),
    ("p", "(3000 + o_custkey % 100)"),
    ("suburb", "(CASE WHEN o_orderstatus = 'O' AND o_orderkey % 97 = 0 "
               "THEN 'COLD' || CAST(o_orderkey % 3 AS STRING) "
               "ELSE 'S' || CAST(o_custkey % 40 AS STRING) END)"),
    ("lat_null", "(o_orderkey % 307 = 0)"),
    ("base_price", f"(CASE WHEN o_orderkey % 8 IN (5, 7) THEN NULL "
                   f"WHEN o_orderkey % 401 = 0 THEN {_dbl('5')} "
                   f"WHEN o_orderkey % 503 = 0 THEN {_dbl('30000000')} "
                   f"ELSE o_totalprice END)"),
    ("base_raw", f"(CASE o_orderkey % 8 "
                 f"WHEN 0 THEN '$' || CAST({N} AS STRING) "
                 f"WHEN 1 THEN '$' || CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS STRING) || 'k' "
                 f"WHEN 2 THEN '$' || CAST({N} AS STRING) || ' - $' || CAST({N} + 40000 AS STRING) "
                 f"WHEN 3 THEN '$' || CAST({N} AS STRING) || ' to $' || CAST({N} + 60000 AS STRING) "
                 f"WHEN 4 THEN '$' || CAST(CAST(floor(o_totalprice / 1000000) AS BIGINT) AS STRING) || '.' "
                 f"|| CAST(CAST(floor(o_totalprice / 100000) AS BIGINT) % 10 AS STRING) || 'm' "
                 f"WHEN 5 THEN 'Contact Agent' "
                 f"WHEN 6 THEN '$1 million' "
                 f"ELSE NULL END)"),
]
BASE_RAW = "base_raw"
BASE_PRICE = "base_price"

# (name, expression) in ENRICHED column order; ``v`` is the row version.
COLUMNS: list[tuple[str, str]] = [
    ("Property_ID", f"CAST({K} AS STRING)"),
    ("Status", STATUS),
    ("Full_Address", f"CAST({K} AS STRING) || ' Example St, ' || {SUBURB} "
                     f"|| ' VIC ' || CAST({P} AS STRING)"),
    ("Suburb", SUBURB),
    ("Postcode", f"CAST({P} AS INT)"),
    ("Property_Type", f"(CASE WHEN {K} % 499 = 0 THEN 'Duplex' "
                      f"WHEN {K} % 20 < 10 THEN 'House' "
                      f"WHEN {K} % 20 < 13 THEN 'Townhouse' "
                      f"WHEN {K} % 20 < 16 THEN 'Apartment / Unit / Flat' "
                      f"WHEN {K} % 20 = 16 THEN 'Vacant land' "
                      f"WHEN {K} % 20 = 17 THEN 'Rural' "
                      f"WHEN {K} % 20 = 18 THEN 'New House & Land' "
                      f"ELSE NULL END)"),
    ("Date", f"(CASE WHEN o_orderstatus = 'O' OR {K} % 211 = 0 THEN NULL "
             f"ELSE lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || ' ' "
             f"|| {MONTH_NAME} || ' ' || CAST(year(o_orderdate) AS STRING) END)"),
    ("Beds", _dbl(f"({K} * 7) % 13")),
    ("Baths", _dbl(f"({K} * 5) % 9")),
    ("Car_Spaces", _dbl(f"({K} * 3) % 12")),
    ("LandSize_sqm", f"(CASE WHEN {K} % 11 = 0 THEN NULL "
                     f"WHEN {K} % 5 = 0 THEN {_dbl('0')} "
                     f"WHEN {K} % 301 = 0 THEN {_dbl(f'((({K} * 37) % 900) + 50) * 1000')} "
                     f"ELSE {_dbl(f'(({K} * 37) % 900) + 50')} END)"),
    ("Propertycount", f"CAST(120 + (o_custkey % 40) * 7 AS BIGINT)"),
    ("Raw_Price", f"(CASE WHEN v = 1 AND {BASE_RAW} IS NOT NULL "
                  f"THEN {BASE_RAW} || ' reduced' ELSE {BASE_RAW} END)"),
    ("Numeric_Price", f"(CASE WHEN v = 1 THEN {BASE_PRICE} - {_dbl('10000')} "
                      f"ELSE {BASE_PRICE} END)"),
    ("Latitude", f"(CASE WHEN {LAT_NULL} THEN NULL ELSE {_dbl('-38.7')} + "
                 f"{_dbl(f'({K} * 7919) % 1400')} / {_dbl('1000')} END)"),
    ("Longitude", f"(CASE WHEN {LAT_NULL} THEN NULL ELSE {_dbl('144.3')} + "
                  f"{_dbl(f'({K} * 104729) % 1500')} / {_dbl('1000')} END)"),
    ("Distance_to_CBD_km", f"(CASE WHEN {LAT_NULL} THEN NULL ELSE "
                           f"{_dbl(f'({K} * 13) % 5000')} / {_dbl('100')} END)"),
    ("URL", f"'https://www.domain.com.au/listing-' || CAST({K} AS STRING)"),
    ("Last_Updated", "(CAST(o_orderdate AS DATE) + v)"),
    ("abs_median_income_weekly", f"(CASE WHEN {P} % 23 = 0 THEN NULL "
                                 f"ELSE {_dbl(f'600 + ({P} * 37) % 900')} END)"),
    ("abs_median_age", f"(CASE WHEN {P} % 23 = 0 THEN NULL "
                       f"ELSE {_dbl(f'28 + ({P} * 13) % 25')} END)"),
    ("abs_population", f"(CASE WHEN {P} % 23 = 0 THEN NULL WHEN {P} % 17 = 0 "
                       f"THEN {_dbl('0')} ELSE {_dbl(f'({P} * 911) % 40000')} END)"),
    ("crime_offence_count", f"(CASE WHEN {P} % 19 = 0 THEN NULL "
                            f"ELSE {_dbl(f'100 + ({P} * 53) % 900')} END)"),
    ("crime_rate_per_100k", f"(CASE WHEN {P} % 19 = 0 OR {P} % 23 = 0 OR {P} % 17 = 0 "
                            f"THEN NULL ELSE {_dbl(f'({P} * 71) % 5000')} / {_dbl('10')} END)"),
    ("dist_nearest_train_km", f"(CASE WHEN {LAT_NULL} THEN NULL ELSE "
                              f"{_dbl(f'({K} * 17) % 8000')} / {_dbl('1000')} END)"),
]

# The same values in fewer instructions, for Spark only.  A listing is made by one
# generated method, filters on it included, and beyond 8000 bytes of bytecode the JVM
# interprets a method and never compiles it: so the month is looked up, and the raw
# price names its base twice instead of three times (its suffix on a null is null).
SHORT: list[tuple[str, str]] = [
    (MONTH_NAME, "element_at(array('Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun', 'Jul', 'Aug', 'Sep', "
                 "'Oct', 'Nov', 'Dec'), month(o_orderdate))"),
    (f"v = 1 AND {BASE_RAW} IS NOT NULL", "v = 1"),
]


def spark_expr(e: str) -> str:
    """The expression of a column in its short form."""
    for long, short in SHORT:
        e = e.replace(long, short)
    return e


DUP_CONDITION = "o_orderstatus = 'O' AND o_orderkey % 50 = 0"
ORDERS_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                  "o_orderdate"]


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENRICHED-shaped listings from ``orders`` — one scan, no shuffle.

    The re-listed copies come from an ``explode`` of the row's versions, so
    the table is read once and the copies stay in the scan's partition.
    """
    from estatelens.sources.tables import spread
    orders = spread(spark.read.parquet(f"{sf_dir}/orders.parquet").select(*ORDERS_COLUMNS))
    versions = F.expr(f"CASE WHEN {DUP_CONDITION} THEN array(0, 1) ELSE array(0) END")
    exploded = orders.withColumn("v", F.explode(versions))
    pre = exploded.select("*", *[F.expr(e).alias(n) for n, e in PRE])
    return pre.select(*[F.expr(spark_expr(e)).alias(n) for n, e in COLUMNS])


def duckdb_sql() -> str:
    """The same table as a DuckDB SELECT (for oracle CTEs)."""
    oc = ", ".join(ORDERS_COLUMNS)
    pre = ", ".join(f"{e} AS {n}" for n, e in PRE)
    cols = ",\n  ".join(f"{e} AS {n}" for n, e in COLUMNS)
    return (f"SELECT\n  {cols}\nFROM (SELECT *, {pre} FROM (\n"
            f"  SELECT {oc}, 0 AS v FROM orders\n  UNION ALL\n"
            f"  SELECT {oc}, 1 AS v FROM orders WHERE {DUP_CONDITION}) o) pre")
