"""Registered queries: row-level rules as whole-table jobs."""

from pyspark.sql import functions as F

from estatelens.functions import scalars as S
from estatelens.plans import base
from estatelens.plans import oracle_sql as O
from estatelens.plans.registry import register

K = "CAST(Property_ID AS BIGINT)"
PRICE_SQL = """
, p0 AS (SELECT Property_ID, Last_Updated, Raw_Price, lower(trim(Raw_Price)) AS s FROM listings),
p1 AS (SELECT *, replace(replace(replace(regexp_replace(s, '([.,])(\\d{3})\\d+', '\\1\\2', 'g'), ',', ''),
          '–', '-'), ' to ', '-') AS s3 FROM p0),
p2 AS (SELECT *, regexp_extract_all(s3, '\\$\\s*(\\d+\\.?\\d*[km]?)', 1) AS m FROM p1),
p3 AS (SELECT *, list_transform(m, lambda x: CASE
          WHEN x LIKE '%m' THEN TRY_CAST(left(x, length(x) - 1) AS DOUBLE) * 1000000
          WHEN x LIKE '%k' THEN CASE WHEN TRY_CAST(left(x, length(x) - 1) AS DOUBLE) < 1000
               THEN TRY_CAST(left(x, length(x) - 1) AS DOUBLE) * 1000 ELSE TRY_CAST(left(x, length(x) - 1) AS DOUBLE) END
          ELSE TRY_CAST(x AS DOUBLE) END) AS vals FROM p2)
SELECT Property_ID, Last_Updated, Raw_Price, CASE
  WHEN s IS NULL OR length(s) = 0 OR NOT contains(s3, '$') OR len(m) = 0 THEN NULL
  WHEN contains(s3, 'fhog') THEN vals[1]
  WHEN len(vals) >= 2 AND contains(s3, '-') THEN (vals[1] + vals[2]) / 2
  ELSE vals[1] END AS parsed_price FROM p3"""


@register("price_text_parse", O.with_listings(PRICE_SQL))
def q_price_parse(spark, sf_dir):
    l = base.listings(spark, sf_dir)
    return l.select("Property_ID", "Last_Updated", "Raw_Price",
                    S.parse_price("Raw_Price").alias("parsed_price"))


LAND_TXT = (f"(CASE WHEN {K} % 13 = 0 THEN 'abc' ELSE CAST((({K} * 37) % 900) + 50 AS STRING) END)")
LAND_UNIT = (f"(CASE {K} % 4 WHEN 0 THEN 'ha' WHEN 1 THEN 'Hectares' WHEN 2 THEN 'm²' ELSE 'sqm' END)")


@register("land_unit", O.with_listings(f"""
, t AS (SELECT Property_ID, Last_Updated, {LAND_TXT} AS size_text, {LAND_UNIT} AS unit FROM listings)
SELECT Property_ID, Last_Updated, size_text, unit, CASE WHEN contains(lower(unit), 'ha')
  OR contains(lower(unit), 'hectare') THEN TRY_CAST(size_text AS DOUBLE) * 10000
  ELSE TRY_CAST(size_text AS DOUBLE) END AS land_sqm FROM t"""))
def q_land_unit(spark, sf_dir):
    l = base.listings(spark, sf_dir).select("Property_ID", "Last_Updated",
                                            F.expr(LAND_TXT).alias("size_text"),
                                            F.expr(LAND_UNIT).alias("unit"))
    return l.withColumn("land_sqm", S.land_size_sqm("size_text", "unit"))


STREET = f"(CASE WHEN {K} % 17 = 0 THEN NULL ELSE CAST({K} AS STRING) || ' Example St' END)"
URL_PATH = f"(CASE WHEN {K} % 9 = 0 THEN '' ELSE '/listing-' || CAST({K} AS STRING) END)"


@register("address_url", O.with_listings(f"""
, t AS (SELECT Property_ID, Last_Updated, {STREET} AS street, Suburb, Postcode, {URL_PATH} AS path FROM listings)
SELECT Property_ID, Last_Updated,
  CASE WHEN street IS NOT NULL AND street <> 'N/A' THEN trim(street || ', ' || coalesce(Suburb, '') || ' VIC '
    || coalesce(CAST(Postcode AS STRING), '')) END AS full_address,
  CASE WHEN path IS NOT NULL AND path <> '' THEN 'https://www.domain.com.au' || path ELSE 'N/A' END AS url
FROM t"""))
def q_address_url(spark, sf_dir):
    l = base.listings(spark, sf_dir).select("Property_ID", "Last_Updated", "Suburb", "Postcode",
                                            F.expr(STREET).alias("street"), F.expr(URL_PATH).alias("path"))
    return l.select("Property_ID", "Last_Updated",
                    S.full_address("street", "Suburb", "Postcode").alias("full_address"),
                    S.listing_url("path").alias("url"))


DATE_SRC = [
    ("date_sold", f"(CASE WHEN {K} % 3 = 0 THEN Date END)"),
    ("date_listed", f"(CASE WHEN {K} % 3 = 1 THEN Date WHEN {K} % 5 = 0 THEN '' END)"),
    ("status_date", f"(CASE WHEN {K} % 7 = 0 THEN Date END)"),
    ("record_json", f"('{{\"id\": \"' || Property_ID || '\", \"note\": \"'"
                    f" || (CASE WHEN {K} % 11 = 0 THEN coalesce(Date, 'n/a') ELSE 'none' END) || '\", \"listingDate\": \"'"
                    f" || CAST(Last_Updated AS STRING) || '\"}}')"),
]


@register("date_pick_parse", O.with_listings(f"""
, t AS (SELECT Property_ID, Last_Updated, {', '.join(f'{e} AS {n}' for n, e in DATE_SRC)} FROM listings),
d AS (SELECT *, coalesce(
    CASE WHEN coalesce(date_sold, date_listed) <> '' THEN coalesce(date_sold, date_listed) END,
    CASE WHEN status_date <> '' THEN status_date END,
    CASE WHEN regexp_extract(record_json, '([0-9]{{1,2}}\\s+[A-Za-z]{{3,9}}\\s+[0-9]{{4}})', 1) <> ''
         THEN regexp_extract(record_json, '([0-9]{{1,2}}\\s+[A-Za-z]{{3,9}}\\s+[0-9]{{4}})', 1) END,
    CASE WHEN regexp_extract(record_json, '"[A-Za-z]*[dD]ate[A-Za-z]*"\\s*:\\s*"([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 1) <> ''
         THEN regexp_extract(record_json, '"[A-Za-z]*[dD]ate[A-Za-z]*"\\s*:\\s*"([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 1) END,
    'N/A') AS date_text FROM t)
SELECT Property_ID, Last_Updated, date_text, CAST(try_strptime(date_text, '%d %b %Y') AS DATE) AS date_parsed,
  CAST(year(CAST(try_strptime(date_text, '%d %b %Y') AS DATE)) AS INT) AS year,
  CAST(month(CAST(try_strptime(date_text, '%d %b %Y') AS DATE)) AS INT) AS month FROM d"""))
def q_date_pick(spark, sf_dir):
    l = base.listings(spark, sf_dir).select("Property_ID", "Last_Updated",
                                            *[F.expr(e).alias(n) for n, e in DATE_SRC])
    d = l.withColumn("date_text", S.pick_listing_date("date_sold", "date_listed", "status_date",
                                                      "record_json"))
    p = S.parse_listing_date("date_text")
    return d.select("Property_ID", "Last_Updated", "date_text", p.alias("date_parsed"),
                    S.year_of(p).alias("year"), S.month_of(p).alias("month"))


PC_TXT = (f"(CASE {K} % 4 WHEN 0 THEN 'POA' || CAST(Postcode AS STRING) WHEN 1 THEN CAST(Postcode AS STRING) || '.0' "
          f"WHEN 2 THEN 'VIC ' || CAST(Postcode AS STRING) ELSE 'unknown' END)")


@register("coerce_postcode", O.with_listings(f"""
, t AS (SELECT Property_ID, Last_Updated, {PC_TXT} AS pc_text FROM listings)
SELECT Property_ID, Last_Updated, pc_text,
  TRY_CAST(NULLIF(regexp_extract(pc_text, '(\\d{{4}})', 1), '') AS INT) AS postcode,
  TRY_CAST(trim(pc_text) AS DOUBLE) AS as_number FROM t"""))
def q_coerce_postcode(spark, sf_dir):
    l = base.listings(spark, sf_dir).select("Property_ID", "Last_Updated", F.expr(PC_TXT).alias("pc_text"))
    return l.select("Property_ID", "Last_Updated", "pc_text",
                    S.extract_postcode("pc_text").alias("postcode"),
                    S.to_number("pc_text").alias("as_number"))


@register("log_roundtrip", O.with_listings("""
SELECT Property_ID, Last_Updated, round_even(ln(1 + Numeric_Price), 9) AS log_price,
  round_even(exp(ln(1 + Numeric_Price)) - 1, 4) AS back, round_even(log10(Numeric_Price), 9) AS log10_price
FROM listings WHERE Numeric_Price > 0"""))
def q_log(spark, sf_dir):
    l = base.listings(spark, sf_dir).where("Numeric_Price > 0")
    lp = S.log1p("Numeric_Price")
    return l.select("Property_ID", "Last_Updated", F.bround(lp, 9).alias("log_price"),
                    F.bround(S.expm1(lp), 4).alias("back"),
                    F.bround(F.log10("Numeric_Price"), 9).alias("log10_price"))


@register("round_thousand", O.with_listings("""
SELECT Property_ID, Last_Updated, round_even(Numeric_Price, -3) AS rounded,
  round_even(Numeric_Price / 7, 2) AS r2 FROM listings"""))
def q_round(spark, sf_dir):
    l = base.listings(spark, sf_dir)
    return l.select("Property_ID", "Last_Updated", S.round_thousand("Numeric_Price").alias("rounded"),
                    F.bround(F.col("Numeric_Price") / 7, 2).alias("r2"))
