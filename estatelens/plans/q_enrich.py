"""Registered queries: enrichment."""

from pyspark.sql import functions as F

from estatelens.operators import enrich as EN
from estatelens.operators import spatial as SP
from estatelens.params import DEFAULT
from estatelens.plans import base
from estatelens.plans import oracle_sql as O
from estatelens.plans.registry import register

# Dimension tables derived from the driver tables (identical text in both engines).
PC = "(3000 + c_custkey % 100)"
G02 = [("POA_CODE_2021", "'POA' || CAST(p AS STRING)"),
       ("Median_tot_prsnl_inc_weekly", "CAST(600 + (p * 37) % 900 AS STRING)"),
       ("Median_mortgage_repay_monthly", "CAST(1000 + p % 700 AS STRING)"),
       ("Median_age_persons", "CAST(28 + (p * 13) % 25 AS STRING)")]
G01 = [("POA_CODE_2021", "'POA' || CAST(p AS STRING)"),
       ("Tot_P_P", "CAST(CASE WHEN p % 17 = 0 THEN 0 ELSE (p * 911) % 40000 END AS STRING)")]
OFFENCES = [("Year", "CAST(year(l_shipdate) AS STRING)"),
            ("Postcode", "(CASE WHEN l_orderkey % 53 = 0 THEN 'n/a' ELSE CAST(3000 + l_suppkey % 100 AS STRING) END)"),
            ("Suburb/Town Name", "'S' || CAST(l_partkey % 40 AS STRING)"),
            ("Offence Count", "CAST(l_quantity AS STRING)")]
ROUTES = [("feed_id", "'F' || CAST(p_partkey % 2 AS STRING)"),
          ("route_id", "CAST(p_partkey AS STRING)"),
          ("route_type", "(CASE WHEN p_partkey % 2 = 1 THEN '3' ELSE CAST(p_size % 3 AS STRING) END)")]
TRIPS = [("feed_id", "'F' || CAST(l_partkey % 2 AS STRING)"),
         ("route_id", "CAST(l_partkey AS STRING)"), ("trip_id", "CAST(l_orderkey AS STRING)")]
STOP_TIMES = [("feed_id", "'F' || CAST(l_partkey % 2 AS STRING)"),
              ("trip_id", "CAST(l_orderkey AS STRING)"), ("stop_id", "CAST(l_suppkey AS STRING)")]
FEED_STOPS = [("stop_id", "CAST(s_suppkey AS STRING)"), ("stop_name", "s_name"),
              ("stop_lat", "CAST(CAST(-38.65 AS DOUBLE) + CAST((s_suppkey * 37) % 1300 AS DOUBLE) / 1000 AS STRING)"),
              ("stop_lon", "CAST(CAST(144.25 AS DOUBLE) + CAST((s_suppkey * 53) % 1400 AS DOUBLE) / 1000 AS STRING)")]


def _sel(cols):
    return ", ".join(f'{e} AS "{n}"' for n, e in cols)


def _spark(df, cols):
    return df.select(*[F.expr(e).alias(n) for n, e in cols])


def g02(spark, sf_dir):
    ps = base.table(spark, sf_dir, "customer").select(F.expr(PC).alias("p")).distinct() \
        .where("p % 23 <> 0")
    return _spark(ps, G02)


def g01(spark, sf_dir):
    ps = base.table(spark, sf_dir, "customer").select(F.expr(PC).alias("p")).distinct() \
        .where("p % 23 <> 0")
    return _spark(ps, G01)


def offences_raw(spark, sf_dir):
    return _spark(base.table(spark, sf_dir, "lineitem"), OFFENCES)


def feeds(spark, sf_dir):
    part, li, sup = (base.table(spark, sf_dir, t) for t in ("part", "lineitem", "supplier"))
    stops = _spark(sup, FEED_STOPS)
    # every stop appears in both feeds (same stop_id in two feeds)
    stops = stops.withColumn("feed_id", F.explode(F.array(F.lit("F0"), F.lit("F1"))))
    return _spark(part, ROUTES), _spark(li, TRIPS), _spark(li, STOP_TIMES), stops


DIM_CTES = f"""
, ps AS (SELECT DISTINCT {PC} AS p FROM customer),
g02 AS (SELECT {_sel(G02)} FROM ps WHERE p % 23 <> 0),
g01 AS (SELECT {_sel(G01)} FROM ps WHERE p % 23 <> 0),
census AS (SELECT TRY_CAST(NULLIF(regexp_extract(g02.POA_CODE_2021, '(\\d{{4}})', 1), '') AS INT) AS Postcode,
  TRY_CAST(trim(Median_tot_prsnl_inc_weekly) AS DOUBLE) AS abs_median_income_weekly,
  TRY_CAST(trim(Median_age_persons) AS DOUBLE) AS abs_median_age,
  TRY_CAST(trim(Tot_P_P) AS DOUBLE) AS abs_population
  FROM g02 LEFT JOIN g01 ON TRY_CAST(NULLIF(regexp_extract(g02.POA_CODE_2021, '(\\d{{4}})', 1), '') AS INT)
     = TRY_CAST(NULLIF(regexp_extract(g01.POA_CODE_2021, '(\\d{{4}})', 1), '') AS INT)),
off_raw AS (SELECT {_sel(OFFENCES)} FROM lineitem),
off1 AS (SELECT TRY_CAST(trim("Year") AS DOUBLE) AS yr, TRY_CAST(TRY_CAST(trim(Postcode) AS DOUBLE) AS INT) AS Postcode,
  "Suburb/Town Name" AS sub, TRY_CAST(trim("Offence Count") AS DOUBLE) AS cnt FROM off_raw),
off2 AS (SELECT * FROM off1 WHERE yr = (SELECT max(yr) FROM off1) AND Postcode IS NOT NULL AND cnt IS NOT NULL),
tot AS (SELECT Postcode, round_even(sum(cnt), 0) AS crime_offence_count FROM off2 GROUP BY Postcode
        HAVING round_even(sum(cnt), 0) > 0),
top AS (SELECT Postcode, arg_min(sub, (-n, sub)) AS crime_suburb_ref FROM
        (SELECT Postcode, sub, count(*) AS n FROM off2 WHERE sub IS NOT NULL GROUP BY Postcode, sub) t GROUP BY Postcode),
offences AS (SELECT tot.Postcode, crime_offence_count, crime_suburb_ref FROM tot LEFT JOIN top ON tot.Postcode = top.Postcode)"""


@register("header_resolve", O.with_listings(DIM_CTES + """
SELECT POA_CODE_2021 AS postcode_raw, Median_tot_prsnl_inc_weekly AS abs_median_income_weekly,
       Median_age_persons AS abs_median_age FROM g02"""))
def q_header_resolve(spark, sf_dir):
    return EN.resolve_headers(g02(spark, sf_dir), EN.CENSUS_RULES)


@register("census_join", O.with_listings(DIM_CTES + """
SELECT l.Property_ID, l.Last_Updated, l.Postcode, c.abs_median_income_weekly, c.abs_median_age, c.abs_population
FROM listings l LEFT JOIN census c ON l.Postcode = c.Postcode"""))
def q_census_join(spark, sf_dir):
    census = EN.census_table(g02(spark, sf_dir), g01(spark, sf_dir))
    l = base.listings(spark, sf_dir).select("Property_ID", "Last_Updated", "Postcode")
    out = EN.enrich_listings(l, census, census.select("Postcode").limit(0)
                             .withColumn("crime_offence_count", F.lit(None).cast("double"))
                             .withColumn("crime_suburb_ref", F.lit(None).cast("string")))
    return out.select("Property_ID", "Last_Updated", "Postcode", "abs_median_income_weekly",
                      "abs_median_age", "abs_population")


@register("offence_latest_year", O.with_listings(DIM_CTES + """
SELECT Postcode, crime_offence_count, crime_suburb_ref FROM offences"""))
def q_offences(spark, sf_dir):
    return EN.offences_by_postcode(offences_raw(spark, sf_dir))


@register("modal_suburb", O.with_listings(DIM_CTES + "SELECT Postcode, crime_suburb_ref FROM top"))
def q_modal(spark, sf_dir):
    return EN.offences_by_postcode(offences_raw(spark, sf_dir)) \
        .where("crime_suburb_ref IS NOT NULL").select("Postcode", "crime_suburb_ref")


@register("offence_rate", O.with_listings(DIM_CTES + """
SELECT l.Property_ID, l.Last_Updated, o.crime_offence_count, o.crime_suburb_ref,
  CASE WHEN c.abs_population > 0 AND o.crime_offence_count IS NOT NULL
       THEN round_even(o.crime_offence_count / c.abs_population * 100000, 1) END AS crime_rate_per_100k
FROM listings l LEFT JOIN census c ON l.Postcode = c.Postcode LEFT JOIN offences o ON l.Postcode = o.Postcode"""))
def q_offence_rate(spark, sf_dir):
    census = EN.census_table(g02(spark, sf_dir), g01(spark, sf_dir))
    off = EN.offences_by_postcode(offences_raw(spark, sf_dir))
    l = base.listings(spark, sf_dir).select("Property_ID", "Last_Updated", "Postcode")
    out = EN.enrich_listings(l, census, off)
    return out.select("Property_ID", "Last_Updated", "crime_offence_count", "crime_suburb_ref",
                      "crime_rate_per_100k")


RAIL_SQL = f"""
, routes AS (SELECT {_sel(ROUTES)} FROM part),
trips AS (SELECT {_sel(TRIPS)} FROM lineitem),
st AS (SELECT {_sel(STOP_TIMES)} FROM lineitem),
s0 AS (SELECT {_sel(FEED_STOPS)} FROM supplier),
stops AS (SELECT 'F0' AS feed_id, * FROM s0 UNION ALL SELECT 'F1', * FROM s0),
rail AS (SELECT feed_id, route_id FROM routes WHERE route_type IN ('2')),
rt AS (SELECT feed_id, trip_id FROM trips WHERE (feed_id, route_id) IN (SELECT (feed_id, route_id) FROM rail)),
served AS (SELECT DISTINCT feed_id, stop_id FROM st WHERE (feed_id, trip_id) IN (SELECT (feed_id, trip_id) FROM rt)),
s1 AS (SELECT feed_id, stop_id, stop_name, TRY_CAST(trim(stop_lat) AS DOUBLE) AS stop_lat,
         TRY_CAST(trim(stop_lon) AS DOUBLE) AS stop_lon FROM stops),
kept AS (SELECT * FROM s1 WHERE stop_lat IS NOT NULL AND stop_lon IS NOT NULL
         AND (feed_id, stop_id) IN (SELECT (feed_id, stop_id) FROM served)),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stop_id ORDER BY feed_id) AS rn FROM kept) t WHERE rn = 1)
SELECT stop_id, stop_name, stop_lat, stop_lon FROM firsts
WHERE stop_lat BETWEEN -38.6 AND -37.4 AND stop_lon BETWEEN 144.3 AND 145.6"""


def rail_stops(spark, sf_dir, p=DEFAULT):
    return EN.rail_stops(*feeds(spark, sf_dir), p)


@register("rail_stops_semi", O.with_listings(RAIL_SQL))
def q_rail(spark, sf_dir):
    return rail_stops(spark, sf_dir)


LENIENT_SQL = RAIL_SQL.replace(
    "kept AS (SELECT * FROM s1 WHERE stop_lat IS NOT NULL AND stop_lon IS NOT NULL\n"
    "         AND (feed_id, stop_id) IN (SELECT (feed_id, stop_id) FROM served)),",
    "kept AS (SELECT * FROM s1 WHERE stop_lat IS NOT NULL AND stop_lon IS NOT NULL\n"
    "         AND ((feed_id, stop_id) IN (SELECT (feed_id, stop_id) FROM served)\n"
    "              OR feed_id NOT IN (SELECT feed_id FROM rail))),")


@register("rail_stops_lenient", O.with_listings(LENIENT_SQL))
def q_rail_lenient(spark, sf_dir):
    return rail_stops(spark, sf_dir, DEFAULT.with_(lenient_rail=True))


def _enrich_sql():
    from estatelens.plans.q_spatial import _hav_sql
    rail_ctes = RAIL_SQL[:RAIL_SQL.index("\nSELECT stop_id")]
    hav = _hav_sql("Latitude", "Longitude", "stop_lat", "stop_lon")
    drop = ("abs_median_income_weekly, abs_median_age, abs_population, crime_offence_count, "
            "crime_rate_per_100k, dist_nearest_train_km")
    return O.with_listings(DIM_CTES + rail_ctes + f""",
rs AS (SELECT stop_id, stop_lat, stop_lon FROM firsts
       WHERE stop_lat BETWEEN -38.6 AND -37.4 AND stop_lon BETWEEN 144.3 AND 145.6),
pts AS (SELECT DISTINCT Property_ID, Latitude, Longitude FROM listings),
near AS (SELECT Property_ID, round_even(min({hav}), 3) AS dist_nearest_train_km FROM pts, rs
         WHERE Latitude IS NOT NULL AND Longitude IS NOT NULL GROUP BY Property_ID)
SELECT l.* EXCLUDE ({drop}), c.abs_median_income_weekly, c.abs_median_age, c.abs_population,
  o.crime_offence_count, o.crime_suburb_ref,
  CASE WHEN c.abs_population > 0 AND o.crime_offence_count IS NOT NULL
       THEN round_even(o.crime_offence_count / c.abs_population * 100000, 1) END AS crime_rate_per_100k,
  near.dist_nearest_train_km, DATE '{DEFAULT.as_of.isoformat()}' AS Enriched_Date
FROM listings l LEFT JOIN census c ON l.Postcode = c.Postcode
LEFT JOIN offences o ON l.Postcode = o.Postcode LEFT JOIN near ON l.Property_ID = near.Property_ID""")


@register("enrich_listings", _enrich_sql())
def q_enrich(spark, sf_dir):
    """Full enrichment: census + offences + nearest rail stop + stamp."""
    census = EN.census_table(g02(spark, sf_dir), g01(spark, sf_dir))
    off = EN.offences_by_postcode(offences_raw(spark, sf_dir))
    l = base.listings(spark, sf_dir).drop("abs_median_income_weekly", "abs_median_age",
                                          "abs_population", "crime_offence_count",
                                          "crime_rate_per_100k", "dist_nearest_train_km")
    pts = l.select("Property_ID", "Latitude", "Longitude").distinct()
    near = SP.nearest_distance_km(pts, rail_stops(spark, sf_dir), "Property_ID", "Latitude", "Longitude")
    return EN.enrich_listings(l, census, off, near, DEFAULT.as_of)
