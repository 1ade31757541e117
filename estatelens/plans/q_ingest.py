"""Registered queries: ingestion (A6, A7, A14, C9, E1, E2, S1 batch form)."""

from pyspark.sql import functions as F

from estatelens.operators import ingest as IG
from estatelens.params import DEFAULT
from estatelens.plans import base
from estatelens.plans import oracle_sql as O
from estatelens.plans.registry import register
from estatelens.sources import listings_adapter as la

K = "o_orderkey"
ITEM = [
    ("pid", f"CAST({K} AS STRING)"),
    ("status_label", "(CASE WHEN o_orderstatus = 'O' THEN 'For Sale' ELSE 'Sold' END)"),
    ("price", f"(CASE WHEN {K} % 4 = 0 THEN NULL ELSE '$' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) END)"),
    ("url", f"(CASE WHEN {K} % 9 = 0 THEN NULL ELSE '/listing-' || CAST({K} AS STRING) END)"),
    ("dateSold", f"(CASE WHEN o_orderstatus <> 'O' AND {K} % 3 <> 0 THEN lpad(CAST(day(o_orderdate) AS STRING), 2, '0')"
                 f" || ' ' || {la.MONTH_NAME} || ' ' || CAST(year(o_orderdate) AS STRING) END)"),
    ("dateListed", f"(CASE WHEN {K} % 3 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) END)"),
    ("street", f"(CASE WHEN {K} % 17 = 0 THEN NULL ELSE CAST({K} AS STRING) || ' Example St' END)"),
    ("suburb", f"(CASE WHEN {K} % 19 = 0 THEN NULL ELSE 's' || CAST(o_custkey % 40 AS STRING) END)"),
    ("postcode", "CAST(3000 + o_custkey % 100 AS STRING)"),
    ("glat", f"CAST(-38.7 AS DOUBLE) + CAST(({K} * 7919) % 1400 AS DOUBLE) / CAST(1000 AS DOUBLE)"),
    ("glng", f"CAST(144.3 AS DOUBLE) + CAST(({K} * 104729) % 1500 AS DOUBLE) / CAST(1000 AS DOUBLE)"),
    ("alat", f"(CASE WHEN {K} % 7 = 0 THEN NULL ELSE CAST(-38.7 AS DOUBLE) + CAST(({K} * 7919) % 1400 AS DOUBLE) / CAST(1000 AS DOUBLE) END)"),
    ("alng", f"(CASE WHEN {K} % 7 = 0 THEN NULL ELSE CAST(144.3 AS DOUBLE) + CAST(({K} * 104729) % 1500 AS DOUBLE) / CAST(1000 AS DOUBLE) END)"),
    ("ptf", f"(CASE WHEN {K} % 6 = 0 THEN NULL ELSE 'House' END)"),
    ("pt", f"(CASE WHEN {K} % 12 = 0 THEN NULL ELSE 'house' END)"),
    ("beds", f"(CASE WHEN {K} % 8 = 0 THEN NULL ELSE CAST({K} % 5 AS INT) END)"),
    ("baths", f"(CASE WHEN {K} % 8 = 1 THEN NULL ELSE CAST({K} % 3 AS INT) END)"),
    ("parking", f"(CASE WHEN {K} % 5 = 0 THEN NULL ELSE CAST({K} % 4 AS INT) END)"),
    ("carspaces", f"(CASE WHEN {K} % 10 = 0 THEN NULL ELSE CAST({K} % 2 AS INT) END)"),
    ("landSize", f"CAST({K} % 900 + 1 AS STRING)"),
    ("landUnit", f"(CASE WHEN {K} % 10 = 3 THEN 'ha' ELSE 'm²' END)"),
    ("page", f"CAST(floor({K} / 20) AS BIGINT)"),
]


def payload_pages(spark, sf_dir):
    """Search-result pages as JSON text: 20 listings per page (the page
    group is bounded by construction)."""
    o = base.table(spark, sf_dir, "orders").select(*[F.expr(e).alias(n) for n, e in ITEM])
    model = F.struct(
        F.col("price"), F.col("url"), F.col("dateSold"), F.col("dateListed"),
        F.struct(F.lit(None).cast("string").alias("date")).alias("status"),
        F.struct(F.col("street"), F.col("suburb"), F.col("postcode"), F.col("alat").alias("lat"),
                 F.col("alng").alias("lng")).alias("address"),
        F.struct(F.col("glat").alias("latitude"), F.col("glng").alias("longitude")).alias("geolocation"),
        F.struct(F.col("ptf").alias("propertyTypeFormatted"), F.col("pt").alias("propertyType"),
                 "beds", "baths", "parking", "carspaces", "landSize", "landUnit").alias("features"))
    items = o.select("page", "status_label", "pid", F.struct(model.alias("listingModel")).alias("item"))
    pages = items.groupBy("page", "status_label").agg(
        F.map_from_entries(F.collect_list(F.struct("pid", "item"))).alias("lm"))
    payload = F.to_json(F.struct(F.struct(F.struct(F.struct(
        F.lit(5).alias("totalPages"), F.col("lm").alias("listingsMap")).alias("componentProps"))
        .alias("pageProps")).alias("props")))
    return pages.select("page", "status_label", payload.alias("payload"))


def _hav(a, b):
    return (f"round_even(6371.0 * 2 * atan2(sqrt(pow(sin((radians({a}) - radians(-37.8136)) / 2), 2) + cos(radians(-37.8136)) "
            f"* cos(radians({a})) * pow(sin((radians({b}) - radians(144.9631)) / 2), 2)), sqrt(1 - (pow(sin((radians({a}) "
            f"- radians(-37.8136)) / 2), 2) + cos(radians(-37.8136)) * cos(radians({a})) * pow(sin((radians({b}) "
            f"- radians(144.9631)) / 2), 2)))), 2)")


PAYLOAD_SQL = f"""
WITH it AS (SELECT {', '.join(f'{e} AS {n}' for n, e in ITEM)} FROM orders),
f AS (SELECT *, upper(coalesce(suburb, 'Map Area')) AS sub, coalesce(alat, glat) AS lat, coalesce(alng, glng) AS lng
      FROM it WHERE street IS NOT NULL)
SELECT pid AS Property_ID, status_label AS Status,
  trim(street || ', ' || sub || ' VIC ' || postcode) AS Full_Address, sub AS Suburb, postcode AS Postcode,
  coalesce(ptf, pt, 'N/A') AS Property_Type,
  coalesce(CASE WHEN coalesce(dateSold, dateListed) <> '' THEN coalesce(dateSold, dateListed) END, 'N/A') AS Date,
  CAST(coalesce(beds, 0) AS DOUBLE) AS Beds, CAST(coalesce(baths, 0) AS DOUBLE) AS Baths,
  CAST(coalesce(parking, carspaces, 0) AS DOUBLE) AS Car_Spaces,
  CASE WHEN landUnit LIKE '%ha%' THEN TRY_CAST(landSize AS DOUBLE) * 10000 ELSE TRY_CAST(landSize AS DOUBLE) END AS LandSize_sqm,
  coalesce(price, 'N/A') AS Raw_Price, TRY_CAST(substr(price, 2) AS DOUBLE) AS Numeric_Price, lat AS Latitude, lng AS Longitude, {_hav('lat', 'lng')} AS Distance_to_CBD_km,
  CASE WHEN url IS NOT NULL AND url <> '' THEN 'https://www.domain.com.au' || url ELSE 'N/A' END AS URL,
  CAST(5 AS INT) AS total_pages
FROM f"""


@register("payload_explode", PAYLOAD_SQL)
def q_payload(spark, sf_dir):
    items = IG.explode_payloads(payload_pages(spark, sf_dir))
    return IG.flatten_listings(items, DEFAULT.as_of, keep=("total_pages",)).drop("Last_Updated")


BROKEN = "CASE WHEN page % 7 = 3 THEN 'no script' WHEN page % 11 = 5 THEN 'not json' ELSE 'ok' END"


def html_pages(spark, sf_dir):
    """The payload pages inside stored HTML; some without their script, some cut off in it."""
    p = payload_pages(spark, sf_dir).withColumn("state", F.expr(BROKEN))
    other = F.lit("<html><head><script>var id = '__NEXT_DATA__';</script></head><body><div id=\"__NEXT_DATA__\">{}</div>")
    body = F.when(F.col("state") == "not json", F.expr("left(payload, length(payload) - 9)")).otherwise(F.col("payload"))
    script = F.concat(F.lit('<script type="application/json"\n id="__NEXT_DATA__">'), body, F.lit("</script>"))
    return p.select("page", "status_label", F.concat(
        other, F.when(F.col("state") != "no script", script).otherwise(""), F.lit("</body></html>")).alias("html"))


@register("payload_html", f"""
WITH it AS (SELECT {', '.join(f'{e} AS {n}' for n, e in ITEM)} FROM orders),
p AS (SELECT page, status_label, {BROKEN} AS state, count(*) AS all_listings, count(street) AS with_street,
             sum(CASE WHEN street IS NOT NULL THEN CAST(pid AS BIGINT) END) AS ids FROM it GROUP BY page, status_label)
SELECT page, status_label, state, CAST(CASE WHEN state = 'ok' THEN with_street ELSE 0 END AS BIGINT) AS n_listings,
       CAST(CASE WHEN state = 'ok' THEN ids END AS BIGINT) AS id_sum FROM p""")
def q_payload_html(spark, sf_dir):
    """A6 from stored pages: every page with its state and what its listings come to."""
    pages = IG.payload_of_html(html_pages(spark, sf_dir))
    # the page's own label travels with its listings
    keyed = pages.withColumn("of", F.struct("page", "status_label"))
    flat = IG.flatten_listings(IG.explode_payloads(keyed, label_col="of"), DEFAULT.as_of, label_col="of")
    got = flat.groupBy(F.col("Status").alias("of")).agg(F.count("*").alias("n_listings"), F.sum(F.col("Property_ID").cast("long")).alias("id_sum"))
    return keyed.select("of", "state").join(got, "of", "left").select(
        "of.page", "of.status_label", "state", F.coalesce("n_listings", F.lit(0)).cast("long").alias("n_listings"), "id_sum")


ARRIVAL = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount",
           "l_tax", "l_returnflag", "l_linestatus"]


@register("upsert_keep_last", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY """
          + ", ".join(f"{a} DESC" for a in ARRIVAL) + """) AS rn FROM lineitem) t WHERE rn = 1""")
def q_upsert(spark, sf_dir):
    li = base.table(spark, sf_dir, "lineitem")
    kept = IG.keep_last(li, ["l_orderkey", "l_linenumber"], ARRIVAL)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                       "l_extendedprice")


@register("suburb_count_window", O.with_listings("""
, latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY Property_ID ORDER BY Last_Updated DESC) AS rn
             FROM listings) t WHERE rn = 1)
SELECT Property_ID, Suburb, CASE WHEN Suburb IS NOT NULL THEN count(*) OVER (PARTITION BY Suburb) END AS Propertycount
FROM latest"""))
def q_suburb_count(spark, sf_dir):
    l = base.listings(spark, sf_dir)
    old = l.where("NOT Raw_Price LIKE '% reduced' OR Raw_Price IS NULL")
    new = l.where("Raw_Price LIKE '% reduced'")
    return IG.upsert(old, new, "Property_ID").select("Property_ID", "Suburb", "Propertycount")


EVENT_PAIR = [("event_type", "event_type"), ("bucket", "CAST(floor(value / 50) AS BIGINT)")]
CUT = "TIMESTAMP '2024-01-15 00:00:00'"


def events(spark, sf_dir):
    e = base.table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return e.withColumn("bucket", F.expr("CAST(floor(value / 50) AS BIGINT)"))


@register("changed_only", f"""
WITH e AS (SELECT event_id, ts, user_id, event_type, CAST(floor(value / 50) AS BIGINT) AS bucket FROM events),
st AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
       FROM e WHERE ts < {CUT}) t WHERE rn = 1)
SELECT b.event_id, b.user_id, b.event_type, b.bucket FROM e b
WHERE b.ts >= {CUT} AND NOT EXISTS (SELECT 1 FROM st WHERE st.user_id = b.user_id
  AND st.event_type IS NOT DISTINCT FROM b.event_type AND st.bucket IS NOT DISTINCT FROM b.bucket)""")
def q_changed_only(spark, sf_dir):
    e = events(spark, sf_dir)
    state = IG.keep_last(e.where(F.col("ts") < F.expr(CUT)), ["user_id"], ["ts", "event_id"])
    batch = e.where(F.col("ts") >= F.expr(CUT))
    return IG.changed_only(batch, state, "user_id", ["event_type", "bucket"]) \
        .select("event_id", "user_id", "event_type", "bucket")


CHANGE_SQL = """
WITH e AS (SELECT event_id, ts, user_id, event_type, CAST(floor(value / 50) AS BIGINT) AS bucket FROM events),
l AS (SELECT *, lag(event_type) OVER w AS pt, lag(bucket) OVER w AS pb, lag(event_id) OVER w AS pe FROM e
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, event_type, bucket FROM l
WHERE pe IS NULL OR pt IS DISTINCT FROM event_type OR pb IS DISTINCT FROM bucket"""


@register("change_events_batch", CHANGE_SQL)
def q_change_batch(spark, sf_dir):
    ch = IG.change_events(events(spark, sf_dir), "user_id", ["ts", "event_id"], ["event_type", "bucket"])
    return ch.select("event_id", "user_id", "event_type", "bucket")
