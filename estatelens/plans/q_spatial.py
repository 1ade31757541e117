"""Registered queries: spatial (C6, C7, E6, K16, H3, H18, H21, B24, C10, C11, D14, D20, F-2)."""

from pyspark.sql import functions as F

from estatelens.functions import scalars as S
from estatelens.operators import spatial as SP
from estatelens.operators.timeseries import sold_priced
from estatelens.params import DEFAULT
from estatelens.plans import base, standin
from estatelens.plans import oracle_sql as O
from estatelens.plans.registry import register

SUBSTATS_SQL = """
, sp AS (SELECT * FROM cleaned WHERE Status = 'Sold' AND Numeric_Price IS NOT NULL),
substats AS (
  SELECT Suburb, count(*) AS n, quantile_cont(Numeric_Price, 0.5) AS median_price,
         quantile_cont(Latitude, 0.5) AS lat, quantile_cont(Longitude, 0.5) AS lon
  FROM sp GROUP BY Suburb HAVING count(*) >= {min_n}
     AND quantile_cont(Latitude, 0.5) IS NOT NULL AND quantile_cont(Longitude, 0.5) IS NOT NULL)"""


def _stats(spark, sf_dir, min_n=30):
    return SP.suburb_stats(sold_priced(base.cleaned(spark, sf_dir)), min_n)


def flagship(spark, sf_dir, min_n=30):
    """Highest-priced suburbs by median sale price after cleaning (top 15)."""
    st = _stats(spark, sf_dir, min_n)
    return st.select("Suburb", "n", "median_price") \
        .orderBy(F.desc("median_price"), "Suburb").limit(15)


@register("suburb_median_top15", O.with_cleaned(SUBSTATS_SQL.format(min_n=30) + """
SELECT Suburb, CAST(n AS BIGINT) AS n, median_price FROM substats
ORDER BY median_price DESC, Suburb LIMIT 15"""))
def q_top15(spark, sf_dir):
    return flagship(spark, sf_dir)


@register("suburb_median_bottom15", O.with_cleaned(SUBSTATS_SQL.format(min_n=30) + """
SELECT Suburb, CAST(n AS BIGINT) AS n, median_price FROM substats
ORDER BY median_price ASC, Suburb LIMIT 15"""))
def q_bottom15(spark, sf_dir):
    st = _stats(spark, sf_dir)
    return st.select("Suburb", "n", "median_price").orderBy("median_price", "Suburb").limit(15)


@register("suburb_median_ratio", O.with_cleaned(SUBSTATS_SQL.format(min_n=30) + """
SELECT round_even(max(median_price) / min(median_price), 6) AS max_min_ratio,
       CAST(count(*) AS BIGINT) AS n_suburbs FROM substats"""))
def q_ratio(spark, sf_dir):
    st = _stats(spark, sf_dir)
    return st.agg(F.bround(F.max("median_price") / F.min("median_price"), 6).alias("max_min_ratio"),
                  F.count(F.lit(1)).alias("n_suburbs"))


@register("knn_suburbs", O.with_cleaned(SUBSTATS_SQL.format(min_n=30) + """
, pairs AS (SELECT a.Suburb, b.Suburb AS Neighbour,
     sqrt((a.lat - b.lat) * (a.lat - b.lat) + (a.lon - b.lon) * (a.lon - b.lon)) AS dist
   FROM substats a JOIN substats b ON a.Suburb <> b.Suburb),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY Suburb ORDER BY dist, Neighbour) AS INT) AS rank FROM pairs)
SELECT Suburb, rank, Neighbour, round_even(dist, 9) AS dist FROM r WHERE rank <= 5"""))
def q_knn(spark, sf_dir):
    nb = SP.knn_suburbs(_stats(spark, sf_dir), DEFAULT.knn_k)
    return nb.withColumn("dist", F.bround("dist", 9))


@register("spatial_corr", O.with_cleaned(SUBSTATS_SQL.format(min_n=30) + """
, pairs AS (SELECT a.Suburb, b.median_price AS np,
     row_number() OVER (PARTITION BY a.Suburb ORDER BY sqrt((a.lat - b.lat) * (a.lat - b.lat)
        + (a.lon - b.lon) * (a.lon - b.lon)), b.Suburb) AS rank
   FROM substats a JOIN substats b ON a.Suburb <> b.Suburb),
nb AS (SELECT Suburb, avg(np) AS neighbour_avg FROM pairs WHERE rank <= 5 GROUP BY Suburb)
SELECT round_even(corr(s.median_price, nb.neighbour_avg), 6) AS spatial_corr,
       CAST(count(*) AS BIGINT) AS n_suburbs
FROM substats s JOIN nb ON s.Suburb = nb.Suburb"""))
def q_spatial_corr(spark, sf_dir):
    r = SP.spatial_autocorrelation(_stats(spark, sf_dir), DEFAULT.knn_k)
    return r.select(F.bround("spatial_corr", 6).alias("spatial_corr"), "n_suburbs")


STOPS_SPARK = [
    ("stop_id", "CAST(s_suppkey AS STRING)"),
    ("stop_lat", "CAST(-38.6 AS DOUBLE) + CAST((s_suppkey * 37) % 1200 AS DOUBLE) / CAST(1000 AS DOUBLE)"),
    ("stop_lon", "CAST(144.3 AS DOUBLE) + CAST((s_suppkey * 53) % 1300 AS DOUBLE) / CAST(1000 AS DOUBLE)"),
]


def stops(spark, sf_dir):
    sup = base.table(spark, sf_dir, "supplier").select("s_suppkey")
    return sup.select(*[F.expr(e).alias(n) for n, e in STOPS_SPARK])


def _hav_sql(a, b, c, d):
    return (f"(6371.0 * 2 * atan2(sqrt(pow(sin((radians({c}) - radians({a})) / 2), 2) + cos(radians({a})) "
            f"* cos(radians({c})) * pow(sin((radians({d}) - radians({b})) / 2), 2)), sqrt(1 - (pow(sin((radians({c}) "
            f"- radians({a})) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin((radians({d}) "
            f"- radians({b})) / 2), 2)))))")


@register("nearest_stop", O.with_listings(f"""
, st AS (SELECT {', '.join(f'{e} AS {n}' for n, e in STOPS_SPARK)} FROM supplier),
pts AS (SELECT DISTINCT Property_ID, Latitude, Longitude FROM listings),
d AS (SELECT Property_ID, min({_hav_sql('Latitude', 'Longitude', 'stop_lat', 'stop_lon')}) AS dmin
      FROM pts, st WHERE Latitude IS NOT NULL AND Longitude IS NOT NULL GROUP BY Property_ID)
SELECT pts.Property_ID, round_even(dmin, 3) AS dist_nearest_train_km FROM pts LEFT JOIN d
ON pts.Property_ID = d.Property_ID"""))
def q_nearest_stop(spark, sf_dir):
    pts = base.listings(spark, sf_dir).select("Property_ID", "Latitude", "Longitude").distinct()
    return SP.nearest_distance_km(pts, stops(spark, sf_dir), "Property_ID", "Latitude", "Longitude") \
        .select("Property_ID", "dist_nearest_train_km")


@register("haversine_cbd", O.with_listings(f"""
SELECT Property_ID, Last_Updated,
  round_even({_hav_sql('-37.8136', '144.9631', 'Latitude', 'Longitude')}, 2) AS dist_cbd_km FROM listings"""))
def q_haversine(spark, sf_dir):
    l = base.listings(spark, sf_dir)
    return l.select("Property_ID", "Last_Updated",
                    S.distance_to_cbd_km("Latitude", "Longitude").alias("dist_cbd_km"))


@register("mercator", O.with_listings("""
SELECT Property_ID, Last_Updated, round_even(radians(Longitude) * 6378137.0, 2) AS x,
  round_even(ln(tan(pi() / 4 + radians(Latitude) / 2)) * 6378137.0, 2) AS y FROM listings"""))
def q_mercator(spark, sf_dir):
    x, y = S.mercator_xy("Latitude", "Longitude")
    return base.listings(spark, sf_dir).select("Property_ID", "Last_Updated",
                                               F.bround(x, 2).alias("x"), F.bround(y, 2).alias("y"))


LAT_STEP = "((CAST(-37.5 AS DOUBLE) - CAST(-38.5 AS DOUBLE)) / 14)"
LON_STEP = "((CAST(145.40 AS DOUBLE) - CAST(144.35 AS DOUBLE)) / 14)"


@register("grid_cell_counts", O.with_listings(f"""
, cells AS (SELECT CAST(range AS INT) AS cell FROM range(196)),
cb AS (SELECT cell, CAST(cell // 14 AS INT) AS row, CAST(cell % 14 AS INT) AS col FROM cells),
lc AS (SELECT CAST(least(floor((CAST(-37.5 AS DOUBLE) - Latitude) / {LAT_STEP}), 13) * 14
              + least(floor((Longitude - CAST(144.35 AS DOUBLE)) / {LON_STEP}), 13) AS INT) AS cell
       FROM listings WHERE Latitude BETWEEN -38.5 AND -37.5 AND Longitude BETWEEN 144.35 AND 145.40)
SELECT cb.cell, row, col,
  round_even(CAST(-37.5 AS DOUBLE) - (row + 1) * {LAT_STEP}, 4) AS lat_lo,
  round_even(CAST(-37.5 AS DOUBLE) - row * {LAT_STEP}, 4) AS lat_hi,
  round_even(CAST(144.35 AS DOUBLE) + col * {LON_STEP}, 4) AS lon_lo,
  round_even(CAST(144.35 AS DOUBLE) + (col + 1) * {LON_STEP}, 4) AS lon_hi,
  CAST(count(lc.cell) AS BIGINT) AS n
FROM cb LEFT JOIN lc ON cb.cell = lc.cell GROUP BY cb.cell, row, col"""))
def q_grid(spark, sf_dir):
    cells = SP.grid_cells(spark)
    return SP.grid_counts(base.listings(spark, sf_dir), cells)


def boundary_candidates(spark, sf_dir):
    l = base.listings(spark, sf_dir)
    return l.select(*[F.expr(e).alias(n) for n, e in standin.BOUNDARY_COLS])


@register("boundary_pick", O.with_listings(f"""
, cand AS (SELECT {', '.join(f'{e} AS {n}' for n, e in standin.BOUNDARY_COLS)} FROM listings),
done AS (SELECT DISTINCT upper(trim(Suburb)) AS suburb_key FROM listings WHERE {standin.DONE_SUBURBS}),
c AS (SELECT *, upper(trim(suburb)) AS suburb_key FROM cand),
r AS (SELECT *, row_number() OVER (PARTITION BY suburb_key ORDER BY
        CASE WHEN class = 'boundary' OR type = 'administrative' THEN 0 ELSE 1 END, pos) AS rn
      FROM c WHERE suburb_key NOT IN (SELECT suburb_key FROM done))
SELECT suburb_key, pos, class, type, geom_type, coordinates FROM r
WHERE rn = 1 AND geom_type IN ('Polygon', 'MultiPolygon')"""))
def q_boundary_pick(spark, sf_dir):
    l = base.listings(spark, sf_dir)
    done = l.where(standin.DONE_SUBURBS).select(F.col("Suburb").alias("suburb")).distinct()
    return SP.pick_boundary(boundary_candidates(spark, sf_dir), done)


@register("choropleth", O.with_cleaned(f"""
, fs AS (SELECT Suburb, {standin.PRED} AS pred FROM cleaned WHERE Status = 'For Sale'),
cand AS (SELECT {', '.join(f'{e} AS {n}' for n, e in standin.BOUNDARY_COLS)} FROM listings),
c AS (SELECT *, upper(trim(suburb)) AS suburb_key FROM cand),
r AS (SELECT *, row_number() OVER (PARTITION BY suburb_key ORDER BY
        CASE WHEN class = 'boundary' OR type = 'administrative' THEN 0 ELSE 1 END, pos) AS rn FROM c),
b AS (SELECT suburb_key, geom_type, coordinates FROM r WHERE rn = 1 AND geom_type IN ('Polygon', 'MultiPolygon')),
m AS (SELECT upper(trim(Suburb)) AS suburb_key, CAST(count(*) AS BIGINT) AS n_listings,
        round_even(quantile_cont(pred, 0.5), 2) AS median_predicted FROM fs GROUP BY 1)
SELECT m.suburb_key, n_listings, median_predicted, geom_type, coordinates FROM m JOIN b ON m.suburb_key = b.suburb_key"""))
def q_choropleth(spark, sf_dir):
    from estatelens.operators.quantiles import exact_percentiles
    c = base.cleaned(spark, sf_dir).where("Status = 'For Sale'")
    fs = c.select(F.upper(F.trim("Suburb")).alias("suburb_key"), F.expr(standin.PRED).alias("pred"))
    m = exact_percentiles(fs, ["suburb_key"], "pred", {"median_predicted": 0.5}, count_alias="n_listings")
    b = SP.pick_boundary(boundary_candidates(spark, sf_dir))
    return m.select("suburb_key", "n_listings", F.bround("median_predicted", 2).alias("median_predicted")) \
        .join(b.select("suburb_key", "geom_type", "coordinates"), "suburb_key")
