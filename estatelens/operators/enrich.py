"""Enrichment: census, offences, transit stops (B1, C1-C5, D7, D8, B20-B22,
G2, H7, H9).

Dimension tables are read as strings and coerced with ``try_cast``; every
join adds its nullable columns whether or not the source had rows, so the
output schema never depends on data availability.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.functions import scalars as S
from estatelens.operators.common import broadcast_checked
from estatelens.params import DEFAULT, Params

# --- header resolution (B1) -------------------------------------------------
# Census header spellings accepted for each canonical field.
POSTCODE_EXACT = ("region_id",)
INCOME_EXACT = ("median_tot_prsnl_inc_weekly", "med_tot_prsnl_inc_wk")
AGE_EXACT = ("median_age_persons", "med_age_persons")


def _is_postcode(n: str) -> bool:
    return n.startswith("poa_code") or n in POSTCODE_EXACT


def _is_income(n: str) -> bool:
    return n in INCOME_EXACT or ("median" in n and ("prsnl" in n or "personal" in n) and "inc" in n)


def _is_age(n: str) -> bool:
    # word-boundary match: "age" as its own token, so "mortgage" never matches
    return n in AGE_EXACT or ("median" in n and re.search(r"(^|_)age(_|$)", n) is not None)


CENSUS_RULES: list[tuple[str, Callable[[str], bool]]] = [
    ("postcode_raw", _is_postcode), ("abs_median_income_weekly", _is_income),
    ("abs_median_age", _is_age),
]


def resolve_headers(df: DataFrame, rules: Sequence[tuple[str, Callable[[str], bool]]],
                    strip: bool = True) -> DataFrame:
    """Map physical headers to canonical names (first matching rule per
    column; a later column mapping to an already-used name is dropped).
    Works on the schema only; one ``select`` of aliases."""
    used, cols = set(), []
    for c in df.columns:
        name = c.strip().lstrip("\ufeff") if strip else c
        low = name.lower()
        for canon, pred in rules:
            if pred(low):
                if canon not in used:
                    used.add(canon)
                    cols.append(F.col(f"`{c}`").alias(canon))
                break
    return df.select(*cols)


def census_table(g02: DataFrame, g01: DataFrame | None) -> DataFrame:
    """income/age by postcode left-joined with population by postcode."""
    a = resolve_headers(g02, CENSUS_RULES)
    for c in ("abs_median_income_weekly", "abs_median_age"):
        if c not in a.columns:
            a = a.withColumn(c, F.lit(None).cast("double"))
    a = a.select(S.extract_postcode("postcode_raw").alias("Postcode"),
                 S.to_number("abs_median_income_weekly").alias("abs_median_income_weekly"),
                 S.to_number("abs_median_age").alias("abs_median_age")).where("Postcode IS NOT NULL")
    if g01 is None:
        return a.withColumn("abs_population", F.lit(None).cast("double"))
    pc = next((c for c in g01.columns if _is_postcode(c.strip().lower())), None)
    pop = next((c for c in g01.columns if c.strip().lower() == "tot_p_p"), None) or \
        next((c for c in g01.columns if c.strip().lower().startswith("tot_p")), None)
    if pc is None or pop is None:
        return a.withColumn("abs_population", F.lit(None).cast("double"))
    p = g01.select(S.extract_postcode(F.col(f"`{pc}`")).alias("Postcode"),
                   S.to_number(F.col(f"`{pop}`")).alias("abs_population")) \
        .where("Postcode IS NOT NULL AND abs_population IS NOT NULL")
    return a.join(p, "Postcode", "left")


def offences_by_postcode(raw: DataFrame) -> DataFrame:
    """B22 + D7 + B21 + D8/C4: latest year only; offence total per postcode
    (rounded, > 0) with its most frequent suburb (ties: first by name)."""
    cols = {c.strip().lower(): c for c in raw.columns}
    pc = cols.get("postcode")
    yr = cols.get("year")
    sub = next((cols[k] for k in cols if "suburb" in k or "town" in k), None)
    cnt = next((cols[k] for k in cols if "offence count" in k or "incident count" in k), None)
    d = raw.select(F.col(f"`{pc}`").alias("__pc"),
                   (F.col(f"`{yr}`") if yr else F.lit(None)).alias("__yr"),
                   (F.col(f"`{sub}`") if sub else F.lit(None).cast("string")).alias("__sub"),
                   F.col(f"`{cnt}`").alias("__cnt"))
    d = d.select(S.to_number("__yr").alias("__yr"),
                 S.to_number("__pc").try_cast("int").alias("Postcode"),
                 F.col("__sub"), S.to_number("__cnt").alias("__cnt"))
    if yr:
        latest = d.agg(F.max("__yr").alias("__latest"))
        d = d.crossJoin(F.broadcast(latest)).where(F.col("__yr") == F.col("__latest"))  # one row
    d = d.where("Postcode IS NOT NULL AND __cnt IS NOT NULL")
    per_sub = d.groupBy("Postcode", "__sub").agg(F.count(F.lit(1)).alias("__n"), F.sum("__cnt").alias("__sum"))
    named = F.when(F.col("__sub").isNotNull(), F.struct(-F.col("__n"), F.col("__sub")))  # null: not a candidate
    return per_sub.groupBy("Postcode").agg(
        F.bround(F.sum("__sum"), 0).alias("crime_offence_count"),
        F.min_by("__sub", named).alias("crime_suburb_ref")).where("crime_offence_count > 0")


def enrich_listings(listings: DataFrame, census: DataFrame, offences: DataFrame,
                    nearest: DataFrame | None = None, as_of=None) -> DataFrame:
    """C1 + C3 + H7 (+ C6 result): size-checked broadcast left joins on
    Postcode; crime rate per 100k only when population > 0."""
    cb = broadcast_checked(census.select("Postcode", "abs_median_income_weekly",
                                         "abs_median_age", "abs_population"))
    ob = broadcast_checked(offences.select("Postcode", "crime_offence_count", "crime_suburb_ref"))
    out = listings.join(cb, "Postcode", "left").join(ob, "Postcode", "left")
    out = out.withColumn("crime_rate_per_100k",
                         S.rate_per_100k("crime_offence_count", "abs_population"))
    if nearest is not None:
        # distances belong to an id and its place: one row each, so no listing is doubled
        place = [c for c in ("Property_ID", "Latitude", "Longitude") if c in nearest.columns]
        out = out.join(nearest.distinct(), place, "left")
    if as_of is not None:
        out = out.withColumn("Enriched_Date", S.stamp(as_of))
    return out


def rail_stops(routes: DataFrame, trips: DataFrame, stop_times: DataFrame, stops: DataFrame,
               p: Params = DEFAULT) -> DataFrame:
    """C5 + T8 + G2 + B20: per feed, stops served by a rail trip (semi-join
    chain keyed by feed); with ``lenient_rail`` a feed without rail routes
    keeps all its stops; feeds are unioned, the first feed wins a shared
    stop_id, and only stops inside the box remain."""
    rail = broadcast_checked(routes.where(F.col("route_type").isin(*p.rail_route_types))
                             .select("feed_id", "route_id"))
    rail_trips = trips.join(rail, ["feed_id", "route_id"], "left_semi").select("feed_id", "trip_id")
    served = stop_times.join(rail_trips, ["feed_id", "trip_id"], "left_semi") \
        .select("feed_id", "stop_id").distinct()
    s = stops.select("feed_id", "stop_id", "stop_name",
                     S.to_number("stop_lat").alias("stop_lat"),
                     S.to_number("stop_lon").alias("stop_lon")) \
        .where("stop_lat IS NOT NULL AND stop_lon IS NOT NULL")
    kept = s.join(served, ["feed_id", "stop_id"], "left_semi")
    if p.lenient_rail:
        no_rail = s.select("feed_id").distinct().join(rail.select("feed_id").distinct(),
                                                      "feed_id", "left_anti")
        kept = kept.unionByName(s.join(no_rail, "feed_id", "left_semi"))
    first = kept.groupBy("stop_id").agg(F.min_by(F.struct("stop_name", "stop_lat", "stop_lon"),
                                                 F.col("feed_id")).alias("s"))
    out = first.select("stop_id", "s.*")
    return out.where(F.col("stop_lat").between(p.stop_lat_min, p.stop_lat_max)
                     & F.col("stop_lon").between(p.stop_lon_min, p.stop_lon_max))
