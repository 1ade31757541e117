"""Listing ingestion: payload flattening, change detection, upsert
(A6, A7, A14, C9, E1, E2, S1 batch form).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estatelens.functions import scalars as S
from estatelens.operators.common import broadcast_checked, latest_per_key, materialize

LISTING_MODEL = T.StructType([
    T.StructField("price", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("dateSold", T.StringType()), T.StructField("dateListed", T.StringType()),
    T.StructField("status", T.StructType([T.StructField("date", T.StringType())])),
    T.StructField("address", T.StructType([
        T.StructField("street", T.StringType()), T.StructField("suburb", T.StringType()),
        T.StructField("postcode", T.StringType()), T.StructField("lat", T.DoubleType()),
        T.StructField("lng", T.DoubleType())])),
    T.StructField("geolocation", T.StructType([
        T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType())])),
    T.StructField("features", T.StructType([
        T.StructField("propertyTypeFormatted", T.StringType()),
        T.StructField("propertyType", T.StringType()), T.StructField("beds", T.IntegerType()),
        T.StructField("baths", T.IntegerType()), T.StructField("parking", T.IntegerType()),
        T.StructField("carspaces", T.IntegerType()), T.StructField("landSize", T.StringType()),
        T.StructField("landUnit", T.StringType())])),
])
PAYLOAD = T.StructType([T.StructField("props", T.StructType([T.StructField("pageProps", T.StructType([
    T.StructField("componentProps", T.StructType([
        T.StructField("totalPages", T.IntegerType()),
        T.StructField("listingsMap", T.MapType(T.StringType(), T.StructType([
            T.StructField("listingModel", LISTING_MODEL)])))]))]))]))])


def explode_payloads(pages: DataFrame, payload_col: str = "payload",
                     label_col: str = "status_label") -> DataFrame:
    """JSON page -> one row per listing (id, model, raw record JSON),
    plus the page's totalPages (default 1)."""
    p = pages.select(label_col, F.from_json(payload_col, PAYLOAD).alias("__p"))
    cp = p.select(label_col, F.coalesce(F.col("__p.props.pageProps.componentProps.totalPages"),
                                        F.lit(1)).alias("total_pages"),
                  F.explode("__p.props.pageProps.componentProps.listingsMap").alias("pid", "item"))
    return cp.select("pid", label_col, "total_pages", F.col("item.listingModel").alias("m"),
                     F.to_json("item").alias("record_json"))


# Fixed value: the id of the script that holds a page's data.
SCRIPT_ID = "__NEXT_DATA__"


def payload_of_html(pages: DataFrame, html_col: str = "html", payload_col: str = "payload",
                    state_col: str = "state") -> DataFrame:
    """``pages`` with the JSON text of their data script and a state: ``ok``, ``no script`` or ``not json``.

    The payload is null unless the state is ``ok``; null and empty pages have no script,
    an empty script counts as none, and of several the first is taken."""
    tag = rf"""(?is)<script\b(?=[^>]*\sid\s*=\s*["']?{SCRIPT_ID}["'\s>])[^>]*>(.*?)</script\s*>"""
    body = F.btrim(F.regexp_extract(F.coalesce(F.col(html_col), F.lit("")), tag, 1), F.lit(" \t\r\n"))
    found = pages.withColumn("__body", body)
    state = (F.when(F.col("__body") == "", "no script")
             .when(F.try_parse_json("__body").isNull(), "not json").otherwise("ok"))
    return (found.withColumn(state_col, state)
            .withColumn(payload_col, F.when(F.col(state_col) == "ok", F.col("__body"))).drop("__body"))


def flatten_listings(items: DataFrame, as_of: _dt.date, label_col: str = "status_label",
                     keep: Sequence[str] = ()) -> DataFrame:
    """Listing model -> RAW row with the reference defaults, and the columns ``keep``;
    listings without a street are dropped."""
    m = lambda c: F.col(f"m.{c}")
    street = F.coalesce(m("address.street"), F.lit("N/A"))
    suburb = F.upper(F.coalesce(m("address.suburb"), F.lit("Map Area")))
    postcode = F.coalesce(m("address.postcode"), F.lit(""))
    lat = F.coalesce(m("address.lat"), m("geolocation.latitude"))
    lng = F.coalesce(m("address.lng"), m("geolocation.longitude"))
    raw_price = F.coalesce(m("price"), F.lit("N/A"))
    out = items.where(street != "N/A").select(
        F.col("pid").alias("Property_ID"), F.col(label_col).alias("Status"),
        S.full_address(street, suburb, postcode).alias("Full_Address"),
        suburb.alias("Suburb"), postcode.alias("Postcode"),
        F.coalesce(m("features.propertyTypeFormatted"), m("features.propertyType"),
                   F.lit("N/A")).alias("Property_Type"),
        S.pick_listing_date(m("dateSold"), m("dateListed"), m("status.date"),
                            F.col("record_json")).alias("Date"),
        F.coalesce(m("features.beds"), F.lit(0)).cast("double").alias("Beds"),
        F.coalesce(m("features.baths"), F.lit(0)).cast("double").alias("Baths"),
        F.coalesce(m("features.parking"), m("features.carspaces"), F.lit(0)).cast("double")
        .alias("Car_Spaces"),
        S.land_size_sqm(m("features.landSize"), m("features.landUnit")).alias("LandSize_sqm"),
        raw_price.alias("Raw_Price"), S.parse_price(raw_price).alias("Numeric_Price"),
        lat.alias("Latitude"), lng.alias("Longitude"),
        S.distance_to_cbd_km(lat, lng).alias("Distance_to_CBD_km"),
        S.listing_url(m("url")).alias("URL"), S.stamp(as_of).alias("Last_Updated"), *keep)
    return out


def keep_last(df: DataFrame, keys: Sequence[str], arrival: Sequence) -> DataFrame:
    """One row per key, the last arrival (greatest ``arrival``);
    partial aggregation keeps a hot key from landing whole in one task."""
    return latest_per_key(df, keys, [F.col(a) if isinstance(a, str) else a for a in arrival])


def group_counts(df: DataFrame, group: str, alias: str) -> DataFrame:
    """Rows per group attached to every row (null group -> null).  An
    aggregate + join instead of a window, so a hot group is pre-aggregated
    map-side rather than buffered in one task."""
    cnt = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias(alias))
    return df.drop(alias).join(broadcast_checked(cnt), group, "left")


def upsert(old: DataFrame, new: DataFrame, key: str, count_group: str = "Suburb",
           count_alias: str = "Propertycount", arrival: Sequence[str] = ()) -> DataFrame:
    """Old then new, keep the latest row per key, refresh counts.  Rows of
    one key within a batch go by the ``arrival`` columns; rows that tie even
    there go by their content, so reruns agree."""
    o = old.withColumn("__seq", F.lit(0))
    n = new.withColumn("__seq", F.lit(1))
    both = o.unionByName(n, allowMissingColumns=True)
    content = F.xxhash64(*[F.col(f"`{c}`") for c in both.columns])
    kept = keep_last(both, [key], ["__seq", *arrival, content]).drop("__seq")
    return group_counts(kept, count_group, count_alias)


def changed_only(batch: DataFrame, state: DataFrame, key: str, pair: Sequence[str]) -> DataFrame:
    """Rows whose key is unknown, or known with a different pair
    (null-safe equality, so a missing price matches a missing price)."""
    st = state.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__s_{c}") for c in pair])
    cond = F.col(key) == F.col("__k")
    for c in pair:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__s_{c}"))
    return batch.join(st, cond, "left_anti")


def previous_values(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str],
                    prefix: str = "prev_") -> DataFrame:
    """Distributed ``lag``: each row gets the previous row's ``cols`` for the
    same key in ``order`` (null for a key's first row).

    Rows are range-partitioned on (key, order) -- a hot key is split across
    partitions -- and numbered inside each sorted partition; the predecessor
    is the row numbered one lower in the same partition (an equi-join on
    unique ids), or, for a partition's first row, the last row of the
    previous partition (a table with one row per partition).
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    allk = [key, *order]
    s = (df.repartitionByRange(n, *allk).sortWithinPartitions(*allk)
         .withColumn("__pid", F.spark_partition_id())
         .withColumn("__mid", F.monotonically_increasing_id()))
    s = materialize(s, "lag-sorted")
    payload = [key, *cols]
    prev_in = s.select((F.col("__mid") + 1).alias("__mid"),
                       *[F.col(c).alias(f"__p_{c}") for c in payload])
    j = s.join(prev_in, "__mid", "left")
    tails = s.groupBy("__pid").agg(F.max_by(F.struct(*[F.col(c).alias(f"__t_{c}") for c in payload]),
                                            F.col("__mid")).alias("__t"),
                                   F.min("__mid").alias("__first"))
    # one row per partition: bounded by the partition count
    tails = tails.select((F.col("__pid") + 1).alias("__pid"), "__t")
    firsts = s.groupBy("__pid").agg(F.min("__mid").alias("__first"))
    j = j.join(F.broadcast(firsts), "__pid").join(F.broadcast(tails), "__pid", "left")
    is_first = F.col("__mid") == F.col("__first")
    out = j
    for c in payload:
        out = out.withColumn(f"__v_{c}", F.when(is_first, F.col(f"__t.__t_{c}"))
                             .otherwise(F.col(f"__p_{c}")))
    same = F.coalesce(F.col(f"__v_{key}") == F.col(key), F.lit(False))
    return out.select(*[c for c in df.columns], *[F.when(same, F.col(f"__v_{c}")).alias(f"{prefix}{c}")
                                     for c in cols])


def change_events(df: DataFrame, key: str, order: Sequence[str], pair: Sequence[str]) -> DataFrame:
    """S1 (batch form): a record is emitted when its key is new or its pair
    differs from the key's previous record (null-safe)."""
    pv = previous_values(df.withColumn("__has", F.lit(True)), key, order, [*pair, "__has"],
                         "__prev_")
    changed: Column = F.col("__prev___has").isNull()
    for c in pair:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"__prev_{c}"))
    return pv.where(changed).drop(*[f"__prev_{c}" for c in pair], "__prev___has", "__has")
