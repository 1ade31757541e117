"""Cleaning rules (one pass over one frame carrying both statuses).

Status-specific rules are conditional expressions rather than two frames;
fitted parameters (land-size caps, rare types) are small tables computed by
one aggregate and applied by a size-checked broadcast join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from estatelens.functions import scalars as S
from estatelens.operators.common import (broadcast_checked, desc_nulls_last, latest_per_key,
                                         materialize)
from estatelens.operators.quantiles import exact_percentiles
from estatelens.params import DEFAULT, Params

SOLD, FOR_SALE = "Sold", "For Sale"
#: Columns of a listing that the rules read; the others are carried along.
RULE_COLUMNS = ("Property_ID", "Status", "Property_Type", "Date", "Beds", "Baths", "Car_Spaces", "LandSize_sqm",
                "Raw_Price", "Numeric_Price", "Latitude", "Longitude", "Last_Updated")


def parse_dates(df: DataFrame) -> DataFrame:
    """H6/H8: Date text -> Date_parsed, Year, Month."""
    d = S.parse_listing_date("Date")
    return df.withColumns({"Date_parsed": d, "Year": S.year_of(d), "Month": S.month_of(d)})


def drop_rule_flags(df: DataFrame) -> dict[str, F.Column]:
    """B3/B4 as boolean columns (True = the row is removed)."""
    return {
        "sold_no_date": (F.col("Status") == SOLD) & F.col("Date_parsed").isNull(),
        "forsale_broken": (F.col("Status") == FOR_SALE) & F.col("Property_Type").isNull()
        & F.col("LandSize_sqm").isNull() & F.col("Raw_Price").isNull(),
    }


def apply_drop_rules(df: DataFrame) -> DataFrame:
    """Drop Sold rows without a date and broken For Sale rows."""
    f = drop_rule_flags(df)
    return df.where(~F.coalesce(f["sold_no_date"] | f["forsale_broken"], F.lit(False)))


def dedup_key_order() -> list:
    """Most recent Last_Updated first (nulls last), then price, then text."""
    return (desc_nulls_last("Last_Updated") + desc_nulls_last("Numeric_Price")
            + desc_nulls_last("Raw_Price"))


def dedup_recent(df: DataFrame) -> DataFrame:
    """For Sale rows keep the most recent ``Last_Updated`` per id; Sold rows
    pass untouched (G1 union of both); other statuses go."""
    sold = df.where(F.col("Status") == "Sold")
    fs = latest_per_key(df.where(F.col("Status") == FOR_SALE), ["Property_ID"],
                        dedup_key_order())
    return sold.unionByName(fs)


def land_flag(p: Params = DEFAULT) -> F.Column:
    """Land type, or no rooms with positive land (null comparisons false)."""
    type_land = F.coalesce(F.col("Property_Type").isin(*p.land_types), F.lit(False))
    no_rooms = F.coalesce((F.col("Beds") == 0) & (F.col("Baths") == 0), F.lit(False))
    has_land = F.coalesce(F.col("LandSize_sqm"), F.lit(0.0)) > 0
    return (type_land | (no_rooms & has_land)).cast("int")


def landsize_caps(flagged: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Per-type cap from positive land sizes of Sold rows.

    Types with fewer than ``cap_min_rows`` rows get no cap; rural types use
    the 99.9th percentile, all others the 99th (linear interpolation).
    """
    src = flagged.where((F.col("Status") == SOLD) & F.col("Property_Type").isNotNull()
                        & (F.col("LandSize_sqm") > 0))
    q = exact_percentiles(src, ["Property_Type"], "LandSize_sqm",
                          {"q_res": p.cap_q_residential, "q_rural": p.cap_q_rural},
                          count_alias="n")
    cap = F.when(F.col("Property_Type").isin(*p.rural_large_types), F.col("q_rural")) \
        .otherwise(F.col("q_res"))
    return q.where(F.col("n") >= p.cap_min_rows).select("Property_Type", cap.alias("cap"))


def apply_clean_rules(flagged: DataFrame, caps: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """B6-B14 as one projection (after the caps join)."""
    cap_cols = caps.select(F.col("Property_Type").alias("__cap_type"), "cap")
    j = flagged.join(cap_cols, F.col("Property_Type") == F.col("__cap_type"), "left")
    ptype = F.coalesce(F.col("Property_Type"), F.lit("Unknown"))
    beds = F.when(F.col("Beds") > p.rooms_cap, F.lit(p.rooms_cap)).otherwise(F.col("Beds"))
    cars = F.when(F.col("Car_Spaces") > p.rooms_cap, F.lit(p.rooms_cap)) \
        .otherwise(F.col("Car_Spaces"))
    baths0 = F.when((beds > 0) & (F.col("Baths") > beds * p.baths_per_bed),
                    beds * p.baths_per_bed).otherwise(F.col("Baths"))
    baths1 = F.when(baths0 > p.rooms_cap, F.lit(p.rooms_cap)).otherwise(baths0)
    zero_rooms = F.coalesce((beds == 0) & (F.col("is_land") == 0), F.lit(False))
    land = F.col("LandSize_sqm")
    bad_zero = F.coalesce((land == 0) & ~ptype.isin(*p.apt_like_types)
                          & (F.col("is_land") == 0), F.lit(False))
    land1 = F.when(bad_zero, F.lit(None).cast("double")).otherwise(land)
    land2 = F.when(F.col("cap").isNotNull() & (land1 > F.col("cap")), F.col("cap")).otherwise(land1)
    lat_ok = F.coalesce(F.col("Latitude").between(p.lat_min, p.lat_max), F.lit(False))
    lon_ok = F.coalesce(F.col("Longitude").between(p.lon_min, p.lon_max), F.lit(False))
    price = F.col("Numeric_Price")
    in_range = price.between(p.price_floor, p.price_ceiling)
    fs_bad = (F.col("Status") == FOR_SALE) & price.isNotNull() & ~in_range
    out = j.withColumns({
        "Property_Type": ptype,
        "Beds": F.when(zero_rooms, F.lit(None).cast("double")).otherwise(beds),
        "Car_Spaces": cars,
        "Baths": F.when(zero_rooms, F.lit(None).cast("double")).otherwise(baths1),
        "LandSize_sqm": land2,
        "out_of_metro": (~lat_ok | ~lon_ok).cast("int"),
        "Numeric_Price": F.when(fs_bad, F.lit(None).cast("double")).otherwise(price),
        "Raw_Price": F.when(fs_bad, F.lit("Contact Agent")).otherwise(F.col("Raw_Price")),
    })
    sold_drop = (F.col("Status") == SOLD) & price.isNotNull() & ~in_range
    return out.where(~sold_drop).drop("__cap_type", "cap")


def rare_types(cleaned: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Types with fewer than ``rare_type_threshold`` rows on the cleaned union."""
    return (cleaned.groupBy("Property_Type").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") < p.rare_type_threshold))


@dataclass
class CleanResult:
    cleaned: DataFrame
    caps: DataFrame
    flagged: DataFrame


def clean(listings: DataFrame, p: Params = DEFAULT, check_caps: bool = True) -> CleanResult:
    """Full cleaning stage: parse -> drops -> dedup -> land flag -> caps ->
    rules.  Caps are fitted on the flagged Sold rows before any clipping."""
    parsed = parse_dates(listings)
    kept = apply_drop_rules(parsed)
    dedup = dedup_recent(kept)
    # Two consumers (cap fitting, rule application): written once so the
    # parse/drop/dedup work is not repeated.
    flagged = materialize(dedup.withColumn("is_land", land_flag(p)), "flagged")
    caps = materialize(landsize_caps(flagged, p), "caps")   # fitted once, reused
    caps_b = broadcast_checked(caps, materialized=True) if check_caps else caps
    return CleanResult(apply_clean_rules(flagged, caps_b, p), caps, flagged)


def accounted_clean(listings: DataFrame, p: Params = DEFAULT) -> tuple[CleanResult, DataFrame]:
    """M2: the cleaning stage and its books, from metrics observed while it runs.

    One row per step in the order of the rules: ``step_no``, ``step``,
    ``rows_before``, ``removed``, ``rows_after``; a step begins with the rows the
    one before left, the last leaves the rows of ``cleaned``.  Each status is one
    branch and each rule is observed in its branch, so a row that breaks two
    rules is booked once, under the first.  Rows of other (or no) status leave in
    the first step; an empty table has zeros throughout."""
    parsed = parse_dates(listings)
    rules = {k: F.coalesce(c, F.lit(False)) for k, c in drop_rule_flags(parsed).items()}
    price = F.col("Numeric_Price")
    sold, sale, flags, out = (Observation(f"clean-{n}") for n in ("sold", "sale", "flagged", "out"))
    rows = F.count(F.lit(1)).alias("rows")
    s = parsed.where(F.col("Status") == SOLD).observe(sold, rows, F.count_if(rules["sold_no_date"]).alias("gone")) \
        .where(~rules["sold_no_date"])
    f = parsed.where(F.col("Status") == FOR_SALE).observe(sale, rows, F.count_if(rules["forsale_broken"]).alias("gone")) \
        .where(~rules["forsale_broken"])
    kept = s.unionByName(latest_per_key(f, ["Property_ID"], dedup_key_order())).withColumn("is_land", land_flag(p))
    flagged = materialize(kept.observe(flags, rows, F.count_if(
        (F.col("Status") == SOLD) & price.isNotNull() & ~price.between(p.price_floor, p.price_ceiling)).alias("gone")), "flagged")
    caps = materialize(landsize_caps(flagged, p), "caps")
    cleaned = materialize(apply_clean_rules(flagged, broadcast_checked(caps, materialized=True), p).observe(out, rows), "cleaned")
    total = listings.count()
    a, b, c = (o.get for o in (sold, sale, flags))
    removed = [("other_status", total - a["rows"] - b["rows"]), ("sold_no_date", a["gone"]), ("forsale_broken", b["gone"]),
               ("forsale_repeated", a["rows"] - a["gone"] + b["rows"] - b["gone"] - c["rows"]), ("sold_price_range", c["gone"])]
    books, left = [], total
    for i, (step, gone) in enumerate(removed, 1):
        books.append((i, step, left, gone, left - gone))
        left -= gone
    if left != out.get["rows"]:
        raise ValueError(f"books leave {left} rows, the cleaned table has {out.get['rows']}")
    steps = listings.sparkSession.createDataFrame(
        books, "step_no int, step string, rows_before long, removed long, rows_after long")
    return CleanResult(cleaned, caps, flagged), steps


def removal_audit(listings: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """M2: rows hit by each removal/nullify rule, per status, in one pass."""
    parsed = parse_dates(listings)
    f = drop_rule_flags(parsed)
    price = F.col("Numeric_Price")
    out_range = price.isNotNull() & ~price.between(p.price_floor, p.price_ceiling)
    return parsed.groupBy("Status").agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(f["sold_no_date"]).alias("sold_no_date"),
        F.count_if(F.coalesce(f["forsale_broken"], F.lit(False))).alias("forsale_broken"),
        F.count_if(out_range).alias("price_out_of_range"),
        (F.count(F.lit(1)) - F.count_distinct("Property_ID")).alias("duplicate_ids"),
    )
