"""Post-processing of model outputs and error analysis
(K12 post, H13-H17, H19, H20, D25, D26, D28, D29, E8, V1, V4, C13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estatelens import params as P
from estatelens.functions import scalars as S
from estatelens.operators.common import broadcast_checked
from estatelens.params import DEFAULT, Params

PREDICTION_COLUMNS = [
    "Property_ID", "Status", "Suburb", "Postcode", "Property_Type", "Beds", "Baths",
    "Car_Spaces", "LandSize_sqm", "Latitude", "Longitude", "Distance_to_CBD_km",
    "Raw_Price", "Numeric_Price", "Predicted_Price", "Predicted_Price_Lower",
    "Predicted_Price_Upper", "Interval_Width_Pct", "Deal_Signal", "is_land", "out_of_metro",
    "is_new_build", "abs_median_age", "abs_median_income_weekly", "crime_rate_per_100k",
    "dist_nearest_train_km", "Last_Updated", "URL",
]


def postprocess(df: DataFrame, point: str, q_lo: str, q_hi: str,
                p: Params = DEFAULT) -> DataFrame:
    """Order the interval around the point, width % from unrounded values,
    round all three to the nearest 1 000 (half-even), classify the deal on
    the rounded prediction."""
    lower, upper = S.interval_bounds(point, q_lo, q_hi)
    out = df.withColumns({
        "Interval_Width_Pct": S.interval_width_pct(point, lower, upper),
        "Predicted_Price": S.round_thousand(point),
        "Predicted_Price_Lower": S.round_thousand(lower),
        "Predicted_Price_Upper": S.round_thousand(upper),
    })
    return out.withColumn("Deal_Signal", S.deal_signal("Predicted_Price", "Numeric_Price",
                                                       p.deal_threshold, p.deal_basis))


def prediction_view(scored: DataFrame) -> DataFrame:
    """The published columns that exist, in publication order."""
    return scored.select(*[c for c in PREDICTION_COLUMNS if c in scored.columns])


def signal_distribution(scored: DataFrame) -> DataFrame:
    """Rows and % per deal signal (total from a one-row aggregate)."""
    counts = scored.groupBy("Deal_Signal").agg(F.count(F.lit(1)).alias("n"))
    total = scored.agg(F.count(F.lit(1)).alias("__t"))
    return counts.crossJoin(F.broadcast(total)).select(   # one-row side
        "Deal_Signal", "n", F.bround(F.col("n") * 100.0 / F.col("__t"), 4).alias("pct"))


def first_k_per_group(df: DataFrame, group: str, order, k: int = 3, salt: int = 64) -> DataFrame:
    """The first k rows per group under a total order (ties impossible
    when ``order`` ends in a key).

    Two-phase top-k: rows are first ranked inside (group, salt) buckets, so
    a hot group is spread over ``salt`` tasks; only each bucket's top k
    reach the final per-group ranking (at most salt x k rows per group).
    Where the order begins with a text, rows that cannot be among the first k are
    left out before any row is sorted (``_within_reach``)."""
    order = list(order)
    keys = [o for o in order if isinstance(o, str)] or [group]
    if isinstance(order[0], str) and isinstance(df.schema[order[0]].dataType, T.StringType):
        df = _within_reach(df, group, order[0], k, salt)
    w1 = Window.partitionBy(group, "__salt").orderBy(*order)
    pre = (df.withColumn("__salt", F.pmod(F.xxhash64(*keys), F.lit(salt)))
           .withColumn("__rn", F.row_number().over(w1)).where(F.col("__rn") <= k)
           .drop("__rn", "__salt"))
    w2 = Window.partitionBy(group).orderBy(*order)
    return pre.withColumn("__rn", F.row_number().over(w2)).where(F.col("__rn") <= k).drop("__rn")


def _within_reach(df: DataFrame, group: str, text: str, k: int, salt: int) -> DataFrame:
    """``df`` without rows that k rows of their group surely come before in the order of ``text`` (nulls first).

    A text's first seven bytes are a number of the same order.  The least number of each of
    ``salt`` buckets of a group belongs to a row of its own, so the k-th least of these is a bound that at
    least k rows keep.  Sums and sorts are of salt rows per group; a group of fewer than k buckets stays whole."""
    number = F.coalesce(F.conv(F.rpad(F.substring(F.hex(F.encode(F.col(text), "UTF-8")), 1, 14), 14, "0"), 16, 10).cast("long"), F.lit(-1))
    found = df.withColumn("__at", number)
    least = (found.groupBy(group, F.pmod(F.xxhash64(text), F.lit(salt)).alias("__b")).agg(F.min("__at").alias("__at"))
             .groupBy(F.col(group).alias("__g")).agg(F.get(F.sort_array(F.collect_list("__at")), k - 1).alias("__most")))
    return (found.join(broadcast_checked(least), F.col(group).eqNullSafe(F.col("__g")), "left")
            .where(F.col("__most").isNull() | (F.col("__at") <= F.col("__most"))).drop("__at", "__g", "__most"))


def scatter_samples(df: DataFrame, key: str, predicted: str, features: Sequence[str],
                    bins: int = 20, k: int = 25) -> DataFrame:
    """V3: (feature, bin, value, key, predicted): up to ``k`` rows of each of ``bins`` equal parts of each feature's range.

    The rows with the least md5 of their key are taken, so that reruns agree and sparse
    parts of a range stay visible.  Null and NaN values and predictions are left out; a
    feature of one value has one part.  One pass for the ranges, one for the bounds of
    the samples, one for the samples; few rows more than those returned are sorted."""
    ok = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    rows = df.where(ok(predicted)).select(key, predicted, *features)
    ranges = rows.agg(*[f(F.when(ok(c), F.col(c).cast("double"))).alias(f"__{n}_{c}")
                        for c in features for n, f in (("lo", F.min), ("hi", F.max))])
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.when(ok(c), F.col(c).cast("double")).alias("value"),
                               F.col(f"__lo_{c}").alias("lo"), F.col(f"__hi_{c}").alias("hi")) for c in features])
    rows = rows.withColumn("__h", F.md5(F.col(key).cast("string")))
    long = (rows.crossJoin(F.broadcast(ranges)).select(key, predicted, "__h", F.explode(cells).alias("c"))   # one-row side
            .where(F.col("c.value").isNotNull()))
    part = F.when(F.col("c.hi") > F.col("c.lo"), F.least(F.lit(bins - 1), F.floor(
        (F.col("c.value") - F.col("c.lo")) / (F.col("c.hi") - F.col("c.lo")) * bins))).otherwise(0).cast("int")
    long = long.select("c.feature", part.alias("bin"), "c.value", key, predicted, "__h")
    grouped = long.withColumn("__cell", F.struct("feature", "bin"))
    return first_k_per_group(grouped, "__cell", ["__h", key], k).drop("__cell", "__h")


def regression_metrics(df: DataFrame, actual: str, predicted: str, by=()) -> DataFrame:
    """RMSE, MAE, MAPE (AUD) and R^2, RMSE, MAE on the log1p scale, one pass."""
    y, yh = F.col(actual), F.col(predicted)
    e = y - yh
    yl, pl = F.log1p(y), F.log1p(yh)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (F.avg(F.abs(e / y)) * 100).alias("mape"),
        (1 - F.sum((yl - pl) * (yl - pl)) / (F.var_pop(yl) * F.count(F.lit(1)))).alias("r2_log"),
        F.sqrt(F.avg((yl - pl) * (yl - pl))).alias("rmse_log"),
        F.avg(F.abs(yl - pl)).alias("mae_log"))


def segment_errors(df: DataFrame, actual: str, predicted: str, top_types: DataFrame) -> DataFrame:
    """N, RMSE, MAPE per property type (top types only), price bucket
    and year, in one grouping-sets aggregate; empty buckets are listed
    with n = 0 (left join from the bucket list)."""
    y, yh = F.col(actual), F.col(predicted)
    e = y - yh
    src = df.join(F.broadcast(top_types.withColumnRenamed("Property_Type", "__tt")),
                  F.col("Property_Type") == F.col("__tt"), "left").select(
        F.when(F.col("__tt").isNotNull(), F.col("Property_Type")).alias("seg_type"),
        S.price_bucket(actual).alias("seg_bucket"),
        F.col("Year").cast("string").alias("seg_year"),
        (e * e).alias("__se"), F.abs(e / y).alias("__ape"))
    g = src.groupingSets([["seg_type"], ["seg_bucket"], ["seg_year"]],
                         "seg_type", "seg_bucket", "seg_year").agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg("__se")).alias("rmse"),
        (F.avg("__ape") * 100).alias("mape"),
        F.grouping_id().alias("__gid"))
    kind = (F.when(F.col("__gid") == 3, F.lit("type")).when(F.col("__gid") == 5, F.lit("bucket"))
            .otherwise(F.lit("year")))
    seg = F.coalesce("seg_type", "seg_bucket", "seg_year")
    long = g.select(kind.alias("kind"), seg.alias("segment"), "n", "rmse", "mape") \
        .where(F.col("segment").isNotNull())
    buckets = df.sparkSession.createDataFrame(
        [("bucket", b) for b in P.PRICE_BUCKET_LABELS], "kind string, segment string")
    empty = buckets.join(long, ["kind", "segment"], "left_anti") \
        .select("kind", "segment", F.lit(0).cast("long").alias("n"),
                F.lit(None).cast("double").alias("rmse"), F.lit(None).cast("double").alias("mape"))
    return long.unionByName(empty)


def warnings(scored: DataFrame, known_suburbs: DataFrame) -> DataFrame:
    """Weak-segment warnings per listing (luxury, budget, new build,
    suburb unseen in training) as flags plus a compact label array."""
    ks = broadcast_checked(known_suburbs.select(F.col("Suburb").alias("__ks")).distinct())
    j = scored.join(ks, F.col("Suburb") == F.col("__ks"), "left")
    price = F.col("Predicted_Price")
    flags = {
        "warn_luxury": price > 2_500_000,
        "warn_budget": price < 500_000,
        "warn_new_build": F.col("is_new_build") == 1,
        "warn_cold_suburb": F.col("__ks").isNull(),
    }
    out = j.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in flags.items()})
    labels = F.array_compact(F.array(*[F.when(F.col(k), F.lit(k[5:])) for k in flags]))
    return out.withColumn("warnings", labels).drop("__ks")


def suburb_compare(scored: DataFrame, reference: DataFrame) -> DataFrame:
    """Each estimate next to its suburb's median sale price (% diff)."""
    ref = broadcast_checked(reference.select("Suburb", F.col("median_price").alias("suburb_median")))
    return scored.join(ref, "Suburb", "left").withColumn(
        "vs_suburb_pct", F.bround((F.col("Predicted_Price") / F.col("suburb_median") - 1) * 100, 1))


def filter_listings(view: DataFrame, types=None, suburbs=None, price_range=None,
                    beds_range=None, signals=None) -> DataFrame:
    """The dashboard's global filters as one parameterised predicate
    (pushed down to the scan when the view is read from Parquet)."""
    cond = F.lit(True)
    if types:
        cond = cond & F.col("Property_Type").isin(*types)
    if suburbs:
        cond = cond & F.col("Suburb").isin(*suburbs)
    if price_range:
        cond = cond & F.col("Predicted_Price").between(*price_range)
    if beds_range:
        cond = cond & F.col("Beds").between(*beds_range)
    if signals:
        cond = cond & F.col("Deal_Signal").isin(*signals)
    return view.where(cond)
