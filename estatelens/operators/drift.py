"""Distribution drift and cold-start coverage.

The two-sample KS statistic is computed without collecting either sample:
values are stacked per feature (``unpivot``), counted per (feature, value)
for both groups, and the two empirical CDFs come from the skew-safe
``running_totals`` job.  D = max |F_sold - F_for_sale| per feature.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.operators.common import materialize
from estatelens.operators.quantiles import exact_percentiles, running_totals


def ks_pvalue(d, n1, n2, terms: int = 8):
    """Asymptotic two-sided p-value (Kolmogorov limit with Stephens'
    small-sample correction) as a Column expression.

    The limit has two series; each converges within a few terms on its side of
    lambda = 1, and identical samples (lambda 0) have p = 1."""
    en = F.sqrt(n1 * n2 / (n1 + n2))
    lam = (en + 0.12 + 0.11 / en) * d
    s = None
    for k in range(1, terms + 1):
        t = F.lit((-1.0) ** (k - 1)) * F.exp(F.lit(-2.0 * k * k) * lam * lam)
        s = t if s is None else s + t
    near = None
    for k in range(1, terms + 1):
        t = F.exp(F.lit(-((2 * k - 1) * math.pi) ** 2 / 8) / (lam * lam))
        near = t if near is None else near + t
    p = F.when(lam <= 0, 1.0).when(lam < 1, 1 - math.sqrt(2 * math.pi) / lam * near).otherwise(2 * s)
    return F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))


def ks_drift(df: DataFrame, features: Sequence[str], group: str, a: str, b: str) -> DataFrame:
    """Per feature the KS statistic between group ``a`` and ``b``, the
    asymptotic p-value, both medians and sample sizes; desc by statistic."""
    feats = list(features)
    long = df.where(F.col(group).isin(a, b)).select(
        group, *[F.col(c).cast("double").alias(c) for c in feats]) \
        .unpivot([group], feats, "feature", "value").where(F.col("value").isNotNull())
    counts = materialize(long.groupBy("feature", "value").agg(
        F.count_if(F.col(group) == a).alias("na"), F.count_if(F.col(group) == b).alias("nb")),
        "ks-counts")
    cum = running_totals(counts, ["feature"], "value", ["na", "nb"])
    tot = counts.groupBy("feature").agg(F.sum("na").alias("tot_a"), F.sum("nb").alias("tot_b"))
    stat = cum.join(tot, "feature").groupBy("feature", "tot_a", "tot_b").agg(
        F.max(F.abs(F.col("cum_na") / F.col("tot_a") - F.col("cum_nb") / F.col("tot_b")))
        .alias("ks_stat"))
    med = exact_percentiles(long, ["feature", group], "value", {"m": 0.5})
    meds = med.groupBy("feature").agg(
        F.max(F.when(F.col(group) == a, F.col("m"))).alias("median_a"),
        F.max(F.when(F.col(group) == b, F.col("m"))).alias("median_b"))
    out = stat.join(meds, "feature", "left")
    return out.select("feature", "median_a", "median_b", "ks_stat",
                      ks_pvalue(F.col("ks_stat"), F.col("tot_a"), F.col("tot_b")).alias("p_value"),
                      F.col("tot_a").alias("n_a"), F.col("tot_b").alias("n_b"))


def cold_start(df: DataFrame, col: str, group: str, a: str, b: str) -> DataFrame:
    """Value-set overlap between groups a (seen) and b (new): shared,
    only-in-b (cold start), only-in-a (absent), and b rows affected."""
    vals = df.where(F.col(col).isNotNull() & F.col(group).isin(a, b)).groupBy(col).agg(
        F.count_if(F.col(group) == a).alias("__na"), F.count_if(F.col(group) == b).alias("__nb"))
    return vals.agg(
        F.lit(col).alias("dimension"),
        F.count_if(F.col("__na") > 0).alias("n_values_a"),
        F.count_if(F.col("__nb") > 0).alias("n_values_b"),
        F.count_if((F.col("__na") > 0) & (F.col("__nb") > 0)).alias("n_shared"),
        F.count_if((F.col("__na") == 0) & (F.col("__nb") > 0)).alias("n_cold_start"),
        F.count_if((F.col("__na") > 0) & (F.col("__nb") == 0)).alias("n_absent"),
        F.coalesce(F.sum(F.when(F.col("__na") == 0, F.col("__nb"))), F.lit(0)).alias("cold_rows"),
        F.sum("__nb").alias("rows_b"))


def cold_start_examples(df: DataFrame, col: str, group: str, a: str, b: str,
                        n: int = 10) -> DataFrame:
    """First n cold-start values in sorted order (values seen only in b)."""
    # distinct first (map-side combined), so a hot value is one row per task
    seen = df.where(F.col(group) == a).select(col).distinct()
    new = df.where((F.col(group) == b) & F.col(col).isNotNull()).select(col).distinct()
    return new.join(seen, col, "left_anti").orderBy(col).limit(n)


def id_overlap(df: DataFrame, key: str, group: str, a: str, b: str) -> DataFrame:
    """Ids present in both groups (set intersection)."""
    return df.where(F.col(group) == a).select(key).intersect(
        df.where(F.col(group) == b).select(key))
