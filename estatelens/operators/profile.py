"""Profiling aggregates (D1-D6, D19-D24, D30-D34, F-1..F-3, F-6, M4).

Every report is one aggregate pass (``count_if``/``sum`` expressions side by
side) rather than one job per rule; ``unpivot`` turns wide results into the
long tables the reports print.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.operators.common import broadcast_checked
from estatelens.operators.quantiles import exact_percentiles, multi_column_percentiles


def value_counts(df: DataFrame, col: str, by: Sequence[str] = (), dropna: bool = True,
                 alias: str = "n") -> DataFrame:
    """Rows per value (optionally within ``by``); order desc count, value."""
    src = df.where(F.col(col).isNotNull()) if dropna else df
    return src.groupBy(*by, col).agg(F.count(F.lit(1)).alias(alias))


def top_n(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """F-1/F-2/F-3: deterministic top-N (TakeOrderedAndProject: each task
    keeps its own top N, the driver merges N x tasks rows)."""
    return df.orderBy(*order).limit(n)


def share_pivot(df: DataFrame, col: str, group: str, groups: Sequence[str],
                aliases: Sequence[str]) -> DataFrame:
    """% of each group's rows per value of ``col``, outer-aligned, 0-filled."""
    counts = df.groupBy(col).pivot(group, list(groups)).agg(F.count(F.lit(1)))
    totals = df.groupBy().pivot(group, list(groups)).agg(F.count(F.lit(1)))
    tot = totals.select(*[F.col(f"`{g}`").alias(f"__tot_{i}") for i, g in enumerate(groups)])
    j = counts.crossJoin(F.broadcast(tot))   # one-row side: always one row
    return j.select(col, *[
        F.bround(F.coalesce(F.col(f"`{g}`"), F.lit(0)) * 100.0 / F.col(f"__tot_{i}"), 4).alias(a)
        for i, (g, a) in enumerate(zip(groups, aliases))])


def missingness(df: DataFrame, columns: Sequence[str], by: str = "Status") -> DataFrame:
    """D3: null count and % per column per group; only columns with nulls."""
    wide = df.groupBy(by).agg(F.count(F.lit(1)).alias("__n"),
                              *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = wide.unpivot([by, "__n"], list(columns), "column", "n_null")
    return long.where(F.col("n_null") > 0).select(
        by, "column", "n_null", F.bround(F.col("n_null") * 100.0 / F.col("__n"), 4).alias("pct_null"))


def fill_rate(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """M4: filled rows and % per column (one pass)."""
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(c).alias(c) for c in columns])
    long = wide.unpivot(["__n"], list(columns), "column", "n_filled")
    return long.select("column", "n_filled", F.col("__n").alias("n_rows"),
                       F.bround(F.col("n_filled") * 100.0 / F.col("__n"), 4).alias("pct_filled"))


def duplicate_counts(df: DataFrame, key: str, by: str = "Status") -> DataFrame:
    """Rows, distinct keys and duplicate rows per group and overall."""
    g = df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"),
                           F.count_distinct(key).alias("n_ids"))
    allg = df.agg(F.lit("ALL").alias(by), F.count(F.lit(1)).alias("n_rows"),
                  F.count_distinct(key).alias("n_ids"))
    u = g.unionByName(allg)
    return u.withColumn("n_duplicates", F.col("n_rows") - F.col("n_ids"))


def duplicated_rows(df: DataFrame, key: str) -> DataFrame:
    """All rows whose key occurs more than once.

    Counting is an aggregate with map-side combine; the (bounded-by-keys)
    duplicate-key list is then semi-joined back, so a hot key never has to
    be buffered by a window.
    """
    dup_keys = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(key)
    return df.join(dup_keys, key, "left_semi")


def describe(df: DataFrame, col: str, by: Sequence[str], pcts: dict[str, float]) -> DataFrame:
    """Count, mean, std (sample), min, exact percentiles, max per group."""
    basic = df.groupBy(*by).agg(F.count(col).alias("count"), F.avg(col).alias("mean"),
                                F.stddev_samp(col).alias("std"), F.min(col).alias("min"),
                                F.max(col).alias("max"))
    q = exact_percentiles(df, by, col, pcts)
    return basic.join(q, list(by), "left")


def histogram(df: DataFrame, col: str, by: str, bins: int, log1p: bool = False) -> DataFrame:
    """Shared equal-width bins over all groups (edges from one min/max
    aggregate, joined as a one-row broadcast), counts per (group, bin)."""
    x = F.log1p(F.col(col)) if log1p else F.col(col)
    src = df.select(by, x.alias("__x")).where(F.col("__x").isNotNull())
    edges = src.agg(F.min("__x").alias("__lo"), F.max("__x").alias("__hi"))
    j = src.crossJoin(F.broadcast(edges))   # one-row side: always one row
    w = (F.col("__hi") - F.col("__lo")) / bins
    b = F.when(F.col("__hi") == F.col("__lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("__x") - F.col("__lo")) / w), F.lit(bins - 1))).cast("int")
    return j.withColumn("bin", b).groupBy(by, "bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.first(F.col("__lo") + F.col("bin") * w).alias("bin_lo"),
        F.first(F.col("__lo") + (F.col("bin") + 1) * w).alias("bin_hi"))


def boxplot(df: DataFrame, value: str, by: str) -> DataFrame:
    """Quartiles per category + whiskers (extreme values inside 1.5 IQR)."""
    q = exact_percentiles(df, [by], value, {"q1": 0.25, "median": 0.5, "q3": 0.75},
                          count_alias="n")
    iqr = F.col("q3") - F.col("q1")
    fences = q.select(by, (F.col("q1") - 1.5 * iqr).alias("__lof"),
                      (F.col("q3") + 1.5 * iqr).alias("__hif"))
    # fences: one row per category, written and size-checked before broadcast
    j = df.select(by, value).where(F.col(value).isNotNull()).join(broadcast_checked(fences), by)
    wh = j.groupBy(by).agg(
        F.min(F.when(F.col(value) >= F.col("__lof"), F.col(value))).alias("whisker_lo"),
        F.max(F.when(F.col(value) <= F.col("__hif"), F.col(value))).alias("whisker_hi"),
        F.count_if((F.col(value) < F.col("__lof")) | (F.col(value) > F.col("__hif")))
        .alias("n_outliers"))
    return q.join(wh, by)


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson r for every pair in one scan.

    Each row is expanded in-stage to one (pair, x, y) record per column
    pair and a single ``corr`` aggregate runs per pair (``corr`` skips rows
    where either side is null).  The partial aggregate leaves one row per
    pair per task, so the shuffle is tiny and the generated code stays
    small however many pairs there are.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    recs = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                              F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"))
                     for a, b in pairs])
    long = df.select(F.explode(recs).alias("r")).select("r.*")
    return long.groupBy("col_a", "col_b").agg(F.corr("x", "y").alias("r"))


def hash_sample(df: DataFrame, n: int, key: str, seed: int = 42, oversample: float = 4.0) -> DataFrame:
    """F-6: deterministic pseudo-random sample of at most n rows: the n rows
    with the smallest ``xxhash64(key, seed)`` (independent of partitioning).

    A plain ``orderBy(hash).limit(n)`` sends n rows from every task to one
    task.  Here rows are first kept only if their hash falls in the lowest
    ``oversample * n / N`` share of the hash range (a map-side filter); the
    final top-n runs on ~oversample x n rows.  The filter keeps *every* row
    below the threshold, so whenever it passes >= n rows the result equals
    the unfiltered top-n; otherwise the threshold is widened.
    """
    h = F.xxhash64(F.col(key), F.lit(seed))
    total = df.count()
    if total <= n:
        return df.orderBy(h, F.col(key))
    frac = min(1.0, oversample * n / total)
    while True:
        # xxhash64 is uniform over [-2^63, 2^63): threshold on that range
        thr = -9.223372036854776e18 + frac * 1.8446744073709552e19
        cand = df.where(h.cast("double") < F.lit(thr)) if frac < 1.0 else df
        if frac >= 1.0 or cand.count() >= n:
            return cand.orderBy(h, F.col(key)).limit(n)
        frac = min(1.0, frac * 4)


def column_percentiles(df: DataFrame, columns: Sequence[str], qs: dict[str, float],
                       by: Sequence[str] = ()) -> DataFrame:
    return multi_column_percentiles(df, by, columns, qs)
