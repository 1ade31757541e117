"""Exact, skew-safe order statistics as plain DataFrame jobs.

Spark's ``percentile``/``median`` aggregates merge every distinct value of a
group inside one task, which for a hot group (one suburb, one feature, the
whole table) is an unbounded hash map.  Here groups are told apart by size:

* a group of at most ``small`` rows is gathered and sorted by itself;
* in a larger group the target ranks are *selected*: a round counts the rows
  of each cell of the value axis exactly and sketches the cells' quantiles
  (both combined before the shuffle); the cells that hold a target rank are cut
  to the sketch's neighbourhood of it, and the next round counts again.  As
  counts are exact, a sketch that errs costs a round, never a wrong answer.
  Cells of at most ``small`` rows are gathered at last; edges are cells of
  their own, so a value that fills half a group needs no gathering at all.

Nothing the size of the input is written or sorted: only a row per large group
and cell, and the few values around the targets.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelens.operators.common import broadcast_checked, materialize

#: Rows of a group, or of a cell of a group, that one task may gather.
SMALL = 65_536
#: Quantiles sketched per cell and round.
GRID = 200


def _total(cols: Sequence[Column]) -> Column:
    return reduce(lambda x, y: x + y, cols)


def running_totals(df: DataFrame, keys: Sequence[str], order: str,
                   weights: Sequence[str], buckets: int = 256) -> DataFrame:
    """Inclusive running sums of ``weights`` in ``order`` within ``keys``.

    ``df`` must already hold one row per (keys, order) value (pre-aggregate
    first).  Returns df + ``cum_<w>`` columns.  The ordering work is split
    into ``buckets`` ranges of about as many values per group, so one hot group
    is spread over many tasks, whatever its outliers.
    """
    keys = list(keys)
    cuts = df.groupBy(*keys).agg(F.percentile_approx(
        order, [i / buckets for i in range(1, buckets)], 4 * buckets).alias("__cuts"))
    banded = df.join(cuts, keys, "inner").withColumn(
        "__sb", F.size(F.filter("__cuts", lambda c: c < F.col(order)))).drop("__cuts")
    totals = banded.groupBy(*keys, "__sb").agg(*[F.sum(w).alias(f"__tot_{w}") for w in weights])
    wb = Window.partitionBy(*keys).orderBy("__sb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "__sb", *[F.coalesce(F.sum(f"__tot_{w}").over(wb), F.lit(0))
                                             .alias(f"__off_{w}") for w in weights])
    wr = (Window.partitionBy(*keys, "__sb").orderBy(order)
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = banded.select("*", *[F.sum(w).over(wr).alias(f"__loc_{w}") for w in weights])
    out = local.join(offsets, keys + ["__sb"], "inner")
    return out.select(*df.columns, *[(F.col(f"__off_{w}") + F.col(f"__loc_{w}")).alias(f"cum_{w}")
                                     for w in weights])


def _height(q: float) -> Column:
    """Place of quantile ``q`` between the 0-based ranks of ``__n`` rows."""
    return (F.col("__n") - 1) * F.lit(float(q))


def _ranks(q: float) -> tuple[Column, Column]:
    low = F.floor(_height(q))
    return low, F.least(low + 1, F.col("__n") - 1)


def _between(lo: Column, hi: Column, q: float) -> Column:
    return F.when(lo == hi, lo).otherwise(lo + (_height(q) - F.floor(_height(q))) * (hi - lo))


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str,
                      qs: dict[str, float], count_alias: str | None = None,
                      small: int = SMALL, grid: int = GRID) -> DataFrame:
    """Exact linear-interpolated percentiles per group; null and NaN values and
    rows with a null key are ignored.

    Returns one row per group with values: keys + one column per ``qs`` entry
    (+ the group's count when ``count_alias``).
    """
    keys = list(keys)
    base = df.select(*keys, F.col(value).cast("double").alias("__v")).where(
        F.col("__v").isNotNull() & ~F.isnan("__v")).na.drop(subset=keys)
    counted = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    large = materialize(counted.where(F.col("__n") > small), "pct-large")
    tail = [F.col("__n").alias(count_alias)] if count_alias else []
    if large.isEmpty():
        return _gathered(base, keys, qs, tail)
    large = broadcast_checked(large, materialized=True)
    few = base.join(large.select(*keys), keys, "left_anti")
    return _gathered(few, keys, qs, tail).unionByName(_selected(base, large, keys, qs, tail, small, grid))


def _gathered(base: DataFrame, keys: list[str], qs: dict[str, float], tail: list[Column]) -> DataFrame:
    """Groups of a bounded number of rows: each sorted by itself."""
    g = base.groupBy(*keys).agg(F.sort_array(F.collect_list("__v")).alias("__s")) \
        .withColumn("__n", F.size("__s").cast("long"))
    outs = []
    for name, q in qs.items():
        lo, hi = (F.element_at("__s", (r + 1).cast("int")) for r in _ranks(q))
        outs.append(_between(lo, hi, q).alias(name))
    return g.select(*keys, *outs, *tail)


def _selected(base: DataFrame, large: DataFrame, keys: list[str], qs: dict[str, float],
              tail: list[Column], small: int, grid: int) -> DataFrame:
    """Groups of any size (``large``: keys and ``__n``): cells cut round by round towards the targets."""
    ranks = [_ranks(q) for q in qs.values()]
    edges = [f"__{side}{i}" for i in range(len(ranks)) for side in "ab"]
    state = large.select(*keys, "__n", *[F.lit(float("-inf") if e[2] == "a" else float("inf")).alias(e)
                                         for e in edges])
    v = F.col("__v")
    cell = _total([(F.col(e) < v).cast("int") + (F.col(e) <= v).cast("int") for e in edges]).alias("__cell")
    order = Window.partitionBy(*keys).orderBy("__cell")
    steps = [i / grid for i in range(grid + 1)]

    def holds(rank: Column) -> Column:
        return (F.col("__from") <= rank) & (rank < F.col("__from") + F.col("__c"))

    def near(rank: Column, by: int) -> Column:
        at = F.floor((rank - F.col("__from")) / F.col("__c") * grid) + by
        return F.when(at <= 0, F.col("__min")).when(at >= grid, F.col("__max")) \
            .otherwise(F.element_at("__steps", (at + 1).cast("int")))

    wanted = reduce(lambda x, y: x | y, [holds(r) for pair in ranks for r in pair])
    while True:
        placed = base.join(state, keys).select(*keys, "__v", cell)
        cells = placed.groupBy(*keys, "__cell").agg(
            F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__min"), F.max("__v").alias("__max"),
            F.percentile_approx("__v", steps, 5 * grid).alias("__steps")) \
            .withColumn("__from", F.sum("__c").over(order) - F.col("__c")) \
            .join(state.select(*keys, "__n"), keys)
        cells = materialize(cells.where(wanted), "pct-cells")
        spread = cells.where(F.col("__min") < F.col("__max"))
        if spread.where(F.col("__c") > small).isEmpty():
            break
        cuts = []
        for i, (lo, hi) in enumerate(ranks):
            cuts += [F.max(F.when(holds(lo), near(lo, -1))).alias(f"__a{i}"),
                     F.max(F.when(holds(hi), near(hi, 2))).alias(f"__b{i}")]
        state = broadcast_checked(cells.groupBy(*keys, "__n").agg(*cuts))
    gathered = placed.join(broadcast_checked(spread.select(*keys, "__cell")), keys + ["__cell"], "left_semi") \
        .groupBy(*keys, "__cell").agg(F.sort_array(F.collect_list("__v")).alias("__s"))
    held = cells.drop("__steps").join(gathered, keys + ["__cell"], "left")

    def at(rank: Column) -> Column:
        return F.max(F.when(holds(rank), F.coalesce(
            F.get("__s", (rank - F.col("__from")).cast("int")), F.col("__min"))))

    picks = []
    for i, (lo, hi) in enumerate(ranks):
        picks += [at(lo).alias(f"__lo{i}"), at(hi).alias(f"__hi{i}")]
    g = held.groupBy(*keys, "__n").agg(*picks)
    return g.select(*keys, *[_between(F.col(f"__lo{i}"), F.col(f"__hi{i}"), q).alias(name)
                             for i, (name, q) in enumerate(qs.items())], *tail)


def exact_median(df: DataFrame, keys: Sequence[str], value: str, alias: str = "median",
                 count_alias: str | None = None) -> DataFrame:
    return exact_percentiles(df, keys, value, {alias: 0.5}, count_alias)


def multi_column_percentiles(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                             qs: dict[str, float]) -> DataFrame:
    """Percentiles of several columns per group in one job (long format).

    Columns are stacked with ``unpivot`` to (keys, column, value) so each
    column becomes its own group inside the same shuffles.
    """
    long = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]) \
        .unpivot(list(keys), list(columns), "column", "value")
    return exact_percentiles(long, list(keys) + ["column"], "value", qs)
