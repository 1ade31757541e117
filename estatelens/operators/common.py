"""Shared helpers: size-checked broadcast, lineage cuts, dedup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.session import scratch_dir

# A broadcast side above either bound goes through a shuffle join instead.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024      # written (compressed) size


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint
    folder and reading it back: computed once, survives executor loss, and
    later jobs start from the written files."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def written_bytes(df: DataFrame) -> int | None:
    """Total size of the files behind a file-scan DataFrame (None if unknown)."""
    try:
        files = df.inputFiles()
        jvm = df.sparkSession._jvm
        conf = df.sparkSession._jsc.hadoopConfiguration()
        total = 0
        for f in files:
            path = jvm.org.apache.hadoop.fs.Path(f)
            total += path.getFileSystem(conf).getFileStatus(path).getLen()
        return total
    except Exception:  # not a file scan / filesystem without sizes
        return None


def broadcast_checked(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      max_bytes: int = MAX_BROADCAST_BYTES,
                      materialized: bool = False) -> DataFrame:
    """Broadcast ``df`` only after proving it is small.

    The (small, fitted) table is written first so the checks and the later
    join reuse one computation; it is broadcast only when both its row
    count and its written size are under the bounds, otherwise the plain
    frame is returned and Spark plans a shuffle join.
    """
    m = df if materialized else materialize(df)
    n = m.count()
    size = written_bytes(m)
    small = n <= max_rows and size is not None and size <= max_bytes
    return F.broadcast(m) if small else m


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` struct.

    ``max_by`` is a partial/final aggregate, so every map task first keeps
    only its own best row per key: a key holding a third of the table is
    reduced before the shuffle instead of landing whole in one window task.
    """
    cols = [c for c in df.columns]
    rec = F.struct(*[F.col(c) for c in cols])
    best = df.groupBy(*keys).agg(F.max_by(rec, F.struct(*order)).alias("__best"))
    return best.select(*[F.col(f"__best.{c}").alias(c) for c in cols])


def desc_nulls_last(c) -> list[Column]:
    """Sort key parts making ``max`` behave as ORDER BY c DESC NULLS LAST."""
    c = F.col(c) if isinstance(c, str) else c
    return [c.isNotNull(), c]


def global_rank(df: DataFrame, order: Sequence[str], alias: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """0-based position of every row in the total order ``order`` (which must
    be unique per row), computed without a single-partition window.

    Rows are range-partitioned on the full order key (so one hot leading
    value is still split across tasks) and sorted inside each partition; a
    per-partition count gives each partition's offset; the position is the
    offset plus the row's index inside its partition.  The sorted table and the
    offsets are written out, so every consumer sees the same positions and none
    needs to write the ranked rows again.
    """
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = (df.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
         .withColumn("__pid", F.spark_partition_id())
         .withColumn("__mid", F.monotonically_increasing_id()))
    s = materialize(s, "rank-sorted")
    per = s.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"), F.min("__mid").alias("__min"))
    from pyspark.sql import Window
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    # ``per`` has one row per partition (bounded by the partition count).
    offs = materialize(per.select("__pid", "__min", F.coalesce(F.sum("__cnt").over(w), F.lit(0)).alias("__off")), "rank-offsets")
    out = s.join(F.broadcast(offs), "__pid")
    return out.withColumn(alias, F.col("__off") + F.col("__mid") - F.col("__min")) \
        .drop("__pid", "__mid", "__min", "__off")
