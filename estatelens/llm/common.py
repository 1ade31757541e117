"""Shared pieces of the training-data operators: shared-folder tables, Arrow
text slices, block tables and a distributed connected-components job."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step holds (a longer document is a slice of its own).
SLICE_BYTES = 4 << 20

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (once per application)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    target = os.path.join(tempfile.mkdtemp(prefix="estatelens-zip-"), "estatelens_llm.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in [root / "estatelens" / "__init__.py", *(root / "estatelens" / "llm").glob("*.py")]:
            if f.exists():
                z.write(f, f.relative_to(root))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``).

    Only a local session may fall back to a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="estatelens-llm-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, it survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`written` once nothing reads it again."""
    spark = df.sparkSession
    files = df.inputFiles()
    if files:
        path = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        if "/llm-" in path.toString():
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_held: dict = {}


def held(key, make):
    """What ``make`` returns, remembered by this worker until it is asked for another key.

    A worker that goes on to another stage so lets go of the last stage's large tables."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n+1 offsets of an Arrow string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def give_back() -> None:
    """Return memory that this worker has freed, and the allocators still keep, to the machine.

    Spark keeps idle workers for the next stage; without this they hold their highest use."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of at most ``size`` bytes of text; frees memory at the end."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = text_buffer(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(off, off[at] + size, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to
    batch = None
    give_back()


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


# ------------------------------------------------------------------ block tables

def _to_blocks(batches):
    """Rows of (id, text) as blocks: ids, byte lengths and zstd-packed bytes."""
    import zstandard
    packer = zstandard.ZstdCompressor(level=3)
    for part in slices(batches):
        buf, off = text_buffer(column_of(part, "text"))
        ids = column_of(part, "id")
        yield pa.RecordBatch.from_arrays([
            pa.array([uuid.uuid4().hex]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            pa.array([np.diff(off).astype("<i8").tobytes()], pa.binary()), pa.array([packer.compress(buf.tobytes())], pa.binary())],
            names=["block", "ids", "sizes", "body"])


def unpack_block(sizes: bytes, body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of one block."""
    import zstandard
    off = np.concatenate(([0], np.cumsum(np.frombuffer(sizes, "<i8"))))
    raw = zstandard.ZstdDecompressor().decompress(body, max_output_size=max(1, int(off[-1])))
    return np.frombuffer(raw, np.uint8), off


def blocks_in(batches) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    """(row, bytes, offsets) of every block in Arrow batches of a block table."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: column_of(batch, c)[i] for c in batch.schema.names}
            yield row, *unpack_block(row["sizes"].as_py(), row["body"].as_py())


def block_table(docs: DataFrame, id_col: str, text: str, name: str) -> DataFrame:
    """Write the documents as a table of packed blocks (block, ids, sizes, body).

    A block's name is fixed by the written table, so later jobs can send
    results back to it however tasks are retried.  Null text is empty."""
    spark = docs.sparkSession
    ship_package(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(
        _to_blocks, f"block string, ids array<{kind}>, sizes binary, body binary")
    path = new_path(spark, name)
    out.write.option("compression", "none").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def shard_count(blocks: DataFrame) -> int:
    """Shards of hash space: their number follows the blocks, so a shard's share stays bounded."""
    return min(1 << 14, max(64, blocks.select("block").count() // 2))


def by_shard(hashes: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, bounds): rows sorted by shard (stable), and where each shard begins."""
    shard = ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(shards + 1))


# ------------------------------------------------------------- connected components

def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) reaches.

    Alternating star contraction: each round links every node's larger (then
    smaller) neighbours to the smallest one near it.  A hub with very many
    neighbours shrinks to one row per neighbour, ``min`` is combined before
    the shuffle, and each round is a written table."""
    both = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .where("a <> b").distinct(), name)
    while True:
        # large star: neighbours above u go to the smallest of u and its neighbours
        two_way = both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = two_way.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (two_way.join(low, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        # small star: neighbours below u, and u itself, go to the smallest of them
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(down.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        after = written(small, name)
        same = (after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
                == both.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        drop_written(both)
        both = after
        if same:
            return both.select(F.col("a").alias("node"), F.col("b").alias("root"))
