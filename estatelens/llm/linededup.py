"""Line dedup through a sharded minimal perfect hash.

Documents are packed into blocks.  Each block sends its distinct line hashes,
with the number of its documents that hold each, to the hash's shard.  A shard
numbers its distinct hashes by a minimal perfect hash and keeps two compact
arrays in that order: a fingerprint and a document count.  Hash and fingerprint
are the two halves of a line's 128-bit XXH3, so that lines are told apart by 128
bits and a line that meets another's hash is still a key of its own.  The shards are a
written table.  Blocks then probe the arrays with their own hashes, get back the
few lines that are too frequent, and drop them; lines themselves never move.

A line met in very many documents is one entry per block.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.llm import common, words

MIN_DOCS = 10
GAMMA = 1.5


# -------------------------------------------------------------------- perfect hash

#: A line's key: its hash, which decides shard and order, and its fingerprint.
KEY = np.dtype([("hash", "<u8"), ("print", "<u8")])


def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64((level + 1) * 0xA24BAED4963EE407 % (1 << 64))
    if keys.dtype != KEY:
        return (words.mixed(keys + salt) % np.uint64(size)).astype(np.int64)
    return (words.mixed(words.mixed(keys["hash"] + salt) ^ (keys["print"] * (salt | np.uint64(1)))) % np.uint64(size)).astype(np.int64)


def build_index(keys: np.ndarray) -> list[np.ndarray]:
    """Levels of bits for distinct keys (``KEY`` rows or plain 64-bit hashes): a key that is alone in its slot of a level has its bit there, the others go on."""
    levels = []
    while len(keys):
        size = max(64, int(len(keys) * GAMMA))
        slot = _slot(keys, len(levels), size)
        alone = np.bincount(slot, minlength=size)[slot] == 1
        bits = np.zeros(size, bool)
        bits[slot[alone]] = True
        levels.append(bits)
        keys = keys[~alone]
    return levels


def probe_index(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Number of each key, -1 where no level has a bit for it.  Ranks are built once a call: probe all keys of a shard at once."""
    out = np.full(len(keys), -1, np.int64)
    open_, before = np.arange(len(keys)), 0
    for level, bits in enumerate(levels):
        slot = _slot(keys[open_], level, len(bits))
        rank = np.cumsum(bits)
        here = bits[slot]
        out[open_[here]] = before + rank[slot[here]] - 1
        open_, before = open_[~here], before + int(rank[-1])
    return out


def pack_levels(levels: list[np.ndarray]) -> bytes:
    return struct.pack("<I", len(levels)) + b"".join(struct.pack("<Q", len(x)) + np.packbits(x).tobytes() for x in levels)


def unpack_levels(raw: bytes) -> list[np.ndarray]:
    (n,), at, out = struct.unpack_from("<I", raw), 4, []
    for _ in range(n):
        (size,) = struct.unpack_from("<Q", raw, at)
        packed = np.frombuffer(raw, np.uint8, -(-size // 8), at + 8)
        out.append(np.unpackbits(packed, count=size).astype(bool))
        at += 8 + len(packed)
    return out


# --------------------------------------------------------------------------- lines

def line_keys(buf: np.ndarray, off: np.ndarray):
    """(starts, ends, first line of each document plus the total, keys, has a key) of all lines."""
    breaks = np.flatnonzero(buf == 10)
    number = np.searchsorted(breaks, off[1:]) - np.searchsorted(breaks, off[:-1]) + 1
    first = np.concatenate(([0], np.cumsum(number)))
    starts = np.empty(first[-1], np.int64)
    ends = np.empty(first[-1], np.int64)
    is_first = np.zeros(first[-1], bool)
    is_first[first[:-1]] = True
    is_last = np.zeros(first[-1], bool)
    is_last[first[1:] - 1] = True
    starts[is_first], starts[~is_first] = off[:-1], breaks + 1
    ends[is_last], ends[~is_last] = off[1:], breaks
    solid = np.flatnonzero(words.SOLID[buf])
    i, j = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    has = j > i
    keys = np.zeros(len(starts), KEY)
    if has.any():
        lower = words.LOWER[buf].tobytes()
        digest = xxhash.xxh3_128_digest
        raw = b"".join([digest(lower[x:y]) for x, y in zip(solid[i[has]].tolist(), (solid[j[has] - 1] + 1).tolist())])
        keys[has] = np.frombuffer(raw, KEY)
    return starts, ends, first, keys, has


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in order of hash and fingerprint, number of each row's key)."""
    order = np.lexsort((keys["print"], keys["hash"]))
    h, p = keys["hash"][order], keys["print"][order]
    new = np.ones(len(keys), bool)
    new[1:] = (h[1:] != h[:-1]) | (p[1:] != p[:-1])
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return keys[order[new]], number


def _send(shards: int):
    def run(batches):
        for row, buf, off in common.blocks_in(batches):
            _, _, first, lines, has = line_keys(buf, off)
            doc = np.repeat(np.arange(len(off) - 1), np.diff(first))[has]
            keys, number = _distinct(lines[has])
            order = np.lexsort((doc, number))
            number, doc = number[order], doc[order]
            new = np.ones(len(number), bool)
            new[1:] = (number[1:] != number[:-1]) | (doc[1:] != doc[:-1])
            counts = np.bincount(number[new], minlength=len(keys))
            order, at = common.by_shard(keys["hash"], shards)
            used = np.flatnonzero(np.diff(at))
            if len(used):
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array(used.astype(np.int32)), "block": pa.array([row["block"].as_py()] * len(used)),
                    "keys": pa.array([keys[order[at[s]:at[s + 1]]].tobytes() for s in used], pa.binary()),
                    "counts": pa.array([counts[order[at[s]:at[s + 1]]].astype("<u4").tobytes() for s in used], pa.binary())})

    return run


def _joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def _build(key, table):
    n = _joined(table["counts"], "<u4")
    keys, at = _distinct(_joined(table["keys"], KEY))
    counts = np.bincount(at, weights=n).astype("<u8")
    levels = build_index(keys)
    place = probe_index(levels, keys)
    prints, kept = np.empty(len(keys), "<u8"), np.empty(len(keys), "<u8")
    prints[place], kept[place] = keys["print"], counts
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "levels": pa.array([pack_levels(levels)], pa.binary()),
                     "prints": pa.array([prints.tobytes()], pa.binary()), "docs": pa.array([kept.tobytes()], pa.binary())})


def line_index(blocks: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """(what blocks sent, one row per shard: levels of the perfect hash, fingerprints, document counts), both written."""
    sent = common.written(blocks.mapInArrow(_send(shards), "shard int, block string, keys binary, counts binary"), "line-keys")
    index = sent.groupBy("shard").applyInArrow(_build, "shard int, levels binary, prints binary, docs binary")
    return sent, common.written(index, "line-index")


def _probe(min_docs: int):
    def run(left, right):
        blocks, found = [], []
        if left.num_rows and right.num_rows:
            levels = unpack_levels(right["levels"][0].as_py())
            prints = np.frombuffer(right["prints"][0].as_py(), "<u8")
            docs = np.frombuffer(right["docs"][0].as_py(), "<u8")
            sent = left["keys"].to_pylist()
            ends = np.cumsum([len(x) // KEY.itemsize for x in sent])
            keys = np.frombuffer(b"".join(sent), KEY)
            place = probe_index(levels, keys)
            often = (place >= 0) & (prints[place] == keys["print"]) & (docs[place] >= min_docs)
            for block, some in zip(left["block"].to_pylist(), np.split(np.arange(len(keys)), ends[:-1])):
                some = some[often[some]]
                if len(some):
                    blocks.append(block)
                    found.append(keys[some].tobytes())
        return pa.table({"block": pa.array(blocks, pa.string()), "often": pa.array(found, pa.binary())})

    return run


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS,
                  with_text: bool = False) -> DataFrame:
    """Per row: id, n_lines, n_dropped, kept_sha256 (and the text that is left).

    A line's key is the line without white space at its ends and with A-Z
    lower-cased; keys in ``min_docs`` or more rows lose their lines everywhere.
    Empty keys never do.  Null or empty text is one empty line; rows that repeat
    an id are documents of their own."""
    blocks = common.block_table(docs, id_col, text, "line-blocks")
    shards = common.shard_count(blocks)
    sent, index = line_index(blocks, shards)
    often = sent.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(_probe(min_docs), "block string, often binary")
    often = common.written(often.groupBy("block").agg(F.collect_list("often").alias("often")), "line-often")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for row, buf, off in common.blocks_in(batches):
            starts, ends, first, lines, has = line_keys(buf, off)
            often = np.frombuffer(b"".join(row["often"].as_py() or []), KEY)
            _, number = _distinct(np.concatenate((lines, often)))
            gone = has & np.isin(number[:len(lines)], number[len(lines):])
            total = np.concatenate(([0], np.cumsum(gone)))
            n_gone = total[first[1:]] - total[first[:-1]]
            raw, kept = buf.tobytes(), []
            for d in range(len(off) - 1):
                if n_gone[d]:
                    stay = np.flatnonzero(~gone[first[d]:first[d + 1]]) + first[d]
                    kept.append(b"\n".join([raw[starts[k]:ends[k]] for k in stay]))
                else:
                    kept.append(raw[off[d]:off[d + 1]])
            columns = [row["ids"].values, pa.array(np.diff(first)), pa.array(n_gone),
                       pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())]
            names = [id_col, "n_lines", "n_dropped", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(kept, pa.binary()).cast(pa.string())], [*names, text]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{id_col}` {kind}, n_lines long, n_dropped long, kept_sha256 string" + f", `{text}` string" * with_text
    return blocks.join(often, "block", "left").mapInArrow(run, schema)


def op9(spark, sf_dir):
    return dropped_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_ENDS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
l AS (
  SELECT rid, i, line, translate(trim(line, {_ENDS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS i FROM d)
), often AS (
  SELECT k FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT rid) >= {MIN_DOCS}
), m AS (SELECT l.*, often.k IS NOT NULL AS gone FROM l LEFT JOIN often USING (k))
SELECT d.doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m JOIN d USING (rid) GROUP BY d.rid, d.doc_id
"""
