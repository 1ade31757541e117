"""SimHash near-duplicates found with Golay-code fuzzy keys.

* Fingerprint: 64 bits of the majority over all k-word shingles (XXH64, seed 42).
* A fingerprint is cut into three segments of 21, 21 and 22 bits.  If two
  fingerprints differ in at most four bits, the segment with most errors holds
  at least a third of them, so the two others hold at most two errors together.
* A segment, as a 23-bit word of the perfect binary Golay code, gets the numbers
  of all codewords within distance four (one or six of them).  Any two words at
  distance two or less have a word between them that lies within three of some
  codeword, so that codeword is within four of both: they share a key.
* Each pair of segments gives the products of the two key sets.  Fingerprints
  that share a key meet, and are linked if they really differ in four bits or less.

Only distinct fingerprints are joined, so a group of exact copies is one row.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.llm import common, words

SEED = 42
#: Generator of the binary Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
SEGMENTS = ((0, 21), (21, 21), (42, 22))
_CHUNK = 1 << 16
_LOWER = bytes(words.LOWER)


def _bit_counts(hashes: list[int]) -> np.ndarray:
    raw = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes, k: int = 4) -> int:
    """The fingerprint of one whole text, A-Z lower-cased; a text without words has 0."""
    import xxhash
    one = xxhash.xxh64_intdigest
    line = b" ".join(text.translate(_LOWER).split())
    if not line:
        return 0
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(line)]))
    if len(starts) > k:
        starts, ends = starts[:len(starts) - k + 1], ends[k - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    counts = np.zeros(64, np.int64)
    for i in range(0, len(starts), _CHUNK):
        counts += _bit_counts([one(line[a:b], SEED) for a, b in
                               zip(starts[i:i + _CHUNK].tolist(), ends[i:i + _CHUNK].tolist())])
    bits = counts * 2 > len(starts)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", k: int = 4, out: str = "fp") -> DataFrame:
    """``docs`` without its text and with the fingerprint as a signed long in ``out``."""
    common.ship_package(docs.sparkSession)
    kept = [c for c in docs.columns if c != text]
    schema = docs.select(*kept, F.lit(0).cast("long").alias(out)).schema

    def run(batches):
        for part in common.slices(batches, text):
            buf, off = common.text_buffer(common.column_of(part, text))
            raw = buf.tobytes()
            fps = np.array([fingerprint(raw[a:b], k) for a, b in zip(off[:-1].tolist(), off[1:].tolist())], np.uint64)
            rest = [common.column_of(part, c) for c in kept]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(fps.view(np.int64))], names=[*kept, out])

    return docs.select(*kept, text).mapInArrow(run, schema)


# --------------------------------------------------------------------- Golay keys

def _syndromes(x: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words divided by the generator."""
    x = x.copy()
    for shift in range(11, -1, -1):
        x ^= np.where((x >> (shift + 11)) & 1, GENERATOR << shift, 0)
    return x


def _error_table() -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome the error words of weight four or less: (table padded to six, their number)."""
    errors = np.array([sum(1 << b for b in bits) for weight in range(5)
                       for bits in itertools.combinations(range(23), weight)], np.int64)
    s = _syndromes(errors)
    order = np.argsort(s, kind="stable")
    first = np.searchsorted(s[order], np.arange(2049))
    number = np.diff(first)
    table = np.zeros((2048, int(number.max())), np.int64)
    for j in range(table.shape[1]):
        has = number > j
        table[has, j] = errors[order[first[:-1][has] + j]]
    return table, number


_golay: list = []


def golay_keys(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, codeword number) for every codeword within distance four of each 23-bit word."""
    if not _golay:
        _golay.extend(_error_table())
    table, number = _golay
    s = _syndromes(x)
    rows = np.repeat(np.arange(len(x)), number[s])
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(number[s]) - number[s], number[s])
    return rows, (x[rows] ^ table[s[rows], nth]) >> 11  # the code is cyclic: twelve high bits tell its words apart


def pair_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): for each pair of segments the products of their codeword numbers."""
    u = fps.view(np.uint64)
    keys = []
    for at, width in SEGMENTS:
        part = ((u >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64)
        keys.append(golay_keys(part))
    rows_out, keys_out = [], []
    for pair, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        (r1, k1), (r2, k2) = keys[i], keys[j]
        first = np.searchsorted(r2, np.arange(len(fps) + 1))
        number = np.diff(first)[r1]
        left = np.repeat(np.arange(len(r1)), number)
        nth = np.arange(len(left)) - np.repeat(np.cumsum(number) - number, number)
        right = first[r1[left]] + nth
        rows_out.append(r1[left])
        keys_out.append((pair << 24) | (k1[left] << 12) | k2[right])
    return np.concatenate(rows_out), np.concatenate(keys_out)


def _emit_keys(batches):
    for batch in batches:
        fps = np.array(common.column_of(batch, "fp").to_numpy(zero_copy_only=False), np.int64)
        for i in range(0, len(fps), 1 << 13):
            part = fps[i:i + (1 << 13)]
            rows, keys = pair_keys(part)
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int32)), pa.array(part[rows])], names=["key", "fp"])


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is connected among ``fps``: fewer links than fingerprints."""
    left, found = np.arange(len(fps)), []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            u = queue.pop()
            near = np.bitwise_count(fps[left] ^ fps[u]) <= max_bits
            hit, left = left[near], left[~near]
            if len(hit):
                found.append((np.full(len(hit), u), hit))
                queue.extend(hit.tolist())
    return found


def _link_runs(max_bits: int):
    """Links within each run of rows with one key; rows come sorted by key."""
    def linked(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        size = np.diff(np.concatenate((at, [len(keys)])))
        two = at[size == 2]
        two = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= max_bits]
        left, right = [two], [two + 1]
        for i, n in zip(at[size > 2].tolist(), size[size > 2].tolist()):
            for u, v in _forest(fps[i:i + n], max_bits):
                left.append(i + u)
                right.append(i + v)
        a, b = fps.view(np.int64)[np.concatenate(left)], fps.view(np.int64)[np.concatenate(right)]
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    def run(batches):
        keys, fps = np.zeros(0, np.int32), np.zeros(0, np.uint64)
        for batch in batches:
            keys = np.concatenate((keys, common.column_of(batch, "key").to_numpy()))
            fps = np.concatenate((fps, common.column_of(batch, "fp").to_numpy().view(np.uint64)))
            whole = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last key may go on
            if whole:
                yield linked(keys[:whole], fps[:whole])
                keys, fps = keys[whole:], fps[whole:]
        if len(keys):
            yield linked(keys, fps)

    return run


def links(distinct: DataFrame, max_bits: int = 4) -> DataFrame:
    """(a, b): pairs of distinct fingerprints ``fp`` with at most ``max_bits`` (0 to 4) differing bits.

    Fingerprints meet under their shared keys.  Within a key only as many
    links are made as connect its fingerprints, never all pairs; every pair
    within ``max_bits`` shares a key, so what they connect is the same."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the segment keys hold for up to four differing bits")
    keyed = distinct.select("fp").mapInArrow(_emit_keys, "key int, fp long")
    dealt = keyed.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_link_runs(max_bits), "a long, b long").distinct()


def rooted(fps: DataFrame, id_col: str, max_bits: int) -> DataFrame:
    """(fp, low, root): the distinct fingerprints of ``fps``, the smallest id of each and the least fingerprint linked with it."""
    groups = common.written(fps.groupBy("fp").agg(F.min(id_col).alias("low")), "simhash-groups")
    roots = common.components(links(groups, max_bits), "simhash-cc")
    return groups.join(roots, groups["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                    k: int = 4, max_bits: int = 4) -> DataFrame:
    """(id, fp, component_id) for every row.

    ``component_id`` is the smallest id that links of fingerprints reach.
    Null text counts as empty (fingerprint 0); a null id never is the smallest
    unless a component has no other."""
    fps = common.written(fingerprints(docs.select(id_col, text), text, k), "simhash-fp")
    named = rooted(fps, id_col, max_bits)
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    labels = named.join(lowest, "root").select("fp", "component_id")
    return fps.join(labels, "fp").select(id_col, "fp", "component_id")


def keep_representatives(docs: DataFrame, k: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one row of each group: one with the group's least id (null last).

    Of several such rows the first by text stays; null and repeated ids cost no group its row.  Extra columns
    keep their values whatever their names; an empty table stays empty."""
    marked = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in ("doc_id", "text")]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    # one key only for one id and text, so for one group
    keyed = docs.select(row, "doc_id", "text", F.unhex(F.md5(F.concat_ws("\x00", *marked))).alias("__key"))
    fps = common.written(fingerprints(keyed.select("doc_id", "__key", "text"), "text", k), "simhash-fp")
    named = rooted(fps, "doc_id", max_bits)
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    first = fps.join(named.join(lowest, "root").select("fp", "root", "component_id"), "fp")
    first = first.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("__key", "root").agg(F.count("*").alias("n"))
    first = common.written(first, "simhash-first")
    tied = first.groupBy("root").agg(F.sum("n").alias("n")).where("n > 1").select("root")
    once = keyed.join(first.join(tied, "root", "left_anti").select("__key"), "__key", "left_semi").select("__row.*")
    several = keyed.join(first.join(tied, "root", "left_semi").select("__key", F.col("root").alias("__root")), "__key")
    several = (several.groupBy("__root").agg(F.min_by("__row", F.struct("text", F.xxhash64("__row"))).alias("__row"))
               .select("__row.*"))
    return once.unionByName(several)


def op4(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = near_duplicates(docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
