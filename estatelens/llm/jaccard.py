"""Word-shingle sets joined by Jaccard similarity through parity sketches.

* A set's sketch has one bit per possible shingle hash, dealt to ``s`` segments.  A
  shingle flips its own bit, so two sketches differ in no more bits than the sets
  differ in shingles.  A segment is not stored bit by bit: it is the XOR of a code
  of each of its bits.  A narrow sketch of 512 bits is kept beside it.
* Sizes fall into bands.  Sets that link differ in at most d shingles, d fixed by
  their sizes, so of a band's s > d segments at least s - d are the same.  Segments
  are ordered by their number of shingles (most first, then by code); the first
  common segment in that order is among the first d + 1 of both sets, which alone
  are its keys.  A pair meets in the band of its smaller set.
* Sets with one key meet, in rounds.  First each is paired with the least of its
  key; then, where a key's sets are not one component yet, with those that differ
  in no more bits of the narrow sketch than the sizes allow, a bounded number a
  round until none is left.  Every pair is verified on the shingles themselves, and
  pairs of one component are not looked at again.

Copies of a text are one class; only classes are joined.  No pair is dropped: a key
of many sets is dealt to blocks, and pairs of blocks are compared.

Null and empty texts, and texts without words, have no shingles and are alone.
Repeated ids and rows are rows of their own; a null id never is the smallest unless
a component has no other.  Extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelens.llm import common, words

SEED = 42
#: Least similarity, as a fraction, and words of a shingle.
SIMILAR, SHINGLE = (85, 100), 4
#: Bits of the narrow sketch.
NARROW = 512
#: Sets of a key that are compared at once, and partners a set gets in the first round of a block (eight times more in each further one).
BLOCK, PARTNERS = 1024, 64
_GROWTH = 13  # tenths by which a band's largest size grows
_LOWER = bytes(words.LOWER)


# -------------------------------------------------------------------- sizes and bands

def most_apart(total: int | np.ndarray, similar: tuple[int, int] = SIMILAR):
    """How many shingles two linked sets of ``total`` shingles together can differ in."""
    num, den = similar
    return total * (den - num) // (den + num)


@functools.cache
def bands(largest: int) -> np.ndarray:
    """The least size of each band up to size ``largest``, and of the band behind."""
    low = [1]
    while low[-1] <= largest:
        low.append(max(low[-1] + 1, low[-1] * _GROWTH // 10))
    return np.array(low, np.int64)


def segments(top: np.ndarray, similar: tuple[int, int] = SIMILAR) -> np.ndarray:
    """Segments of the band whose largest size is ``top``: a quarter more than can differ."""
    num, den = similar
    d = most_apart(top + top * den // num, similar)
    return np.where(d > 0, d + 1 + (d + 4) // 4, 1)


# ------------------------------------------------------------------- sets and sketches

def shingle_hashes(text: bytes, k: int) -> np.ndarray:
    """Distinct hashes of the k-word shingles of one whole text, ascending."""
    import xxhash
    one = xxhash.xxh64_intdigest
    line = b" ".join(text.translate(_LOWER).split())
    if not line:
        return np.zeros(0, np.uint64)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts, ends = np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(line)]))
    if len(starts) > k:
        starts, ends = starts[:len(starts) - k + 1], ends[k - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    found = np.fromiter((one(line[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))
    found.sort()
    return found[np.concatenate(([True], found[1:] != found[:-1]))]


def _keys_in_band(sets: np.ndarray, owner: np.ndarray, size: np.ndarray, band: np.ndarray, pick: np.ndarray, number: np.ndarray):
    """(set, key): for each set of ``pick`` its first ``number`` segments in the order of the join, in band ``band``.

    ``sets`` holds the hashes of all sets one after another, ``owner`` whose they are."""
    top = bands(int(size.max()))[band + 1] - 1
    s = segments(top)
    rank = np.full(len(size), -1, np.int64)
    rank[pick] = np.arange(len(pick))
    mine = rank[owner]
    h, mine = sets[mine >= 0], mine[mine >= 0]
    segment = ((h >> np.uint64(32)) * s[mine].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    first = np.concatenate(([0], np.cumsum(s)))
    cell = first[mine] + segment
    order = np.argsort(cell, kind="stable")
    cell, code = cell[order], words.mixed(h[order])
    fold, count = np.zeros(int(first[-1]), np.uint64), np.bincount(cell, minlength=int(first[-1]))
    at = np.flatnonzero(count)
    fold[at] = np.bitwise_xor.reduceat(code, np.cumsum(count[at]) - count[at])
    whose = np.repeat(np.arange(len(pick)), s)
    where = np.arange(int(first[-1])) - first[whose]
    order = np.lexsort((fold, -count, whose))
    kept = order[where < number[whose]]  # sorted by set: a place in the order is a place in the set's segments
    place = (band[whose[kept]] << 32) | where[kept]
    return pick[whose[kept]], words.mixed(fold[kept] ^ words.mixed(place.astype(np.uint64) + np.uint64(1)))


def keys_of(sets: list[np.ndarray], similar: tuple[int, int] = SIMILAR) -> tuple[np.ndarray, np.ndarray]:
    """(set, key) of non-empty sets of hashes; two sets with similarity ``similar`` or more share a key."""
    num, den = similar
    size = np.array([len(x) for x in sets], np.int64)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    low = bands(int(size.max()))
    own = np.searchsorted(low, size, "right") - 1
    out = [_keys_in_band(flat, owner, size, own, np.arange(len(sets)), most_apart(size + size * den // num, similar) + 1)]
    below = own - 1
    while True:  # bands of smaller partners
        pick = np.flatnonzero(below >= 0)
        top = low[below[pick] + 1] - 1
        pick, top = pick[top * den >= size[pick] * num], top[top * den >= size[pick] * num]
        if not len(pick):
            break
        out.append(_keys_in_band(flat, owner, size, below[pick], pick, most_apart(size[pick] + top, similar) + 1))
        below = below - 1
    return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def narrow_sketches(sets: list[np.ndarray]) -> np.ndarray:
    """The 512 parity bits of each set as bytes."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    bit = (np.concatenate(sets) & np.uint64(NARROW - 1)).astype(np.int64)
    odd = np.bincount(owner * NARROW + bit, minlength=len(sets) * NARROW) & 1
    return np.packbits(odd.astype(np.uint8).reshape(len(sets), NARROW), axis=1)


def _sketch(k: int, similar: tuple[int, int]):
    def run(batches):
        met: set[bytes] = set()  # texts of this task: a copy needs no keys of its own
        for part in common.slices(batches):
            buf, off = common.text_buffer(common.column_of(part, "text"))
            raw, n = buf.tobytes(), part.num_rows
            names = common.column_of(part, "sig").to_pylist()
            sets = [shingle_hashes(raw[a:b], k) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            size = np.array([len(x) for x in sets], np.int64)
            new = []
            for i in np.flatnonzero(size).tolist():
                if names[i] not in met:
                    met.add(names[i])
                    new.append(i)
            keys, many, sketch = [np.zeros(0, np.uint64)], np.zeros(n, np.int64), [None] * n
            if new:
                whose, found = keys_of([sets[i] for i in new], similar)
                order = np.argsort(whose, kind="stable")
                keys.append(found[order])
                many[new] = np.bincount(whose, minlength=len(new))
                for i, bits in zip(new, narrow_sketches([sets[i] for i in new])):
                    sketch[i] = bits.tobytes()
            ends = pa.array(np.concatenate(([0], np.cumsum(many))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [common.column_of(part, "id"), common.column_of(part, "sig"), pa.array(size), pa.array(sketch, pa.binary()),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate(keys).view(np.int64)))],
                names=["id", "sig", "n", "sketch", "keys"])

    return run


# ----------------------------------------------------------------------- rounds of pairs

def _first_pairs(batches):
    """Rows (key, row) come sorted: those of keys with several, with the key's least row in this task as ``pivot``."""
    def grouped(key, row, edge):
        at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.append(at, len(key)))
        pivot = np.repeat(row[at], size)
        many = np.repeat((size > 1) | edge(at, size), size)
        return pa.RecordBatch.from_arrays([pa.array(key[many]), pa.array(row[many]), pa.array(pivot[many])], names=["key", "row", "pivot"])

    key, row, begun = np.zeros(0, np.int64), np.zeros(0, np.int64), False
    for batch in batches:
        key = np.concatenate((key, common.column_of(batch, "key").to_numpy()))
        row = np.concatenate((row, common.column_of(batch, "row").to_numpy()))
        if not len(key):
            continue
        whole = int(np.searchsorted(key, key[-1]))  # the last key may go on
        if whole:
            # the task's first key may have begun in another one
            yield grouped(key[:whole], row[:whole], lambda at, size, b=begun: (at == 0) & (not b))
            begun = True
            key, row = key[whole:], row[whole:]
        elif len(key) > 1 << 20:  # one key for very long: its pivot is enough to go on
            out = pa.RecordBatch.from_arrays([pa.array(key[1:]), pa.array(row[1:]), pa.array(np.full(len(key) - 1, row[0]))], names=["key", "row", "pivot"])
            yield out
            key, row, begun = key[:1], row[:1], False  # its first row still has to be named
    if len(key):
        yield grouped(key, row, lambda at, size: np.ones(len(at), bool))


def groups(sketched: DataFrame) -> DataFrame:
    """(key, row, pivot) of the keys that several rows hold; the rows of one key may lie in several tasks."""
    keyed = sketched.select(F.explode("keys").alias("key"), "row")
    dealt = keyed.repartitionByRange(common.shuffle_partitions(sketched.sparkSession), "key", "row").sortWithinPartitions("key", "row")
    return common.written(dealt.mapInArrow(_first_pairs, "key long, row long, pivot long"), "jaccard-groups")


def _block_pairs(lo: int, hi: int, similar: tuple[int, int]):
    """Candidates of each run of rows with one (key, i, j); rows come sorted by it, then by class.

    A set's partners are ranked among those of other components at the start, so
    that rounds offer different ones; those of its present component are left out."""
    num, den = similar

    def candidates(two: bool, side, cls, start, comp, n, bits):
        """Pairs of one block, or of ``two``: sizes, bits and components allow a link; ``more`` if there are some beyond ``hi``."""
        if two:
            rows, others = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
            late = np.full(len(cls), -1)
        else:  # sets of the largest component need no comparison among themselves
            names, at, many = np.unique(start, return_inverse=True, return_counts=True)
            minor = at != many.argmax()
            rows, others = np.flatnonzero(minor), np.arange(len(cls))
            late = np.where(minor, others, -1)
        out_a, out_b, more = [], [], False
        if not len(others):
            return out_a, out_b, more
        step = max(1, (1 << 15) // len(others))
        for u in range(0, len(rows), step):
            i = rows[u:u + step]
            ok = (start[i, None] != start[others]) & (late[others] < i[:, None])
            x, y = n[i, None], n[others]
            ok &= np.minimum(x, y) * den >= np.maximum(x, y) * num
            r, c = np.nonzero(ok)
            apart = np.bitwise_count(bits[i[r]] ^ bits[others[c]]).sum(axis=1, dtype=np.int64)
            near = apart <= most_apart(n[i[r]] + n[others[c]], similar)
            r, c = r[near], c[near]
            rank = np.arange(len(r)) - np.searchsorted(r, r)
            open_ = comp[i[r]] != comp[others[c]]
            more = more or bool((open_ & (rank >= hi)).any())
            take = open_ & (rank >= lo) & (rank < hi)
            out_a.append(cls[others[c[take]]])
            out_b.append(cls[i[r[take]]])
        return out_a, out_b, more

    def run(batches):
        held: list[pa.RecordBatch] = []

        def emit(rows: pa.Table):
            column = {c: rows.column(c).to_numpy() for c in ("key", "i", "j", "side", "cls", "start", "comp", "n")}
            bits = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint64).reshape(-1, NARROW // 64)
            new = np.zeros(len(rows), bool)
            new[0] = True
            for c in ("key", "i", "j"):
                new[1:] |= column[c][1:] != column[c][:-1]
            at = np.append(np.flatnonzero(new), len(rows))
            a, b, more = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], False
            for u, v in zip(at[:-1].tolist(), at[1:].tolist()):
                if v - u > 1:
                    two = bool(column["i"][u] != column["j"][u])
                    x, y, m = candidates(two, *(column[c][u:v] for c in ("side", "cls", "start", "comp", "n")), bits[u:v])
                    a, b, more = a + x, b + y, more or m
            a, b = np.concatenate(a), np.concatenate(b)
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
            if more:
                pairs = np.concatenate((pairs, [[-1, -1]]))
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows = pa.Table.from_batches(held)
            last = [rows.column(c)[-1].as_py() for c in ("key", "i", "j")]
            same = np.ones(len(rows), bool)
            for c, value in zip(("key", "i", "j"), last):
                same &= rows.column(c).to_numpy() == value
            whole = len(rows) - int(same.sum())  # the last run may go on
            if whole:
                yield emit(rows.slice(0, whole))
                held = rows.slice(whole).combine_chunks().to_batches()
        if held:
            yield emit(pa.Table.from_batches(held))

    return run


def _blocks(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows (key, i, j, side, cls, start, n, sketch) of the keys whose sets (cls, start) are not one component; large keys in pairs of blocks."""
    unsettled = (members.groupBy("key").agg(F.min("start").alias("low"), F.max("start").alias("high"), F.count("*").alias("c"))
                 .where("low < high").select("key", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks")))
    rows = members.join(unsettled, "key").join(classes.select("cls", "n", "sketch"), "cls")
    own = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")).otherwise(0)
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                       (F.col("own") > F.col("other")).cast("int").alias("side"), "cls", "start", "n", "sketch")


def _named(df: DataFrame, comps: DataFrame, name: str) -> DataFrame:
    """``df`` with the component of ``cls`` in column ``name``."""
    found = comps.select(F.col("node").alias("cls"), F.col("root").alias(name))
    return df.join(found, "cls", "left").withColumn(name, F.coalesce(name, "cls"))


# -------------------------------------------------------------------------- verification

def _linked(k: int, similar: tuple[int, int]):
    import zstandard
    num, den = similar

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        held: dict[int, np.ndarray] = {}

        def hashes(name, packed):
            if name not in held:
                if len(held) > 256:
                    held.clear()
                held[name] = shingle_hashes(unpack(packed), k)
            return held[name]

        for batch in batches:
            found = []
            rows = [common.column_of(batch, c) for c in ("a", "b", "text_a", "text_b")]
            for a, b, x, y in zip(*(c.to_pylist() for c in rows)):
                x, y = hashes(a, x), hashes(b, y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if den * both >= num * (len(x) + len(y) - both):
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(2)], names=["a", "b"])

    return run


def _plausible(similar: tuple[int, int]):
    """Pairs whose sizes and narrow sketches allow a link."""
    num, den = similar

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            n = [common.column_of(batch, c).to_numpy() for c in ("n_a", "n_b")]
            bits = [np.frombuffer(b"".join(common.column_of(batch, c).to_pylist()), np.uint64).reshape(-1, NARROW // 64)
                    for c in ("sketch_a", "sketch_b")]
            apart = np.bitwise_count(bits[0] ^ bits[1]).sum(axis=1, dtype=np.int64)
            ok = (np.minimum(*n) * den >= np.maximum(*n) * num) & (apart <= most_apart(n[0] + n[1], similar))
            yield pa.RecordBatch.from_arrays([common.column_of(batch, c).filter(pa.array(ok)) for c in ("a", "b")], names=["a", "b"])

    return run


def _packed(batches):
    import zstandard
    pack = zstandard.ZstdCompressor(level=1).compress
    for part in common.slices(batches):
        texts = [pack(t) for t in common.column_of(part, "text").cast("binary").to_pylist()]
        yield pa.RecordBatch.from_arrays([common.column_of(part, "sig"), pa.array(texts, pa.binary())], names=["sig", "packed"])


def _small(df: DataFrame, rows: int = 1 << 20) -> DataFrame:
    """The written table ``df``, broadcast if it has at most ``rows`` rows (short ones of fixed size)."""
    return F.broadcast(df) if df.count() <= rows else df


def verified(pairs: DataFrame, texts: DataFrame, classes: DataFrame, k: int, similar: tuple[int, int]) -> DataFrame:
    """The pairs of classes (a, b) whose shingle sets are similar enough, judged on the whole texts."""
    sized = pairs
    for side in ("a", "b"):
        sized = sized.join(classes.select(F.col("cls").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}")), side)
    sized = common.written(sized.mapInArrow(_plausible(similar), "a long, b long"), "jaccard-sized")
    wanted = sized.select(F.col("a").alias("cls")).union(sized.select("b")).distinct().join(classes, "cls").select("cls", "sig")
    wanted = common.written(wanted, "jaccard-wanted")
    bodies = texts.join(_small(wanted.select("sig")), "sig", "left_semi").mapInArrow(_packed, "sig binary, packed binary")
    bodies = bodies.groupBy("sig").agg(F.first("packed").alias("packed"))
    bodies = common.written(bodies.join(wanted, "sig").select("cls", "packed"), "jaccard-texts")
    both = (sized.join(bodies.select(F.col("cls").alias("b"), F.col("packed").alias("text_b")), "b")
            .join(bodies.select(F.col("cls").alias("a"), F.col("packed").alias("text_a")), "a"))
    links = common.written(both.select("a", "b", "text_a", "text_b").mapInArrow(_linked(k, similar), "a long, b long"), "jaccard-links")
    for table in (sized, wanted, bodies):
        common.drop_written(table)
    return links


# ----------------------------------------------------------------------------- the join

def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = SHINGLE,
                       similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """(id, n_shingles, component_id) for every row: the smallest id that links of similarity num/den or more reach."""
    spark: SparkSession = docs.sparkSession
    common.ship_package(spark)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = texts.withColumn("sig", F.unhex(F.md5("text")))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = texts.mapInArrow(_sketch(k, similar), f"id {kind}, sig binary, n long, sketch binary, keys array<long>")
    rows = common.written(rows.withColumn("row", F.monotonically_increasing_id()), "jaccard-rows")
    # copies are one class, named by its least row with keys
    some = rows.where("n > 0")
    named = some.groupBy("sig").agg(F.min(F.when(F.col("sketch").isNotNull(), F.col("row"))).alias("cls"), F.min("id").alias("low"))
    marked = some.where("sketch is not null").select("row", "sig", "n", "sketch").join(named, "sig")
    marked = common.written(marked, "jaccard-marked")
    classes = marked.where("row = cls").select("cls", "sig", "n", "sketch", "low")

    held = groups(rows.where("sketch is not null"))
    of_row = marked.select("row", "cls")
    members = held.select("key", "row").join(of_row, "row").select("key", "cls").distinct()
    members = common.written(members, "jaccard-members")
    pairs = (held.where("row <> pivot").select("row", "pivot").distinct()
             .join(of_row, "row").join(of_row.select(F.col("row").alias("pivot"), F.col("cls").alias("pivot_cls")), "pivot")
             .select(F.least("cls", "pivot_cls").alias("a"), F.greatest("cls", "pivot_cls").alias("b")).where("a < b").distinct())
    pairs = common.written(pairs, "jaccard-pairs")
    links = verified(pairs, texts, classes, k, similar)
    comps = common.written(common.components(links, "jaccard-cc"), "jaccard-comps")
    dealt = common.written(_blocks(common.written(_named(members, comps, "start"), "jaccard-members"), classes), "jaccard-blocks")
    lo, hi, more = 0, PARTNERS, bool(dealt.head(1))
    while more:
        rows_now = _named(dealt, comps, "comp").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side", "cls")
        offered = common.written(rows_now.mapInArrow(_block_pairs(lo, hi, similar), "a long, b long").distinct(), "jaccard-pairs")
        more = bool(offered.where("a < 0").head(1))
        fresh = offered.where("a >= 0").join(pairs, ["a", "b"], "left_anti")
        if fresh.head(1):
            links = common.written(links.union(verified(fresh, texts, classes, k, similar)), "jaccard-links")
            comps = common.written(common.components(links, "jaccard-cc"), "jaccard-comps")
        lo, hi = hi, hi * 8

    label = classes.join(comps, classes["cls"] == comps["node"], "left").withColumn("top", F.coalesce("root", "cls"))
    least = label.groupBy("top").agg(F.min("low").alias("component_id"))
    labels = label.join(least, "top").select("sig", "component_id")
    out = rows.select("id", "sig", "n").join(labels, "sig", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def op11(spark, sf_dir):
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS a, unnest(range(1, len(w) + 1)) AS i, len(w) AS n FROM w),
runs AS (
  SELECT doc_id, n, i, a, lead(a) OVER d AS b, lead(a, 2) OVER d AS c, lead(a, 3) OVER d AS e FROM words
  WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
sets AS (
  SELECT DISTINCT doc_id, a || ' ' || b || ' ' || c || ' ' || e AS g FROM runs WHERE e IS NOT NULL
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM w WHERE len(w) BETWEEN 1 AND 3),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
  SELECT x.doc_id AS u, y.doc_id AS v, count(*) AS shared FROM sets x JOIN sets y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
near AS (
  SELECT u, v FROM links JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v WHERE 100 * shared >= 85 * (a.n + b.n - shared)),
reach AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, n.v FROM reach r JOIN near n ON n.u = r.v)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, min(r.v) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach r ON r.u = d.doc_id
GROUP BY d.doc_id, s.n
"""
