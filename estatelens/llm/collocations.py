"""Phrase collocations by Toivonen's sampling method.

* A sample of the documents, mined at a lowered threshold, proposes words and
  two-word phrases.
* A full pass counts every word, every two-word phrase of proposed words and every
  three-word phrase whose two halves are proposed.  These are the proposals and
  their negative border (the phrases all of whose parts are proposed), counted
  exactly.
* A frequent phrase of the border that was not proposed is a border failure:
  longer phrases may hang on it.  It joins the proposals, and an expansion pass
  counts what that adds, until no failure is left.

Proposals travel as bitmaps of hashes with a fixed largest size: a bit set by
accident only counts a phrase more, and a phrase is counted in the first pass
whose bitmaps let it through, so no count is lost or doubled.  A phrase of two
words is known by both words' 64-bit hashes, one of three by those of its halves;
the words themselves come with the first full pass.

Null text has no words, null language is ``und``; repeated rows count as often as
they stand there; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelens.llm import common, words

#: One document in so many is in the sample, and how often a phrase must stand in it to be proposed.
SAMPLE_EVERY, SAMPLE_COUNT = 4, 2
#: Bits of the largest bitmaps of words and of two-word phrases.
WORD_BITS, PHRASE_BITS = 25, 27
#: Percent of a phrase's places inside one longer candidate from which it is dropped.
INSIDE = 50
_BREAK, _PART = np.zeros(256, bool), np.ones(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_PART[[0x20, 0x09]] = False
_PART &= ~_BREAK
_ODD = np.uint64(0x9E3779B97F4A7C15)


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of two parts, in order."""
    return words.mixed(left * _ODD + words.mixed(right ^ _ODD))


class Bits:
    """A bitmap over 64-bit hashes."""

    def __init__(self, power: int):
        self.power, self.cells = power, np.zeros(1 << (power - 6), np.uint64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64((1 << self.power) - 1)
        return (self.cells[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0

    def added(self, hashes: DataFrame) -> tuple[Bits, bool]:
        """(this and the bits of column ``h``, whether that sets new ones); at most one row per cell comes to the driver."""
        bit = F.col("h").bitwiseAND(F.lit((1 << self.power) - 1))
        cells = (hashes.groupBy(F.shiftright(bit, 6).alias("cell"))
                 .agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("bits")).toArrow())
        more = Bits(self.power)
        more.cells[:] = self.cells
        if cells.num_rows:
            more.cells[cells["cell"].to_numpy()] |= cells["bits"].to_numpy().view(np.uint64)
        return more, bool((more.cells != self.cells).any())


def power_for(rows: int, most: int) -> int:
    """Bitmap size: some eight bits a row, 2^16 at least and 2^most at most."""
    return min(most, max(16, (8 * rows).bit_length()))


def word_table(part: pa.RecordBatch):
    """(spellings, place of each word among them, whether the next word follows in its piece, document of each word)."""
    buf, off = common.text_buffer(common.column_of(part, "text"))
    buf = words.LOWER[buf]
    starts, ends, first = words.word_bounds(buf, off, _PART)
    size = ends - starts
    body = buf[_PART[buf]]
    offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
    spelled = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)]).dictionary_encode()
    breaks = np.concatenate(([0], np.cumsum(_BREAK[buf], dtype=np.int64)))
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    follows = (breaks[ends[:-1]] == breaks[starts[1:]]) & (doc[:-1] == doc[1:])
    return spelled.dictionary, spelled.indices.to_numpy(), follows, doc


def _tallied(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (x, y) and how often each stands there."""
    both = joined(x, y)
    order = np.argsort(both)
    both = both[order]
    at = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1]))) if len(both) else np.zeros(0, np.int64)
    one = order[at]
    return x[one], y[one], np.diff(np.append(at, len(both)))


def _emit(k: int, x: np.ndarray, y: np.ndarray, n: np.ndarray, word: pa.Array | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(x), k, np.int8)), pa.array(x.view(np.int64)), pa.array(y.view(np.int64)),
         word if word is not None else pa.nulls(len(x), pa.string()), pa.array(n.astype(np.int64))], names=["k", "x", "y", "word", "n"])


def _count(before, now, first: bool):
    """Rows (k, x, y, word, n): words (k = 1) if ``first``, phrases of two and three words that ``now`` lets through and ``before`` did not."""
    def run(batches):
        import xxhash
        # bitmaps come as broadcast variables of bounded size
        old, new = (b.value if b is not None else None for b in (before, now))
        for part in common.slices(batches):
            spelled, place, follows, doc = word_table(part)
            if not len(place):
                continue
            plain = np.array([xxhash.xxh64_intdigest(w) for w in spelled.to_pylist()], np.uint64)
            lang = common.column_of(part, "lang").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)[doc]
            w = joined(lang, plain[place])
            if first:
                names, n = np.unique(lang, return_counts=True)
                yield _emit(0, names, np.zeros(len(names), np.uint64), n)
                order = np.argsort(w)
                at = np.flatnonzero(np.concatenate(([True], w[order][1:] != w[order][:-1])))
                one = order[at]
                yield _emit(1, w[one], lang[one], np.diff(np.append(at, len(w))),
                            spelled.take(pa.array(place[one])).cast(pa.large_string()).cast(pa.string()))
            ok = follows.copy()
            if new is not None:
                is_in = new[0].has(w)
                ok &= is_in[:-1] & is_in[1:]
            if old is not None:
                was_in = old[0].has(w)
                ok &= ~(was_in[:-1] & was_in[1:])
            at = np.flatnonzero(ok)
            if len(at):
                yield _emit(2, *_tallied(w[at], w[at + 1]))
            if new is None:  # the sample proposes words and phrases of two
                continue
            two = joined(w[:-1], w[1:])
            is_in = follows & new[1].has(two)
            ok = is_in[:-1] & is_in[1:]
            if old is not None:
                was_in = old[1].has(two)
                ok &= ~(was_in[:-1] & was_in[1:])
            at = np.flatnonzero(ok)
            if len(at):
                yield _emit(3, *_tallied(two[at], two[at + 1]))

    return run


def counted(docs: DataFrame, least: int, before=None, now=None, first: bool = True) -> DataFrame:
    """Words and phrases of (text, lang) that stand there ``least`` times or more, and the words of each language (k = 0)."""
    rows = docs.mapInArrow(_count(before, now, first), "k byte, x long, y long, word string, n long")
    sums = rows.groupBy("k", "x", "y", "word").agg(F.sum("n").alias("n"))
    return common.written(sums.where(f"k = 0 or n >= {int(least)}"), "phrases")


def _with_joined(phrases: DataFrame) -> DataFrame:
    """Rows of phrases (x, y, n) and the hash ``h`` of the whole."""
    def run(batches):
        for batch in batches:
            x, y = (common.column_of(batch, c).to_numpy().view(np.uint64) for c in ("x", "y"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(joined(x, y).view(np.int64))], names=["x", "y", "n", "h"])
    return phrases.select("x", "y", "n").mapInArrow(run, "x long, y long, n long, h long")


def frequent_phrases(docs: DataFrame, least: int = 10, sample_every: int = SAMPLE_EVERY,
                     sample_count: int = SAMPLE_COUNT) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, int]:
    """(words per language, words, phrases of two, phrases of three, full passes): all that stand there ``least`` times or more.

    ``docs`` has (text, lang), the language as a long."""
    spark = docs.sparkSession
    common.ship_package(spark)
    sample = counted(docs.where(F.pmod(F.xxhash64("text"), F.lit(sample_every)) == 0), sample_count)
    sizes = {r.k: r.n for r in sample.groupBy("k").agg(F.count("*").alias("n")).collect()}
    proposed = [Bits(power_for(sizes.get(1, 0), WORD_BITS)).added(sample.where("k = 1").select(F.col("x").alias("h")))[0],
                Bits(power_for(sizes.get(2, 0), PHRASE_BITS)).added(_with_joined(sample.where("k = 2")))[0]]
    common.drop_written(sample)
    before, tables = None, []
    while True:
        now = spark.sparkContext.broadcast(proposed)
        tables.append(counted(docs, least, before, now, first=not tables))
        single = tables[0].where("k = 1").select("x", F.col("y").alias("lang"), "word", "n")
        pairs = tables[0].where("k = 2")
        for t in tables[1:]:
            pairs = pairs.union(t.where("k = 2"))
        pairs = common.written(_with_joined(pairs), "phrases-2")
        # border failures: frequent, but not among the proposals
        (more_words, a), (more_pairs, b) = proposed[0].added(single.select(F.col("x").alias("h"))), proposed[1].added(pairs.select("h"))
        if not (a or b):
            break
        common.drop_written(pairs)
        proposed, before = [more_words, more_pairs], now
    triples = tables[0].where("k = 3")
    for t in tables[1:]:
        triples = triples.union(t.where("k = 3"))
    totals = tables[0].where("k = 0").select(F.col("x").alias("lang"), F.col("n").alias("total"))
    return totals, single, pairs, triples.select("x", "y", "n"), len(tables)


def _score(a: str, left: str, right: str):
    wide = "decimal(16,0)"  # a * a * 1000000 stays within 38 digits
    return F.expr(f"(cast(1000000 as decimal(7,0)) * cast({a} as {wide}) * cast({a} as {wide})) div (cast({left} as {wide}) * cast({right} as {wide}))")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10, top: int = 2000,
                 sample_every: int = SAMPLE_EVERY, sample_count: int = SAMPLE_COUNT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two and three words."""
    names = docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("name"))
    coded = names.select("text", F.xxhash64("name").alias("lang"))
    totals, single, pairs, triples, _ = frequent_phrases(coded, least, sample_every, sample_count)
    one = single.select("x", "lang", "word", "n")
    two = (pairs.join(one.select("x", "lang", F.col("word").alias("word1"), F.col("n").alias("n1")), "x")
           .join(one.select(F.col("x").alias("y"), F.col("word").alias("word2"), F.col("n").alias("n2")), "y")
           .select("h", "lang", "word1", "word2", "n1", "n2", "n"))
    two = common.written(two, "phrases-named")
    front = two.select(F.col("h").alias("x"), "lang", "word1", F.col("word2").alias("middle"), "n1", F.col("n").alias("n12"))
    back = two.select(F.col("h").alias("y"), F.col("word2").alias("word3"), F.col("n2").alias("n3"), F.col("n").alias("n23"))
    three = (triples.join(front, "x").join(back, "y")
             .withColumns({"s1": _score("n", "n1", "n23"), "s2": _score("n", "n12", "n3")})
             .select("lang", F.concat_ws(" ", "word1", "middle", "word3").alias("phrase"), F.col("n").alias("a"),
                     F.when(F.col("s1") <= F.col("s2"), F.col("n1")).otherwise(F.col("n12")).alias("l"),
                     F.when(F.col("s1") <= F.col("s2"), F.col("n23")).otherwise(F.col("n3")).alias("r"),
                     F.least("s1", "s2").alias("score")))
    longer = (triples.select(F.col("x").alias("h"), "n").union(triples.select(F.col("y").alias("h"), "n"))
              .groupBy("h").agg(F.max("n").alias("longer")))
    kept = two.join(longer, "h", "left").where(F.coalesce(F.col("longer"), F.lit(0)) * 100 < F.col("n") * INSIDE)
    short = kept.select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), F.col("n").alias("a"), F.col("n1").alias("l"),
                        F.col("n2").alias("r"), _score("n", "n1", "n2").alias("score"))
    # the limit on the rank is applied within each task before the rows of a language meet
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = three.unionByName(short).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    known = names.select("name").distinct().select(F.xxhash64("name").alias("lang"), "name")
    return (best.join(totals, "lang").join(known, "lang")
            .select(F.col("name").alias("lang"), F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                    F.col("total").alias("n"), "score"))


def op12(spark, sf_dir):
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
numbered AS (
  SELECT lang, row_number() OVER () AS p, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
w1 AS (SELECT lang, p, unnest(w) AS a, unnest(range(1, len(w) + 1)) AS i FROM numbered),
w3 AS (SELECT lang, a, lead(a) OVER piece AS b, lead(a, 2) OVER piece AS c FROM w1 WINDOW piece AS (PARTITION BY p ORDER BY i)),
grams AS (
  SELECT lang, 1 AS k, a AS phrase, count(*) AS f FROM w3 GROUP BY ALL
  UNION ALL SELECT lang, 2, a || ' ' || b, count(*) FROM w3 WHERE b IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, a || ' ' || b || ' ' || c, count(*) FROM w3 WHERE c IS NOT NULL GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS p FROM grams WHERE k >= 2 AND f >= 10),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, cut, lf.f AS l, rf.f AS r,
         (1000000::HUGEINT * c.a * c.a) // (lf.f::HUGEINT * rf.f) AS score
  FROM cand c CROSS JOIN (VALUES (1), (2)) AS cuts(cut)
  JOIN grams lf ON lf.lang = c.lang AND lf.k = cut AND lf.phrase = array_to_string(list_slice(c.p, 1, cut), ' ')
  JOIN grams rf ON rf.lang = c.lang AND rf.k = c.k - cut AND rf.phrase = array_to_string(list_slice(c.p, cut + 1, c.k), ' ')
  WHERE cut < c.k),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, array_to_string(list_slice(p, 1, 2), ' ') AS phrase, a FROM cand WHERE k = 3
    UNION ALL SELECT lang, array_to_string(list_slice(p, 2, 3), ' '), a FROM cand WHERE k = 3) GROUP BY lang, phrase),
kept AS (
  SELECT s.* FROM lowest s LEFT JOIN longer t ON s.k = 2 AND t.lang = s.lang AND t.phrase = s.phrase
  WHERE t.a IS NULL OR 100 * t.a < 50 * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
