"""Quality rules from DataFrame functions alone.

Base rules look at one document: too few words, or too many words inside 8-word
windows that repeat.  The cross-document rule counts, per host, in how many
distinct documents each normalised line stands; lines above a limit are
boilerplate, and a document that is left with too little besides them is
depleted.

Documents are told apart there by their whole normalised text, so only copies count
as one.  ``judged`` (op5) returns counts and the verdict, ``kept_documents`` (the
pipeline's stage) the rows that pass, without their frequent lines; both rest on
``boilerplate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.llm import common

#: White space of `[\\x20\\x09-\\x0D]` and the symbols that are counted.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Distinct documents of a host that may share a line, and the share of a document's words that must stand outside such lines.
MAX_DOCS = 100
MIN_LEFT = 0.1


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.size(words_of(F.coalesce(text, F.lit(""))))


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words that stand in a ``window``-word run found at least twice in ``words``."""
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (window - 1)),
                         lambda i: F.xxhash64(F.slice(words, i, window)))

    def covered(placed: Column) -> Column:
        again = F.filter(placed, lambda x, i: (F.get(placed, i - 1)["h"] == x["h"]) | (F.get(placed, i + 1)["h"] == x["h"]))
        places = F.array_sort(F.transform(again, lambda x: x["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("to"))
        return F.aggregate(places, start,
                           lambda a, p: F.struct((a["n"] + p + window - F.greatest(a["to"], p)).alias("n"), (p + window).alias("to")),
                           lambda a: a["n"])

    def of_hashes(h: Column) -> Column:
        # the sort is needed only where some window does repeat
        placed = F.array_sort(F.transform(h, lambda v, i: F.struct(v.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(bound(placed, covered))

    return F.when(F.size(words) <= window, 0).otherwise(bound(hashes, of_hashes))


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def solid_lines(text: Column) -> Column:
    """The lines of ``text`` that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: without(x, SPACE) != "")


def base_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    Null text counts as empty: no words, so it fails."""
    t = F.coalesce(F.col(text), F.lit(""))
    counts = bound(words_of(t), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeat_words(w).cast("long").alias("r")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (docs.withColumns({
        "__counts": counts,
        "word_chars": F.length(without(t, SPACE)).cast("long"),
        "n_symbols": (F.length(t) - F.length(without(t, SYMBOLS))).cast("long"),
        "n_dup_lines": bound(solid_lines(t), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")})
        .withColumns({"n_words": F.col("__counts.n"), "n_repeat_words": F.col("__counts.r")})
        .drop("__counts").withColumn("base_failed", failed))


def row_key(id_col: str = "doc_id", host: str = "source", text: str = "text") -> Column:
    """The same for rows that are the same, so that both passes over the documents agree."""
    marked = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in (id_col, host, text)]
    return F.unhex(F.md5(F.concat_ws("\x00", *marked)))


def normal_lines(text: Column) -> Column:
    """The lines of ``text`` that hold a word, trimmed and lower-cased."""
    return F.transform(solid_lines(F.coalesce(text, F.lit(""))), lambda x: F.lower(F.btrim(x, F.lit(SPACE))))


def line_table(docs: DataFrame, id_col: str, host: str, text: str) -> DataFrame:
    """(key, host, doc, place, line, n): hashes and word counts of all lines, written as they are read more than once.

    ``doc`` tells documents apart: copies of a whole normalised text are one."""
    lines = (docs.select(row_key(id_col, host, text).alias("key"), F.coalesce(F.concat(F.lit("="), F.col(host)), F.lit("")).alias("host"),
                         normal_lines(F.col(text)).alias("lines"))
             .withColumn("doc", F.xxhash64("lines"))
             .select("key", "host", "doc", F.posexplode("lines").alias("place", "line"))
             .select("key", "host", "doc", "place", F.xxhash64("line").alias("line"), F.size(words_of(F.col("line"))).alias("n")))
    return common.written(lines, "quality-lines")


def frequent_lines(lines: DataFrame, max_docs: int) -> DataFrame:
    """(host, line): the lines that stand in more than ``max_docs`` distinct documents of their host."""
    return (lines.groupBy("host", "line", "doc").agg(F.lit(1)).groupBy("host", "line").agg(F.count("*").alias("docs"))
            .where(F.col("docs") > max_docs).select("host", "line", F.lit(True).alias("common")))


def boilerplate(docs: DataFrame, id_col: str = "doc_id", host: str = "source", text: str = "text",
                max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """(key, lines, n_removed_lines, n_removed_words, depleted): the documents that hold frequent lines.

    ``lines`` are the hashes of those lines, the counts say how often they stand in the
    document and with how many words; of a depleted one less than ``min_left`` of the words
    is left.  A line is trimmed and lower-cased; blank lines count nowhere.  Rows without a
    host are a host of their own.  Repeated rows give one key, with the counts of one row."""
    lines = line_table(docs, id_col, host, text)
    held = (lines.join(frequent_lines(lines, max_docs), ["host", "line"]).groupBy("key")
            .agg(F.sum("n").alias("removed"), F.count("*").alias("places"), F.collect_set("line").alias("lines")))
    total = lines.groupBy("key").agg(F.sum("n").alias("n"), F.count_if(F.col("place") == 0).alias("rows"))
    of_one = lambda c: F.expr(f"{c} div rows")
    return held.join(total, "key").select("key", "lines", of_one("places").alias("n_removed_lines"), of_one("removed").alias("n_removed_words"),
                                          (F.col("n") - F.col("removed") < min_left * F.col("n")).alias("depleted"))


def judged(docs: DataFrame, **limits) -> DataFrame:
    """``docs`` (doc_id, source, text) but for the text, with the counts of the base rules, of removed lines, and ``kept``.

    A null or empty text has no words and is not kept; repeated rows are judged alike, each
    by itself; an empty table gives none.  Other columns stay, whatever their names, unless
    they are those of a count."""
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    mine = (*counts, "n_removed_lines", "n_removed_words", "kept")
    own = [c for c in docs.columns if c != "text" and c not in mine]
    found = boilerplate(docs.select("doc_id", "source", "text"), **limits).drop("lines").withColumnRenamed("key", "__gone")
    rows = base_rules(docs.select(F.struct(*[F.col(c) for c in own]).alias("__row"), row_key().alias("__key"), "text")).drop("text")
    kept = ~F.col("base_failed") & ~F.coalesce("depleted", F.lit(False))
    return (rows.join(found, F.col("__key") == F.col("__gone"), "left")
            .select(*[F.col("__row")[c].alias(c) for c in own], *counts,
                    *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_removed_lines", "n_removed_words")], kept.alias("kept")))


def without_lines(text: Column, gone: Column) -> Column:
    """``text`` without the lines whose normalised hashes are in ``gone``; blank lines stay."""
    normal = lambda x: F.lower(F.btrim(x, F.lit(SPACE)))
    stays = lambda x: (without(x, SPACE) == "") | ~F.array_contains(gone, F.xxhash64(normal(x)))
    return F.array_join(F.filter(F.split(text, "\n"), stays), "\n")


def kept_documents(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that pass, without their frequent lines, with their own columns and no others.

    Texts without frequent lines stay as they are; ``n_chars`` (if there) follows a changed text.
    Null and empty texts go by the base rules; repeated rows stay or go together."""
    found = boilerplate(docs.select("doc_id", "source", "text"), **limits)
    found = found.select(F.col("key").alias("__found"), F.col("lines").alias("__lines"), F.col("depleted").alias("__depleted"))
    mark = F.struct(*[F.col(c) for c in docs.columns]).alias("__row")
    flagged = base_rules(docs.select(mark, "doc_id", "source", "text")).where(~F.col("base_failed"))
    rows = (flagged.select("__row", row_key().alias("__key")).join(found, F.col("__key") == F.col("__found"), "left")
            .where(~F.coalesce("__depleted", F.lit(False))))
    changed = F.col("__lines").isNotNull()
    rows = rows.withColumn("__text", F.when(changed, without_lines(F.col("__row.text"), F.col("__lines"))).otherwise(F.col("__row.text")))
    new = {"text": F.col("__text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(changed, F.length("__text").cast(kind)).otherwise(F.col("__row.n_chars"))
    return rows.select(*[new.get(c, F.col("__row")[c]).alias(c) for c in docs.columns])


def op5(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                               "base_failed", "kept", "n_removed_lines", "n_removed_words")


_WS = r"[\x20\x09-\x0D]+"
SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, list_filter(regexp_split_to_array(t, '{_WS}'), lambda x: x <> '') AS ws FROM d
), win AS (
  SELECT rid, i, list_slice(ws, i, i + {WINDOW - 1}) AS k
  FROM (SELECT rid, ws, unnest(generate_series(1, len(ws) - {WINDOW - 1})) AS i FROM w WHERE len(ws) >= {WINDOW})
), rep AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM win) WHERE c > 1
), cov AS (
  SELECT rid, count(DISTINCT i + j) AS r FROM rep, (SELECT unnest(generate_series(0, {WINDOW - 1})) AS j) GROUP BY rid
), raw_lines AS (
  SELECT rid, host, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS place FROM d
), lines AS (
  SELECT rid, host, place, line AS raw, lower(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS line
  FROM raw_lines WHERE regexp_replace(line, '{_WS}', '', 'g') <> ''
), dup AS (
  SELECT rid, count(*) - count(DISTINCT raw) AS n_dup FROM lines GROUP BY rid
), whole AS (
  SELECT rid, md5(string_agg(line, chr(10) ORDER BY place)) AS doc FROM lines GROUP BY rid
), frequent AS (
  SELECT host, line FROM lines JOIN whole USING (rid) GROUP BY host, line HAVING count(DISTINCT doc) > {MAX_DOCS}
), left_over AS (
  SELECT rid, sum(n) AS n, coalesce(sum(n) FILTER (f), 0) AS removed, count(*) FILTER (f) AS removed_lines FROM (
    SELECT rid, len(list_filter(regexp_split_to_array(l.line, '{_WS}'), lambda x: x <> '')) AS n, f.line IS NOT NULL AS f
    FROM lines l LEFT JOIN frequent f ON l.host = f.host AND l.line = f.line) GROUP BY rid
), counted AS (
  SELECT d.doc_id, len(w.ws)::BIGINT AS n_words, len(regexp_replace(t, '{_WS}', '', 'g'))::BIGINT AS word_chars,
         len(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(r, 0)::BIGINT AS n_repeat_words,
         coalesce(l.n - l.removed < {MIN_LEFT} * l.n, false) AS depleted,
         coalesce(removed_lines, 0)::BIGINT AS n_removed_lines, coalesce(removed, 0)::BIGINT AS n_removed_words
  FROM d JOIN w USING (rid) LEFT JOIN cov USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN left_over l USING (rid)
), judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT depleted AS kept, n_removed_lines, n_removed_words
FROM judged
"""
