"""Mix sources to target weights by pivotal dependent rounding, in DataFrame functions alone.

Each source gets a share of all words by weight, at most twice its own size; the
share over the source's size is the expected number of copies of each of its
documents.  Whole copies are taken outright.  What is left of each document is a
fraction p that two documents settle between them: mass (p times size) moves
from one to the other, by chance in the one or the other direction so that the
expected p stays, until one of the two holds no copy or a whole one.  The other
goes on with the rest.  Sizes weigh the transfer, so the words taken stay equal
to the target up to the very last document of a source, which is rounded to the
nearer side.

The transfers form a tree: documents are dealt by a hash into groups of about
``FAN_IN``, each group folds to one open document, and the open documents of
neighbouring groups meet on the next level, down to one per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelens.llm import common
from estatelens.llm.quality import n_words

WEIGHTS = (3, 1, 2)
TOTAL = 1.5
MOST = 2.0
FAN_IN = 64
SEED = 20240717
_EPS = 1e-9


def targets(sizes: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """(source, source_size, docs, target) from (source, size): shares by weight under a ceiling.

    Sources by code point, null last, weigh ``weights`` in turn.  A source whose
    share is above ``most`` times its size gets that, and the excess goes to the
    others by weight: the sources with the lowest ceiling for their weight are
    the ones that reach it.  Works on one row per source."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    by = by.withColumn("weight", weight).withColumn("ceiling", F.col("source_size") * most)
    order = [F.col("ceiling") / F.col("weight"), F.col("source").asc_nulls_last()]
    lower = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    upper = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    spare = F.sum("source_size").over(everything) * total - F.coalesce(F.sum("ceiling").over(lower), F.lit(0.0))
    by = by.withColumn("level", spare / F.sum("weight").over(upper))
    # the level at the first source that stays under its ceiling holds for all after it
    under = F.when(F.col("level") * F.col("weight") <= F.col("ceiling"), F.col("level"))
    by = by.withColumn("level", F.first(under, ignorenulls=True).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    target = F.when(F.col("level").isNull(), F.col("ceiling")).otherwise(F.least(F.col("ceiling"), F.col("level") * F.col("weight")))
    return by.select("source", F.col("source_size").cast("long").alias("source_size"), "docs", target.alias("target"))


def _settled(p: Column) -> Column:
    return (p < _EPS) | (p > 1 - _EPS)


def _transfer(a: Column, b: Column, level: int) -> Column:
    """(first, second) after ``a`` and ``b`` have settled one of them; the open one is second."""
    up = F.least(a["size"] * (1 - a["p"]), b["size"] * b["p"])
    down = F.least(a["size"] * a["p"], b["size"] * (1 - b["p"]))
    chance = F.pmod(F.xxhash64(a["id"], a["size"], b["id"], b["size"], F.lit(SEED + level)), F.lit(1 << 53)) / float(1 << 53)
    move = F.when(chance * (up + down) < down, up).otherwise(-down)

    def with_p(x: Column, p: Column) -> Column:
        return F.struct(*[x[c].alias(c) for c in ("id", "row", "size", "whole")], p.alias("p"))

    def parted(m: Column) -> Column:
        first, second = with_p(a, a["p"] + m / a["size"]), with_p(b, b["p"] - m / b["size"])
        return F.when(_settled(first["p"]), F.struct(first.alias("done"), second.alias("open"))) \
            .otherwise(F.struct(second.alias("done"), first.alias("open")))

    return F.transform(F.array(move), parted)[0]


def _fold(members: Column, level: int) -> Column:
    """(done array, open): all members of a group after their transfers in order."""
    start = F.struct(F.slice(members, 1, 0).alias("done"), members[0].alias("open"))

    def step(state: Column, x: Column) -> Column:
        def apply(t: Column) -> Column:
            return F.struct(F.concat(state["done"], F.array(t["done"])).alias("done"), t["open"].alias("open"))
        passed = F.when(_settled(state["open"]["p"]), F.struct(state["open"].alias("done"), x.alias("open"))) \
            .when(_settled(x["p"]), F.struct(x.alias("done"), state["open"].alias("open"))) \
            .otherwise(_transfer(state["open"], x, level))
        return F.transform(F.array(passed), apply)[0]

    return F.aggregate(F.slice(members, 2, 1 << 30), start, step)


def mix(docs: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: float = MOST, fan_in: int = FAN_IN) -> DataFrame:
    """(row, doc_id, source, size, source_size, target, copies, taken) from (row, doc_id, source, size).

    A document without words takes part with no words.  Null ids and sources are
    values like any other; the same input gives the same rows however it is dealt."""
    sized = common.written(docs.select("row", "doc_id", "source", F.col("size").cast("long").alias("size")), "mix-sizes")
    by = common.written(targets(sized, weights, total, most), "mix-targets")
    largest = by.agg(F.max("docs")).first()[0] or 0
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(ratio + _EPS)
    part = F.when(F.col("size") > 0, F.greatest(ratio - whole, F.lit(0.0))).otherwise(F.lit(0.0))
    doc = F.struct(F.col("doc_id").alias("id"), F.col("row"), F.col("size"), whole.alias("whole"), part.alias("p"))
    groups = F.ceil(F.col("docs") / fan_in)
    mark = F.pmod(F.xxhash64("doc_id", "size", F.lit(SEED)), F.lit(1 << 62))
    # the hash's top decides the group, so a source's documents spread evenly over as many groups as it needs
    joined = sized.alias("d").join(by.alias("b"), F.col("d.source").eqNullSafe(F.col("b.source")))
    level = joined.select(F.col("d.source").alias("source"), (mark % groups).alias("group"), mark.alias("mark"), doc.alias("doc"))
    settled = None
    depth = 0
    while True:
        row = F.sort_array(F.collect_list(F.struct("mark", F.col("doc.id").alias("id"), F.col("doc.size").alias("size"), "doc")))
        folded = level.groupBy("source", "group").agg(row.alias("all")).select(
            "source", "group", _fold(F.transform("all", lambda x: x["doc"]), depth).alias("r"))
        folded = common.written(folded, f"mix-level{depth}")
        done = folded.select("source", F.explode("r.done").alias("doc"))
        settled = done if settled is None else settled.union(done)
        largest = -(-largest // fan_in)
        if largest <= 1:
            settled = settled.union(folded.select("source", F.col("r.open").alias("doc")))
            break
        level = folded.select("source", F.floor(F.col("group") / fan_in).alias("group"), F.col("group").alias("mark"),
                              F.col("r.open").alias("doc"))
        depth += 1
    # the last open document of a source has no partner: it goes to the nearer side
    extra = F.when(F.col("doc.p") >= 0.5, 1).otherwise(0)
    out = settled.select("source", F.col("doc.row").alias("row"), F.col("doc.id").alias("doc_id"), F.col("doc.size").alias("size"),
                         (F.col("doc.whole") + extra).cast("long").alias("copies"))
    return out.alias("o").join(by.alias("b"), F.col("o.source").eqNullSafe(F.col("b.source"))).select(
        "row", "doc_id", F.col("o.source").alias("source"), "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every document as many times as the mix takes it."""
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("doc")
    numbered = common.written(docs.select(F.monotonically_increasing_id().alias("row"), row), "mix-docs")
    sizes = numbered.select("row", F.col("doc.doc_id").alias("doc_id"), F.col("doc.source").alias("source"),
                            n_words(F.col("doc.text")).alias("size"))
    copies = mix(sizes, **options).where("copies > 0").select(F.col("row").alias("__row"), "copies")
    taken = numbered.join(copies, F.col("row") == F.col("__row"))
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")


def op7(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes = docs.select(F.lit(0).cast("long").alias("row"), "doc_id", "source", n_words(F.col("text")).alias("size"))
    return mix(sizes).select("doc_id", "size", "source_size", "target", "taken")
