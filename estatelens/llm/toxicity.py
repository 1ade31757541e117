"""Toxicity scores of texts, read through disguises.

1. A character language model (trigrams over a-z and a word edge) is counted over
   all documents.
2. A word that mixes letters with look-alike digits and marks, stretches letters,
   or is spelled with gaps is an observation of a noisy channel.  Its lattice has,
   per character, the letters it may stand for, nothing (a separator), or a
   repetition of the letter before; Viterbi decoding finds the letters that the
   channel and the language model find likeliest together.  A run of short tokens
   is one lattice in which a gap may also be a word edge, at the language model's
   cost.
3. Restored texts are scored: words and word beginnings that toxic documents hold
   far more often than others carry a weight, and a logistic curve turns a
   document's sum into a score.  Weights and curve are fitted on a bounded sample
   of the labelled rows that are not held out.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.llm import common

#: Labelled rows that the classifier is fitted on, at most (the least by a hash of their ids).
SAMPLE_ROWS = 20_000
#: Words and word beginnings in the model, at most.
FEATURES = 4096
MIN_TOXIC = 4
MIN_WEIGHT = 2.0
PREFIXES = (4, 5, 6)
THRESHOLD = 0.3
CACHE_WORDS = 500_000

# Letters that a character may stand for, and marks put between letters.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a",
              "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou", "#": "h"}
SEPARATORS = "-_.*~'`^,:/\\"
#: Costs in nats: a plain look-alike, a wild card, a dropped mark, a dropped repetition.
COST_LOOKALIKE, COST_WILD, COST_MARK, COST_REPEAT = 0.5, 2.5, 0.5, 1.0

_EDGE = ".,!?;:\"()[]{}<>%&#$*+=…»«“”‘’-–—_~|\\/'`^"
_LETTERS = re.compile(r"[^\W\d_]")
_STRETCHED = re.compile(r"([^\W\d_])\1\1")
#: What joins two words in one token; look-alikes don't.
_JOINED = re.compile(r"[,;:/\\\-_.–—…\"]+")
#: White space and marks between the short tokens of a spelled run, and look-alikes that may also end a word in it.
_GAP = r"\s" + re.escape(SEPARATORS)
_ENDS = "!|(+#"
_SHORT = rf"[(\[{{<\"“‘«]*[^{_GAP}]{{1,2}}[)\]}}>\"”’»;?!…]*"
_RUN = re.compile(rf"(?<![^{_GAP}]){_SHORT}(?:[{_GAP}]+{_SHORT}){{2,}}(?![^{_GAP}])")
_IS_GAP = re.compile(rf"[{_GAP}]")
_GAPPED = re.compile(r"(?<!\S)[^\W_]([ .\-_*])[^\W_](?:\1[^\W_])+(?!\S)")


# ------------------------------------------------------------- character language model

_CODE = np.zeros(256, np.int32)
_CODE[np.arange(97, 123)] = np.arange(1, 27)
_CODE[np.arange(65, 91)] = np.arange(1, 27)


def _count_grams(batches):
    """Trigram counts of one task's whole texts; everything but a-z is a word edge."""
    total = np.zeros(27 ** 3, np.int64)
    for part in common.slices(batches):
        buf, off = common.text_buffer(common.column_of(part, "text"))
        c = np.zeros(len(buf) + 2 * len(off), np.int32)  # an edge before and after every document
        shift = np.repeat(2 * np.arange(1, len(off)), np.diff(off))
        c[np.arange(len(buf)) + shift] = _CODE[buf]
        grams = c[:-2] * 729 + c[1:-1] * 27 + c[2:]
        total += np.bincount(grams, minlength=27 ** 3)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["gram", "n"])


def language_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """27 x 27 x 27 costs (nats) of a letter after two others; 0 is the word edge.

    Counts come from every document; at most 27**3 sums reach the driver."""
    common.ship_package(docs.sparkSession)
    rows = docs.select(F.col(text).alias("text")).mapInArrow(_count_grams, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = np.zeros(27 ** 3)
    for r in rows.collect():
        counts[r.gram] = r.n
    counts = counts.reshape(27, 27, 27)
    return -np.log((counts + 0.5) / (counts + 0.5).sum(axis=2, keepdims=True))


# ------------------------------------------------------------------------- decoding

def lattice(word: str) -> list[list[tuple[str, float]]]:
    """Per character what it may stand for: (letter or "" for nothing, cost)."""
    out = []
    for i, ch in enumerate(word):
        arcs: list[tuple[str, float]] = []
        if "a" <= ch <= "z":
            arcs.append((ch, 0.0))
            if i and word[i - 1] == ch:
                arcs.append(("", COST_REPEAT if i < 2 or word[i - 2] != ch else 0.1))
        letters = LOOKALIKES.get(ch, "")
        arcs += [(x, COST_WILD if len(letters) > 2 else COST_LOOKALIKE) for x in letters]
        if ch in SEPARATORS or not arcs:
            arcs.append(("", COST_MARK))
        out.append(arcs)
    return out


def spelled_lattice(run: str) -> list[list[tuple[str, float]]]:
    """The lattice of a run of short tokens: white space and marks may be nothing or a word edge (" ")."""
    letters = iter(lattice(_IS_GAP.sub("", run)))
    out = []
    for i, ch in enumerate(run):
        if ch.isspace():
            out.append([("", 0.0), (" ", 0.0)])
        elif ch in SEPARATORS:
            out.append([*lattice(ch)[0], (" ", COST_MARK)])
        else:
            arcs = next(letters)
            if i and ch in _ENDS:
                arcs.append((" ", COST_MARK))
            out.append(arcs)
    return out


def likeliest(arcs_of: list[list[tuple[str, float]]], model: np.ndarray) -> str:
    """The letters of the cheapest path by Viterbi; each state keeps a chain of the letters before."""
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for arcs in arcs_of:
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, done) in states.items():
            for letter, price in arcs:
                if letter:
                    c = 0 if letter == " " else ord(letter) - 96
                    key, total = (b, c), cost + price + model[a, b, c]
                else:
                    key, total = (a, b), cost + price
                if key not in after or total < after[key][0]:
                    after[key] = (total, (done, letter) if letter else done)
        states = after
    end = min(states, key=lambda k: (states[k][0] + model[k[0], k[1], 0], k))
    chain, out = states[end][1], []
    while chain:
        chain, letter = chain
        out.append(letter)
    return "".join(reversed(out))


def restore(word: str, model: np.ndarray) -> str:
    """Likeliest letters behind ``word`` (lower case) by Viterbi over its lattice."""
    return likeliest(lattice(word), model)


def disguised(word: str) -> bool:
    """A word with letters and look-alikes or marks inside, or a letter three times over."""
    if len(word) < 3 or not _LETTERS.search(word):
        return False
    return bool(_STRETCHED.search(word)) or any(ch in LOOKALIKES or ch in SEPARATORS for ch in word)


def pieces(token: str, model: np.ndarray) -> list[str]:
    """The words of one token: as written, without marks at its ends, and as restored."""
    core = token.strip(_EDGE)
    out = [core] if core else []
    if core and core.isalpha():
        if _STRETCHED.search(core):
            out.append(restore(core, model))
        return out
    out += [x for x in re.split(r"[\W_]+", core) if x]
    tight = token.strip(".,;:\"()[]{}<>%&")
    out += [restore(x, model) for x in {core, tight, *_JOINED.split(core), *_JOINED.split(tight)} if disguised(x)]
    return [x for x in out if x]


def gapped(text: str) -> list[str]:
    """Words spelled letter by letter with a mark or a space between."""
    return [re.sub(r"[ .\-_*]", "", m.group()) for m in _GAPPED.finditer(text)]


def spelled(text: str, model: np.ndarray, known: dict) -> set[str]:
    """The words behind runs of short tokens, their ends with and without marks that may be look-alikes."""
    out: set[str] = set()
    for m in _RUN.finditer(text):
        run = " ".join(m.group().split())
        found = known.get(" " + run)
        if found is None:
            ends = {run.strip(_EDGE + " "), run.strip(".,;:\"()[]{}<>%& ")}
            ends |= {x[2:] for x in ends if x.startswith(("a ", "i "))}  # words of one letter, after which the model may see no edge
            found = known[" " + run] = [w for x in ends if _LETTERS.search(x) for w in likeliest(spelled_lattice(x), model).split()]
        out.update(found)
    return out


def features_of(word: str) -> list[str]:
    """A whole word (marked) and its beginnings."""
    return ["=" + word, *(word[:n] for n in PREFIXES if len(word) >= n)]


def document_words(text: str, model: np.ndarray, known: dict[str, list[str]]) -> set[str]:
    low = text.lower()
    out: set[str] = set()
    for token in set(low.split()):
        found = known.get(token)
        if found is None:
            found = known[token] = pieces(token, model)
        out.update(found)
    for run in gapped(low):
        out.add(run)
        out.add(restore(run, model))
    out.update(spelled(low, model, known))
    return out


# --------------------------------------------------------------------------- fitting

def held_out(id_col: str = "doc_id"):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, toxic, part) of at most ``rows`` labelled, not held-out ids: those with the least hashes.

    A quarter of the texts (part 3) is for the curve, so that words which only
    the weights' own rows make look toxic do not bend it."""
    usable = (labels.where("toxic is not null and doc_id is not null").where(~held_out())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return (docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
            .select("text", "toxic", F.pmod(F.xxhash64("text"), F.lit(4)).alias("part")))


def _count_features(model: np.ndarray):
    def run(batches):
        known: dict[str, list[str]] = {}
        toxic: dict[str, int] = {}
        clean: dict[str, int] = {}
        n = [0, 0]
        for part in common.slices(batches):
            for text, label in zip(common.column_of(part, "text").to_pylist(), common.column_of(part, "toxic").to_pylist()):
                if len(known) > CACHE_WORDS:
                    known.clear()
                into = toxic if label else clean
                n[1 if label else 0] += 1
                for f in {f for w in document_words(text, model, known) for f in features_of(w)}:
                    into[f] = into.get(f, 0) + 1
        toxic[""], clean[""] = n[1], n[0]  # the number of documents
        names = [*(toxic.keys() | clean.keys())]
        yield pa.RecordBatch.from_arrays([
            pa.array(names, pa.string()), pa.array([toxic.get(x, 0) for x in names], pa.int64()),
            pa.array([clean.get(x, 0) for x in names], pa.int64())], names=["feature", "toxic", "clean"])

    return run


def fit_weights(train: DataFrame, model: np.ndarray, features: int = FEATURES) -> dict[str, float]:
    """Log ratios of the features that toxic documents hold far more often, the strongest ``features`` of them."""
    counts = train.mapInArrow(_count_features(model), "feature string, toxic long, clean long")
    counts = common.written(counts.groupBy("feature").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")), "toxic-counts")
    all_ = counts.where("feature = ''").first()
    if all_ is None or not all_.t:
        return {}
    # three clean documents more than seen: few toxic ones alone prove little
    ratio = F.log((F.col("t") + 0.5) / (all_.t + 1)) - F.log((F.col("c") + 3) / (all_.c + 6))
    best = (counts.where("feature <> ''").withColumn("w", ratio).where((F.col("t") >= MIN_TOXIC) & (F.col("w") >= MIN_WEIGHT))
            .orderBy(F.col("t") * F.col("w"), ascending=False).limit(features))
    return {r.feature: r.w for r in best.collect()}


def document_sum(text: str | None, model: np.ndarray, weights: dict[str, float], known: dict[str, tuple], runs: dict[str, list]) -> float:
    """Sum of the weights of a whole text's different words, each by its best feature."""
    low = (text or "").lower()
    if len(known) + len(runs) > CACHE_WORDS:
        known.clear()
        runs.clear()

    def best(words: list[str]) -> tuple:
        found = set()
        for w in words:
            f = max((f for f in features_of(w) if f in weights), key=lambda f: (weights[f], f), default=None)
            if f:
                found.add(f)
        return tuple(found)

    found: set[str] = set()
    for token in set(low.split()):
        hit = known.get(token)
        if hit is None:
            hit = known[token] = best(pieces(token, model))
        if hit:
            found.update(hit)
    for run in gapped(low):
        found.update(best([run, restore(run, model)]))
    for word in spelled(low, model, runs):
        found.update(best([word]))
    return sum(weights[f] for f in sorted(found))


def fit_curve(sums: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a logistic curve, with a small penalty on the slope, by Newton steps."""
    x = np.stack([np.ones(len(sums)), np.log1p(np.maximum(sums, 0))], axis=1)
    beta, penalty = np.zeros(2), np.diag([1e-3, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (toxic - p) - penalty @ beta)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(max(beta[1], 0.0))


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, held_out, score (0 to 1), predicted (1 from ``THRESHOLD`` on).

    Null and empty texts score as texts without any toxic word.  Without toxic
    labels every score is the smoothed share of toxic rows, zero.  A null id is
    not held out."""
    spark = docs.sparkSession
    common.ship_package(spark)
    model = language_model(docs, text)
    train = common.written(training_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), labels), "toxic-train")
    train = train.repartition(common.shuffle_partitions(spark))
    weights = fit_weights(train.where("part <> 3").select("text", "toxic"), model)

    def sums(batches):
        known: dict[str, tuple] = {}
        runs: dict[str, list] = {}
        for part in common.slices(batches):
            s = [document_sum(x, model, weights, known, runs) for x in common.column_of(part, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([common.column_of(part, "toxic"), pa.array(s, pa.float64())], names=["toxic", "s"])

    # at most SAMPLE_ROWS pairs of numbers
    seen = train.where("part = 3").select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(sums, "toxic int, s double").toPandas()
    a, b = fit_curve(seen["s"].to_numpy(), seen["toxic"].to_numpy().astype(float)) if weights and len(seen) else (-20.0, 0.0)

    def run(batches):
        known: dict[str, tuple] = {}
        runs: dict[str, list] = {}
        for part in common.slices(batches, text):
            s = [document_sum(x, model, weights, known, runs) for x in common.column_of(part, text).to_pylist()]
            score = [1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * math.log1p(x))))) for x in s]
            yield pa.RecordBatch.from_arrays([
                common.column_of(part, id_col), common.column_of(part, "held_out"), pa.array(score, pa.float64()),
                pa.array([int(x >= THRESHOLD) for x in score], pa.int32())], names=[id_col, "held_out", "score", "predicted"])

    source = docs.select(F.col(id_col), F.col(text), F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"))
    schema = source.select(id_col, "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema
    return source.mapInArrow(run, schema)


def op8(spark, sf_dir):
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
