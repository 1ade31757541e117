"""Benchmark decontamination with a generalised suffix automaton over words.

The test items' words (A-Z lower-cased, `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`) build
one automaton that knows every run of words of every item.  Document words are
streamed through it; after each word the state says how long a run ending there
also stands in some item.  Where that length reaches a window (10 words, or a
whole shorter item), the words of the run are hit and the items that hold the
window are noted.

Only stretches that could hold a window are streamed: runs of document words in
which every neighbouring pair also stands in an item.  Any other word pair sends
the automaton back to a length below two, so the lengths found are the same.

Items are taken in blocks of bounded size, one automaton each, and every block is
held against all documents in the same pass over the text.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.llm import common, words

WINDOW = 10
#: Bytes of item text in one automaton.
BLOCK_BYTES = 4 << 20
HITS, FOUND, COUNT, SPANS = "__decon_hits", "__decon_items", "__decon_words", "__decon_spans"


def item_words(text: str | None) -> list[bytes]:
    raw = (text or "").encode().translate(bytes(words.LOWER))
    keep = bytes(b if words.ALNUM[b] else 32 for b in range(256))
    return raw.translate(keep).split()


class Automaton:
    """Generalised suffix automaton of word lists."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.next, self.link, self.length = [{}], [-1], [0]
        for _, item in items:
            last = 0
            for word in item:
                last = self._add(last, word)
        #: State that holds a window -> {window length: items}
        self.windows: dict[int, dict[int, set]] = {}
        self.shortest = window
        for name, item in items:
            size = min(window, len(item))
            self.shortest = min(self.shortest, size)
            state, length = 0, 0
            for word in item:
                state, length = self.step(state, length, word)
                if length >= size:
                    at = self.holder(state, size)
                    self.windows.setdefault(at, {}).setdefault(size, set()).add(name)
        self._above: dict[int, list] = {}

    def _add(self, last: int, word: bytes) -> int:
        following = self.next[last].get(word)
        if following is not None:
            if self.length[following] == self.length[last] + 1:
                return following
            return self._split(last, word, following)
        new = self._state(self.length[last] + 1, {})
        p = last
        while p != -1 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p == -1:
            self.link[new] = 0
        else:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return new

    def _state(self, length: int, following: dict) -> int:
        self.next.append(following)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """The state for the runs of ``q`` that also end at ``p`` plus ``word``."""
        new = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[new], self.link[q] = self.link[q], new
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = new
            p = self.link[p]
        return new

    def step(self, state: int, length: int, word: bytes) -> tuple[int, int]:
        while state and word not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        following = self.next[state].get(word)
        return (0, 0) if following is None else (following, length + 1)

    def holder(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of what ``state`` has matched."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def ending_at(self, state: int) -> list[tuple[int, set]]:
        """(window length, items) of all windows that are the end of a run of ``state``."""
        known = self._above.get(state)
        if known is None:
            known, p = [], state
            while p > 0:
                known += self.windows.get(p, {}).items()
                p = self.link[p]
            self._above[state] = known
        return known

    def stream(self, run: list[bytes]):
        """(first word, last word + 1, items) of every hit in ``run``."""
        state, length = 0, 0
        for i, word in enumerate(run):
            state, length = self.step(state, length, word)
            if length >= self.shortest:
                longest, names = 0, set()
                for size, items in self.ending_at(state):
                    if size <= length:
                        longest = max(longest, size)
                        names |= items
                if longest:
                    yield i + 1 - longest, i + 1, names


class Scanner:
    """The automaton of one block of items with what picks the stretches to stream."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        listed = [(name, item_words(text)) for name, text in items]
        listed = [(name, item) for name, item in listed if item]
        self.automaton = Automaton(listed, window) if listed else None
        flat = [w for _, item in listed for w in item]
        sizes = np.array([len(item) for _, item in listed], np.int64)
        ends = np.cumsum([len(w) for w in flat], dtype=np.int64)
        hashes = words.span_hashes(np.frombuffer(b"".join(flat), np.uint8), np.concatenate(([0], ends[:-1])), ends) \
            if flat else np.zeros(0, np.uint64)
        self.known, ids = np.unique(hashes, return_inverse=True)
        inside = np.ones(max(0, len(flat) - 1), bool)
        inside[np.cumsum(sizes)[:-1] - 1] = False  # a pair over two items is none
        pairs = ids[:-1] * len(self.known) + ids[1:] if len(ids) else np.zeros(0, np.int64)
        self.pairs = np.unique(pairs[inside])

    def stretches(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word ranges, each in one document, that may hold a window."""
        none = np.zeros(0, np.int64)
        if self.automaton is None or not len(h):
            return none, none
        at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        known = self.known[at] == h
        need = self.automaton.shortest
        if need < 2:
            good, extra = known, 0
        else:
            pair = at[:-1] * len(self.known) + at[1:]
            good = known[:-1] & known[1:]
            cand = np.flatnonzero(good)
            if len(self.pairs):
                spot = np.minimum(np.searchsorted(self.pairs, pair[cand]), len(self.pairs) - 1)
                good[cand] = self.pairs[spot] == pair[cand]
            else:
                good[:] = False
            extra = 1
        cut = first[1:-1]
        cut = cut[(cut > 0) & (cut < len(h))]
        if extra:
            good[cut - 1] = False
            edges = np.diff(np.concatenate(([0], good.view(np.int8), [0])))
            starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) + 1
        else:
            starts = np.flatnonzero(good & ~np.concatenate(([False], good[:-1])) | good & np.isin(np.arange(len(good)), cut))
            ends = np.flatnonzero(good & ~np.concatenate((good[1:], [False])) | good & np.isin(np.arange(len(good)) + 1, cut)) + 1
        long = ends - starts >= need
        return starts[long], ends[long]


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _packed(pairs: list[tuple[int, int]]) -> bytes:
    return b"".join(struct.pack("<qq", a, b) for a, b in pairs)


def _unpacked(raw: bytes | None) -> list[tuple[int, int]]:
    return list(struct.iter_unpack("<qq", raw or b""))


def _pass(items: list[tuple[str, str]], window: int, text: str, names: list[str]):
    """One block of items against batches of documents; spans and items of earlier blocks are kept."""
    key = hashlib.sha256(repr((items, window)).encode()).hexdigest()

    def run(batches):
        scan = common.held(("items", key), lambda: Scanner(items, window))
        for part in common.slices(batches, text):
            buf, off = common.text_buffer(common.column_of(part, text))
            buf = words.LOWER[buf]
            starts, ends, first = words.word_bounds(buf, off, words.ALNUM)
            h = words.span_hashes(buf, starts, ends)
            hits: dict[int, list] = {}
            found: dict[int, set] = {}
            for a, b in zip(*(x.tolist() for x in scan.stretches(h, first))):
                doc = int(np.searchsorted(first, a, "right")) - 1
                run_words = [buf[starts[i]:ends[i]].tobytes() for i in range(a, b)]
                for x, y, ids in scan.automaton.stream(run_words):
                    hits.setdefault(doc, []).append((a + x - int(first[doc]), a + y - int(first[doc])))
                    found.setdefault(doc, set()).update(ids)
            old_hits = common.column_of(part, HITS).to_pylist()
            old_found = common.column_of(part, FOUND).to_pylist()
            all_hits = [_union(_unpacked(o) + hits.get(i, [])) for i, o in enumerate(old_hits)]
            spans = [[(int(starts[first[i] + a] - off[i]), int(ends[first[i] + b - 1] - off[i])) for a, b in runs]
                     for i, runs in enumerate(all_hits)]
            new = {
                HITS: pa.array([_packed(x) for x in all_hits], pa.binary()),
                SPANS: pa.array([_packed(x) for x in spans], pa.binary()),
                FOUND: pa.array([sorted({*(o or []), *found.get(i, ())}) for i, o in enumerate(old_found)], pa.list_(pa.string())),
                COUNT: pa.array(np.diff(first), pa.int64()),
            }
            yield pa.RecordBatch.from_arrays([new[c] if c in new else common.column_of(part, c) for c in names], names=names)

    return run


def item_blocks(benchmark: DataFrame) -> list[list[tuple[str, str]]]:
    """The items in blocks of about ``BLOCK_BYTES`` of text; each block goes to the tasks of its own pass."""
    listed = benchmark.select(F.col("item_id").cast("string").alias("id"), F.col("text").alias("text")).where("text is not null")
    total = listed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES)
    parts = [listed.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b) for b in range(blocks)]
    return [[(r.id or "", r.text) for r in part.orderBy("id", "text").collect()] for part in parts]


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with word count, hit word ranges, their byte spans and the items found (``__decon_`` columns)."""
    common.ship_package(docs.sparkSession)
    out = docs.select("*", F.lit(None).cast("binary").alias(HITS), F.lit(None).cast("binary").alias(SPANS),
                      F.lit(None).cast("array<string>").alias(FOUND), F.lit(0).cast("long").alias(COUNT))
    for items in item_blocks(benchmark) or [[]]:
        out = out.mapInArrow(_pass(items, window, text, out.columns), out.schema)
    return out


def _hit_words(raw) -> int:
    return sum(b - a for a, b in _unpacked(raw))


def hit_table(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
              window: int = WINDOW) -> DataFrame:
    """Per row: id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null or empty text has no words; items without words have no windows; rows
    of one item id count as one item; a null item id is the empty string."""
    found = scan(docs.select(F.col(id_col), F.col(text)), benchmark, text, window)
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_words long, n_hit long, n_items long, " \
             "items_sha256 string, contaminated boolean"

    def run(batches):
        for b in batches:
            hit = [_hit_words(x) for x in common.column_of(b, HITS).to_pylist()]
            items = [x or [] for x in common.column_of(b, FOUND).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                common.column_of(b, id_col), common.column_of(b, COUNT), pa.array(hit, pa.int64()),
                pa.array([len(x) for x in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
                pa.array([x > 0 for x in hit], pa.bool_())],
                names=[id_col, "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return found.drop(text).mapInArrow(run, schema)


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.5) -> DataFrame:
    """``docs`` without the benchmark spans; a document of which more than ``max_coverage`` of the words is hit goes.

    Untouched documents stay as they are; ``n_chars`` (if there) follows the new text.  Null and empty texts and
    repeated rows stay, extra columns keep their values whatever their names, and an empty table stays empty."""
    names = docs.columns
    # the scan's own columns stand beside these, whatever the others are called
    inner = [c if c in ("text", "n_chars") else f"c{i}" for i, c in enumerate(names)]
    found = scan(docs.toDF(*inner), benchmark, "text", window)

    def run(batches):
        for b in batches:
            spans = [_unpacked(x) for x in common.column_of(b, SPANS).to_pylist()]
            hit = [_hit_words(x) for x in common.column_of(b, HITS).to_pylist()]
            count = common.column_of(b, COUNT).to_pylist()
            keep = pa.array([h <= max_coverage * n for h, n in zip(hit, count)], pa.bool_())
            texts = common.column_of(b, "text").to_pylist()
            sizes = common.column_of(b, "n_chars").to_pylist() if "n_chars" in names else []
            for i, cuts in enumerate(spans):
                if cuts:
                    raw = texts[i].encode()
                    ends = [0, *(y for _, y in cuts)]
                    texts[i] = b"".join(raw[x:y] for x, y in zip(ends, [*(x for x, _ in cuts), len(raw)])).decode()
                    if sizes:
                        sizes[i] = len(texts[i])
            new = {"text": pa.array(texts, b.schema.field("text").type)}
            if sizes:
                new["n_chars"] = pa.array(sizes, b.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays([new.get(c, common.column_of(b, c)) for c in inner], names=names).filter(keep)

    return found.mapInArrow(run, docs.schema)


def op3(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return hit_table(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
