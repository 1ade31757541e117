"""Exact substring dedup: suffixes that share ``LENGTH`` bytes, found bucket by bucket.

A string of LENGTH bytes that starts at two places is a pair of suffixes with a
long common prefix.  As in difference-cover suffix sorting, only a sample of the
suffixes (the cover) is ranked by full comparison, and all other suffixes are
told apart by the few bytes in front of the next cover suffix and by its rank.

The cover is chosen by content, so that it also lines up between documents: each
window of LENGTH bytes has as its cover place the first least hash among its
GRAM-byte runs.  Two equal windows have their cover place at the same distance,
less than LENGTH, which is what a difference cover has to give; about one byte
in seventy is in the cover.

1. Each block of documents names every cover place by its run's hash, together
   with a hash of all bytes that the place's windows span, and sends both to the
   name's bucket.  A name met once settles all its windows: no other suffix equals
   them.  Spans met twice settle theirs too: all are repeated.
2. What is left, one place for each different span of a name, sends its bytes to
   the name's bucket.  Buckets are sorted one at a time: the cover suffixes
   forwards, and the bytes in front of them backwards, both with the lengths
   that neighbours share.  From these ranks the suffix ``d`` bytes before a cover
   place has the pair of classes (d bytes before it, LENGTH - d bytes from it),
   and two suffixes are equal over LENGTH bytes exactly when the pairs are.
   No class is a hash and no string is compared twice.
3. Blocks mark the windows that repeat and remove every byte they cover.

A name with very many different spans (the edge of a passage in countless
documents) is not gathered in one bucket: its windows are counted one by one in
an aggregation that is combined before the shuffle.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.llm import common, words

LENGTH = 200
GRAM = 64
#: Windows handled at once.
PIECE = 1 << 19
#: Different spans under one name beyond which its windows are counted one by one.
HOT = 4096
#: What a bucket says of a span: repeated as a whole; its bytes are needed; its windows are counted one by one.
WHOLE, BYTES, SINGLY = 1, 2, 4


def _sums(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = words.powers(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=sums[1:])
    return sums, down


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width``, by doubling."""
    best, have = values, 1
    while 2 * have <= width:
        best = np.minimum(best[:-have], best[have:])
        have *= 2
    rest = width - have
    return np.minimum(best[:len(best) - rest], best[rest:]) if rest else best


class Places:
    """Cover places of one block: position, first and last window, name and hash of the span."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, length: int, gram: int):
        width = length - gram + 1
        inside = np.zeros(len(buf) + 1, bool)  # windows within one document
        for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
            if b - a >= length:
                inside[a:b - length + 1] = True
        at, first, last, name, span = [], [], [], [], []
        for lo in range(0, max(0, len(buf) - length + 1), PIECE):
            hi = min(lo + PIECE, len(buf) - length + 1)
            valid = inside[lo:hi]
            if not valid.any():
                continue
            raw = buf[lo:hi - 1 + length]
            sums, down = _sums(raw)
            n = len(raw) - gram + 1
            grams = words.mixed((sums[gram:] - sums[:-gram]) * down[:n])
            bits = np.uint64(int(n).bit_length())
            ranked = ((grams >> bits) << bits) | np.arange(n, dtype=np.uint64)
            where = (_least(ranked, width) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
            new = valid.copy()
            new[1:] &= (where[1:] != where[:-1]) | ~valid[:-1]
            start = np.flatnonzero(new)
            stop = valid.copy()
            stop[:-1] &= (where[1:] != where[:-1]) | ~valid[1:]
            end = np.flatnonzero(stop)
            place, to = where[start], end + length
            shape = ((place - start) * length + (end - start)).astype(np.uint64)
            at.append(place + lo)
            first.append(start + lo)
            last.append(end + lo)
            name.append(grams[place])
            span.append(words.mixed((sums[to] - sums[start]) * down[start] + words.mixed(shape + np.uint64(1))))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.at, self.first, self.last = join(at, np.int64), join(first, np.int64), join(last, np.int64)
        self.name, self.span = join(name, np.uint64), join(span, np.uint64)
        #: One place for each different (name, span), sorted; ``which``: each place's number among them.
        pairs = np.stack([self.name, self.span], axis=1)
        order = np.lexsort((self.span, self.name))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (pairs[order[1:]] != pairs[order[:-1]]).any(axis=1)
        self.some = order[fresh]
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(fresh) - 1
        self.several = np.bincount(self.which, minlength=len(self.some)) > 1


# ------------------------------------------------------------------ step 1: names

def _send_names(length: int, gram: int, shards: int):
    def run(batches):
        for row, buf, off in common.blocks_in(batches):
            p = Places(buf, off, length, gram)
            name, span = p.name[p.some], p.span[p.some]
            order, at = common.by_shard(name, shards)
            used = np.flatnonzero(np.diff(at))
            part = [order[at[s]:at[s + 1]] for s in used]
            if len(used):
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array(used.astype(np.int32)), "block": pa.array([row["block"].as_py()] * len(used)),
                    "names": pa.array([name[o].tobytes() for o in part], pa.binary()),
                    "spans": pa.array([span[o].tobytes() for o in part], pa.binary()),
                    "several": pa.array([np.packbits(p.several[o]).tobytes() for o in part], pa.binary())})

    return run


def _settle(hot: int):
    """One bucket of names: what is known of each block's spans."""
    def run(table):
        blocks, shard = table["block"].to_pylist(), table["shard"][0].as_py()
        names = [np.frombuffer(x, np.uint64) for x in table["names"].to_pylist()]
        spans = np.frombuffer(b"".join(table["spans"].to_pylist()), np.uint64)
        several = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(n))
                                  for x, n in zip(table["several"].to_pylist(), names)]).astype(bool)
        ends = np.cumsum([len(n) for n in names])
        name = np.concatenate(names)
        order = np.lexsort((spans, name))
        n, s = name[order], spans[order]
        new_name, new_span = np.ones(len(n), bool), np.ones(len(n), bool)
        new_name[1:] = n[1:] != n[:-1]
        new_span[1:] = new_name[1:] | (s[1:] != s[:-1])
        group, pair = np.cumsum(new_name) - 1, np.cumsum(new_span) - 1
        different = np.bincount(group[new_span])[group]
        whole = (np.bincount(pair) > 1) | (np.bincount(pair, weights=several[order]) > 0)
        said = np.where(whole[pair], WHOLE, 0)
        # one place of each different span stands for it where a name has several spans
        said = said + np.where(new_span & (different > 1), np.where(different > hot, SINGLY, BYTES), 0)
        state = np.empty(len(n), np.uint8)
        state[order] = said
        parts = np.split(state, ends[:-1])
        told = [(b, p.tobytes()) for b, p in zip(blocks, parts) if p.any()]
        return pa.table({"block": pa.array([b for b, _ in told], pa.string()), "shard": pa.array([shard] * len(told), pa.int32()),
                         "states": pa.array([p for _, p in told], pa.binary())})

    return run


def _states(row: dict, p: Places, shards: int) -> np.ndarray:
    """State of each different span of a block, from what its buckets said."""
    out = np.zeros(len(p.some), np.uint8)
    order, at = common.by_shard(p.name[p.some], shards)
    for told in row["told"].as_py() or []:
        s = told["shard"]
        out[order[at[s]:at[s + 1]]] = np.frombuffer(told["states"], np.uint8)
    return out


# --------------------------------------------------------------- step 2: suffixes

_OPEN = "kind int, shard int, block string, body binary, mark1 long, mark2 long, place int, ahead int"


def _send_open(length: int, gram: int, shards: int):
    """Kind 0: bytes of spans by bucket.  Kind 1: single windows of very common names."""
    import zstandard
    reach = length - gram

    def run(batches):
        packer = zstandard.ZstdCompressor(level=3)
        for row, buf, off in common.blocks_in(batches):
            p = Places(buf, off, length, gram)
            state = _states(row, p, shards)
            block = row["block"].as_py()
            padded = np.concatenate((np.zeros(reach, np.uint8), buf, np.zeros(length, np.uint8)))
            todo = np.flatnonzero(state & BYTES)
            order, at = common.by_shard(p.name[p.some[todo]], shards)
            for s in np.flatnonzero(np.diff(at)).tolist():
                which = todo[order[at[s]:at[s + 1]]]
                one = p.some[which]
                head = np.stack([which, p.at[one] - p.first[one], p.at[one] - p.last[one]]).astype("<i4")
                # bytes beyond a span are blanked: they take part in no window
                spot = np.arange(reach + length)
                text = padded[p.at[one][:, None] + spot]
                from_, to = reach - head[1], reach - head[2] + length
                text[(spot < from_[:, None]) | (spot >= to[:, None])] = 0
                body = packer.compress(head.tobytes() + p.name[one].tobytes() + text.tobytes())
                yield _open_row([0], [s], [block], [body], [None], [None], [None], [None])
            for which in np.flatnonzero(state & SINGLY).tolist():
                one = p.some[which]
                a, b = int(p.first[one]), int(p.last[one])
                marks = [hashlib.blake2b(buf[i:i + length].tobytes(), digest_size=16).digest() for i in range(a, b + 1)]
                half = np.frombuffer(b"".join(marks), "<i8").reshape(-1, 2)
                n = b - a + 1
                yield _open_row([1] * n, [None] * n, [block] * n, [None] * n, half[:, 0], half[:, 1], [which] * n,
                                list(range(int(p.at[one]) - a, int(p.at[one]) - b - 1, -1)))

    return run


def _open_row(kind, shard, block, body, mark1, mark2, place, ahead) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(kind, pa.int32()), pa.array(shard, pa.int32()), pa.array(block, pa.string()), pa.array(body, pa.binary()),
        pa.array(mark1, pa.int64()), pa.array(mark2, pa.int64()), pa.array(place, pa.int32()), pa.array(ahead, pa.int32())],
        names=["kind", "shard", "block", "body", "mark1", "mark2", "place", "ahead"])


def _ranked(group: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, bytes shared with the one before; -1 where the group changes) of rows sorted by group and bytes."""
    pad = -text.shape[1] % 8
    wide = np.ascontiguousarray(np.pad(text, ((0, 0), (0, pad)))).view(">u8").astype(np.uint64)
    order = np.lexsort([*wide.T[::-1], group])
    shared = np.full(len(order), -1, np.int64)
    for lo in range(1, len(order), 1 << 15):
        hi = min(lo + (1 << 15), len(order))
        differ = text[order[lo:hi]] != text[order[lo - 1:hi - 1]]
        length = np.where(differ.any(axis=1), differ.argmax(axis=1), text.shape[1])
        shared[lo:hi] = np.where(group[order[lo:hi]] == group[order[lo - 1:hi - 1]], length, -1)
    return order, shared


def repeated_windows(group: np.ndarray, text: np.ndarray, most: np.ndarray, least: np.ndarray, length: int, reach: int) -> np.ndarray:
    """(rows, reach + 1) marks: the suffix that many bytes before a row's cover place repeats in the bucket.

    ``text`` has ``reach`` bytes before each cover place and ``length`` from it."""
    forward, shared_f = _ranked(group, text[:, reach:])
    back, shared_b = _ranked(group, text[:, :reach][:, ::-1])
    marks = np.zeros((len(group), reach + 1), bool)
    class_f, class_b = np.empty(len(group), np.int64), np.empty(len(group), np.int64)
    for d in range(reach + 1):
        rows = np.flatnonzero((least <= d) & (d <= most))
        if len(rows) < 2:
            continue
        class_f[forward] = np.cumsum(shared_f < length - d)
        class_b[back] = np.cumsum(shared_b < d)
        _, at, number = np.unique(class_f[rows] * (len(group) + 1) + class_b[rows], return_inverse=True, return_counts=True)
        marks[rows, d] = number[at] > 1
    return marks


def _sort_bucket(length: int, gram: int):
    reach = length - gram

    def run(table):
        import zstandard
        unpacker = zstandard.ZstdDecompressor()
        blocks, heads, names, texts = [], [], [], []
        for block, body in zip(table["block"].to_pylist(), table["body"].to_pylist()):
            raw = unpacker.decompress(body)
            n = len(raw) // (12 + 8 + reach + length)
            heads.append(np.frombuffer(raw, "<i4", 3 * n).reshape(3, n))
            names.append(np.frombuffer(raw, np.uint64, n, 12 * n))
            texts.append(np.frombuffer(raw, np.uint8, n * (reach + length), 20 * n).reshape(n, reach + length))
            blocks += [block] * n
        head, name = np.concatenate(heads, axis=1), np.concatenate(names)
        marks = repeated_windows(name, np.concatenate(texts), head[1], head[2], length, reach)
        said = np.flatnonzero(marks.any(axis=1))
        return pa.table({"block": pa.array([blocks[i] for i in said], pa.string()), "place": pa.array(head[0][said], pa.int32()),
                         "ahead": pa.array([np.packbits(marks[i]).tobytes() for i in said], pa.binary())})

    return run


# --------------------------------------------------------------- step 3: documents

def _removed(length: int, gram: int, shards: int, id_col: str, text: str, with_text: bool):
    reach = length - gram

    def run(batches):
        for row, buf, off in common.blocks_in(batches):
            p = Places(buf, off, length, gram)
            whole = (_states(row, p, shards) & WHOLE) > 0
            marks = np.zeros((len(p.some), reach + 1), bool)
            for x in row["marks"].as_py() or []:
                marks[x["place"]] |= np.unpackbits(np.frombuffer(x["ahead"], np.uint8), count=reach + 1).astype(bool)
            for x in row["singles"].as_py() or []:
                marks[x["place"], x["ahead"]] = True
            begins = np.zeros(len(buf) + 1, np.int64)
            every = whole[p.which]
            np.add.at(begins, p.first[every], 1)
            np.add.at(begins, p.last[every] + 1, -1)
            starts = np.cumsum(begins[:-1]) > 0
            some = np.flatnonzero(~every & marks[p.which].any(axis=1)) if len(p.some) else np.zeros(0, np.int64)
            for i in some.tolist():
                ahead = np.flatnonzero(marks[p.which[i]])
                at = p.at[i] - ahead
                starts[at[(at >= p.first[i]) & (at <= p.last[i])]] = True
            seen = np.concatenate((np.zeros(length, np.int64), np.cumsum(starts)))
            gone = seen[length:] > seen[:-length] if len(buf) else np.zeros(0, bool)
            total = np.concatenate(([0], np.cumsum(gone)))
            rise = gone.copy()
            rise[1:] &= ~gone[:-1]
            cut = off[:-1][off[:-1] < len(buf)]
            rise[cut] = gone[cut]
            runs = np.concatenate(([0], np.cumsum(rise)))
            kept = [buf[a:b][~gone[a:b]].tobytes() for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            columns = [row["ids"].values, pa.array(np.diff(off)), pa.array(total[off[1:]] - total[off[:-1]]),
                       pa.array(runs[off[1:]] - runs[off[:-1]]), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())]
            names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(kept, pa.binary())], [*names, text]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM,
                     hot: int = HOT, with_text: bool = False) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256 (and the bytes that are left).

    Every byte goes that a ``length``-byte string covers which also starts
    elsewhere, in the same or another row.  Null text is empty; texts shorter
    than ``length`` stay; repeated rows are repeats of each other."""
    if not 0 < gram <= length // 2:
        raise ValueError("a cover run is at most half as long as the strings")
    blocks = common.block_table(docs, id_col, text, "suffix-blocks")
    shards = common.shard_count(blocks)
    names = blocks.mapInArrow(_send_names(length, gram, shards),
                              "shard int, block string, names binary, spans binary, several binary")
    told = names.groupBy("shard").applyInArrow(_settle(hot), "block string, shard int, states binary")
    told = common.written(told.groupBy("block").agg(F.collect_list(F.struct("shard", "states")).alias("told")), "suffix-told")
    open_ = blocks.join(told, "block").mapInArrow(_send_open(length, gram, shards), _OPEN)
    open_ = common.written(open_, "suffix-open")
    sorted_ = (open_.where("kind = 0").select("shard", "block", "body").groupBy("shard")
               .applyInArrow(_sort_bucket(length, gram), "block string, place int, ahead binary"))
    marks = sorted_.groupBy("block").agg(F.collect_list(F.struct("place", "ahead")).alias("marks"))
    windows = open_.where("kind = 1").select("mark1", "mark2", "block", "place", "ahead")
    again = windows.groupBy("mark1", "mark2").agg(F.count("*").alias("n")).where("n > 1").select("mark1", "mark2")
    singles = (windows.join(again, ["mark1", "mark2"], "left_semi").groupBy("block")
               .agg(F.collect_list(F.struct("place", "ahead")).alias("singles")))
    found = common.written(told.join(marks, "block", "left").join(singles, "block", "left"), "suffix-marks")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
              + f", `{text}` binary" * with_text)
    return blocks.join(found, "block", "left").mapInArrow(_removed(length, gram, shards, id_col, text, with_text), schema)


def op1(spark, sf_dir):
    return dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
