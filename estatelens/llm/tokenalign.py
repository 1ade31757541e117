"""Two tokenizers aligned over the same bytes.

Each document is tokenized twice.  The tokens of both sides tile the same bytes,
so a token overlaps exactly those of the other side that cover its start or start
inside it: two ``pandas.merge_asof`` calls a batch, keyed by document, find for
each token start the other side's covering token, and the union of both
directions is the list of overlaps.  Where a token and its covering token start
together both sides have ended together before: these places cut the document
into groups, and every A token of a group is linked with every B token of it.

The corpus-wide count of an id pair is the number of documents that hold it
linked.  Documents are packed into blocks; a block has a dictionary of its pairs,
the dictionaries are summed, and the sums go back to the blocks: one row per pair
and block crosses the network, not one per link.

Null, empty and differing texts (joined token bytes unlike space + text) have no
tokens: zeros and an empty digest.  Repeated ids and rows are documents of their
own; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
import uuid
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.llm import common

#: Bytes of text aligned at once, and bytes of text of one block (a longer document is one of its own).
SLICE_BYTES, BLOCK_BYTES = 1 << 20, 16 << 20
#: Links expanded at once; a larger group is counted by its distinct ids instead.
LINKS_AT_ONCE = 1 << 21
#: Units, and characters of units, whose tokens a worker remembers.
CACHE_UNITS, CACHE_CHARS = 700_000, 16 << 20
#: A single space between something else and a character that is no white space: neither side joins tokens across its front.
CUT = re.compile("(?<=[^ ]) (?=[!-~¡-ɏ])")
#: Fixed value: how byte-level tokenizers of this kind cut words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: First character behind the Latin blocks, whose classes are the same in all Unicode versions in use.
_LATIN_END = "\u0250"
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _byte_of_character() -> dict[str, int]:
    """Byte of each character of byte-level tokens: visible bytes stand for themselves, the others follow from U+0100."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = itertools.count(0x100)
    return {chr(b if b in visible else next(hidden)): b for b in range(256)}


class Side:
    """Ids of texts and the bytes of ids; ``encode`` takes texts without the space before them."""

    def __init__(self, encode, token_bytes: list[bytes]):
        self.encode, self.token_bytes = encode, token_bytes
        self.sizes = np.array([len(t) for t in token_bytes], np.int64)
        self.names = [str(i).encode() + b"," for i in range(len(token_bytes))]


def _ranked(definition: dict, token_bytes: list[bytes], added: set[int]):
    """The same merges by rank (several times faster), where a merge's place in the file is the order of its id; else None."""
    import tiktoken
    model, before = definition["model"], definition.get("pre_tokenizer") or {}
    made = [model["vocab"].get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    ranks = {t: i for i, t in enumerate(token_bytes) if i not in added}
    plain = (before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
             and definition.get("normalizer") is None and not any(model.get(x) for x in ("dropout", "ignore_merges")))
    if not plain or None in made or made != list(range(256, 256 + len(made))) or len(ranks) != len(token_bytes) - len(added):
        return None
    return tiktoken.Encoding("side", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def byte_side(path: str) -> Side:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    byte = _byte_of_character()
    entries = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]
    plain = [bytes(byte[c] for c in e) if all(c in byte for c in e) else e.encode() for e in entries]
    definition = json.loads(tokenizer.to_str())
    ranked = _ranked(definition, plain, {t["id"] for t in definition.get("added_tokens") or []})

    def encode(texts):
        known = [bool(ranked) and max(t, default="") < _LATIN_END for t in texts]  # both libraries have the same classes there
        rest = iter(tokenizer.encode_batch_fast([" " + t for t, k in zip(texts, known) if not k], add_special_tokens=False))
        return [ranked(" " + t) if k else next(rest).ids for t, k in zip(texts, known)]

    return Side(encode, plain)


def piece_side(path: str) -> Side:
    import sentencepiece
    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = []
    for i in range(pieces.vocab_size()):
        piece = pieces.id_to_piece(i)
        one = _BYTE_PIECE.fullmatch(piece)
        plain.append(bytes([int(one[1], 16)]) if one else piece.replace("▁", " ").encode())
    return Side(lambda texts: pieces.encode(texts, num_threads=1), plain)


class Units:
    """Tokens of units of text, found for many units at once and remembered."""

    def __init__(self, sides: tuple[Side, Side]):
        self.sides = sides
        self.clear()

    def clear(self):
        self.known: dict[str, int] = {}
        self.good = bytearray()
        self.ids, self.ends, self.chars = (array("i"), array("i")), (array("q", [0]), array("q", [0])), 0

    def learn(self, units: set[str]) -> None:
        new = [u for u in units if u not in self.known]
        found = [side.encode(new) for side in self.sides]
        for unit, *both in zip(new, *found):
            want = b" " + unit.encode()
            good = True
            for side, ids, flat, ends in zip(self.sides, both, self.ids, self.ends):
                flat.extend(ids)
                ends.append(len(flat))
                good = good and b"".join([side.token_bytes[i] for i in ids]) == want
            self.known[unit] = len(self.good)
            self.good.append(good)
            self.chars += len(unit)

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(ids of each side, text after text; tokens per text of each side)."""
        if len(self.known) > CACHE_UNITS or self.chars > CACHE_CHARS:
            self.clear()
        cut = [CUT.split(t) if t else [] for t in texts]
        self.learn({u for units in cut for u in units})
        number = np.array([len(c) for c in cut], np.int64)
        at = np.fromiter(map(self.known.__getitem__, itertools.chain.from_iterable(cut)), np.int64, int(number.sum()))
        text_of = np.repeat(np.arange(len(texts)), number)
        odd = np.bincount(text_of, ~np.frombuffer(bytes(self.good), bool)[at], len(texts)) > 0 if len(at) else np.zeros(len(texts), bool)
        whole = {}
        for i in np.flatnonzero(odd).tolist():  # a unit differs: the whole text decides
            both = [side.encode([texts[i]])[0] for side in self.sides]
            want = b" " + texts[i].encode()
            if all(b"".join([s.token_bytes[t] for t in ids]) == want for s, ids in zip(self.sides, both)):
                whole[i] = both
        at, text_of = at[~odd[text_of]], text_of[~odd[text_of]]
        ids, counts = [], []
        for k in range(2):
            flat, ends = np.array(self.ids[k], np.int32), np.array(self.ends[k], np.int64)
            size = ends[at + 1] - ends[at]
            first = np.cumsum(size) - size
            got = flat[np.repeat(ends[at] - first, size) + np.arange(int(size.sum()))]
            count = np.bincount(text_of, size, len(texts)).astype(np.int64)
            if whole:
                parts = np.split(got, np.cumsum(count)[:-1])
                for i, both in whole.items():
                    parts[i] = np.array(both[k], np.int32)
                    count[i] = len(parts[i])
                got = np.concatenate(parts)
            ids.append(got)
            counts.append(count)
        return ids, counts


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """For tokens (doc, start) of two sides, ascending: the B row that covers each A start, and the A row that covers each B start."""
    def covering(left, right):
        right = right.assign(row=np.arange(len(right)))
        return pd.merge_asof(left, right, on="start", by="doc")["row"].to_numpy(np.int64)
    return covering(a, b), covering(b, a)


def _ragged(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for each run of ``size`` places."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(times, at) if len(at) else times


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.diff(np.append(at, len(keys)))


class Alignment:
    """Overlaps, groups and links of a batch of documents."""

    def __init__(self, ids: list[np.ndarray], counts: list[np.ndarray], sides: tuple[Side, Side]):
        self.ids, self.sides, self.docs = ids, sides, len(counts[0])
        frames = []
        for k in range(2):
            size = sides[k].sizes[ids[k]]
            frames.append(pd.DataFrame({"start": np.cumsum(size) - size, "doc": np.repeat(np.arange(self.docs), counts[k])}))
        self.cover = overlaps(*frames)
        starts = [f["start"].to_numpy() for f in frames]
        begins = [starts[k] == starts[1 - k][self.cover[k]] for k in range(2)]
        self.group = [np.cumsum(x) - 1 for x in begins]
        self.first = [np.append(np.flatnonzero(x), len(x)) for x in begins]  # first token of each group, and the end
        self.doc_of_group = frames[0]["doc"].to_numpy()[self.first[0][:-1]]
        self.width = [np.diff(f) for f in self.first]
        self.n_groups = np.bincount(self.doc_of_group, minlength=self.docs)
        self.n_links = np.zeros(self.docs, np.int64)
        np.add.at(self.n_links, self.doc_of_group, self.width[0] * self.width[1])

    def pairs(self, base: int) -> tuple[np.ndarray, np.ndarray]:
        """(document * base² + A id * base + B id ascending, links of it); ids are below ``base``."""
        links = self.width[0] * self.width[1]
        found, times = [], []
        small = np.flatnonzero(links <= LINKS_AT_ONCE)
        piece = np.cumsum(links[small]) // LINKS_AT_ONCE
        cuts = np.append(np.flatnonzero(np.diff(piece, prepend=-1)), len(small))
        for lo, hi in itertools.pairwise(cuts.tolist()):
            g = small[lo:hi]
            a = _ragged(self.first[0][g], self.width[0][g])           # every A token of these groups
            g_of_a = np.repeat(g, self.width[0][g])
            b = _ragged(self.first[1][g_of_a], self.width[1][g_of_a])  # for each of them every B token
            n = self.width[1][g_of_a]
            left = self.doc_of_group[g_of_a] * (base * base) + self.ids[0][a].astype(np.int64) * base
            one, many = _counted(np.repeat(left, n) + self.ids[1][b])
            found.append(one)
            times.append(many)
        for g in np.flatnonzero(links > LINKS_AT_ONCE).tolist():
            (a, na), (b, nb) = (_counted(self.ids[k][self.first[k][g]:self.first[k][g + 1]].astype(np.int64)) for k in range(2))
            step = max(1, LINKS_AT_ONCE // len(b))
            for i in range(0, len(a), step):
                found.append((self.doc_of_group[g] * (base * base) + a[i:i + step, None] * base + b).ravel())
                times.append((na[i:i + step, None] * nb).ravel())
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return _summed(np.concatenate(found), np.concatenate(times)) if len(found) > 1 else (found[0], times[0])

    def digests(self) -> list[str]:
        """SHA-256 of each document's groups as text; '' without tokens."""
        place = [np.arange(len(self.ids[0])) + self.first[1][self.group[0]],
                 np.arange(len(self.ids[1])) + self.first[0][self.group[1] + 1]]
        total = len(self.ids[0]) + len(self.ids[1])
        token, size = np.empty(total, np.int64), np.empty(total, np.int64)
        names, shift = [], 0
        for k in range(2):  # the names of both sides' ids, one after another
            length = np.array([len(n) for n in self.sides[k].names], np.int64)
            begin = np.cumsum(length) - length + shift
            names += self.sides[k].names
            shift += int(length.sum())
            token[place[k]], size[place[k]] = begin[self.ids[k]], length[self.ids[k]]
        text = np.frombuffer(b"".join(names), np.uint8)[_ragged(token, size)]
        ends = np.cumsum(size)
        text[ends[place[0][self.first[0][1:] - 1]] - 1] = ord("|")  # behind the last A token of a group
        last = ends[place[1][self.first[1][1:] - 1]]
        text[last - 1] = ord(";")
        raw, out, at = memoryview(text), [], 0
        stop = np.cumsum(self.n_groups)
        for n, s in zip(self.n_groups.tolist(), stop.tolist()):
            end = int(last[s - 1]) if n else at
            out.append(hashlib.sha256(raw[at:end - 1]).hexdigest() if n else "")
            at = end
        return out


class _Block:
    """What is kept of the documents of one block until it is written."""

    def __init__(self):
        self.names, self.columns, self.codes, self.times, self.sizes, self.bytes = [], [], [], [], [], 0

    def row(self, id_type: pa.DataType, base: int) -> pa.RecordBatch:
        import zstandard
        codes = np.concatenate(self.codes)
        pairs, docs = _counted(codes)  # a document holds a pair once
        place = np.searchsorted(pairs, codes).astype("<u4")
        body = b"".join([np.concatenate(self.sizes).astype("<u4").tobytes(), place.tobytes(),
                         np.concatenate(self.times).astype("<u8").tobytes()])
        n = sum(len(x) for x in self.names)
        name = uuid.uuid4().hex
        ids = pa.chunked_array(self.names, id_type).combine_chunks() if n else pa.array([], id_type)
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        stats = [pa.array(np.concatenate([c[i] for c in self.columns]), pa.int64()) for i in range(4)]
        sha = pa.array([s for c in self.columns for s in c[4]], pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([name]), one(ids), *map(one, stats), one(sha), one(pa.array(pairs // base, pa.int32())),
             one(pa.array(pairs % base, pa.int32())), one(pa.array(docs, pa.int64())),
             pa.array([zstandard.ZstdCompressor(level=1).compress(body)], pa.binary()), pa.array([len(body)], pa.int64())],
            names=["block", "ids", "n_a", "n_b", "n_groups", "n_links", "sha", "a", "b", "docs", "links", "raw"])


def _sides(paths: tuple[str, str]) -> Units:
    return Units((byte_side(paths[0]), piece_side(paths[1])))


def _to_blocks(paths: tuple[str, str], id_type: pa.DataType):
    def run(batches):
        units = common.held(("align", paths), lambda: _sides(paths))
        base = max(len(s.sizes) for s in units.sides)
        block = _Block()
        for part in common.slices(batches, size=SLICE_BYTES):
            column = common.column_of(part, "text")
            ids, counts = units.tokens(column.fill_null("").to_pylist())
            done = Alignment(ids, counts, units.sides)
            keys, times = done.pairs(base)
            block.names.append(common.column_of(part, "id"))
            block.columns.append((*counts, done.n_groups, done.n_links, done.digests()))
            block.codes.append(keys % (base * base))
            block.times.append(times)
            block.sizes.append(np.bincount(keys // (base * base), minlength=part.num_rows))
            block.bytes += column.nbytes
            if block.bytes >= BLOCK_BYTES:
                yield block.row(id_type, base)
                block = _Block()
        if block.names:
            yield block.row(id_type, base)
        block = done = None
        common.give_back()

    return run


def _count_links(id_type: pa.DataType, id_col: str):
    import zstandard

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: common.column_of(batch, c)[i] for c in batch.schema.names}
                body = zstandard.ZstdDecompressor().decompress(row["links"].as_py(), max_output_size=max(1, row["raw"].as_py()))
                ids = row["ids"].values
                sizes = np.frombuffer(body, "<u4", len(ids)).astype(np.int64)
                n = int(sizes.sum())
                place = np.frombuffer(body, "<u4", n, 4 * len(ids))
                times = np.frombuffer(body, "<u8", n, 4 * (len(ids) + n)).astype(np.int64)
                known = row["known"].values  # None where no document of the block has tokens
                count, best = np.zeros(0, np.int64), np.zeros(0, bool)
                if n:
                    at = known.field("pos").to_numpy()
                    count, best = np.empty(len(at), np.int64), np.empty(len(at), bool)
                    count[at] = known.field("count").to_numpy()
                    best[at] = known.field("best").to_numpy(zero_copy_only=False)
                ends = np.cumsum(sizes)
                sums = [np.concatenate(([0], np.cumsum(x, dtype=np.int64))) for x in (times * best[place], times * count[place])]
                n_best, total = (s[ends] - s[ends - sizes] for s in sums)
                yield pa.RecordBatch.from_arrays(
                    [ids, *(row[c].values for c in ("n_a", "n_b", "n_groups", "n_links")), pa.array(n_best), pa.array(total), row["sha"].values],
                    names=[id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
        common.give_back()

    return run


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, count, best): how many documents hold the id pair linked, and whether no pair of ``a`` has more."""
    counts = blocks.select(F.explode(F.arrays_zip("a", "b", "docs")).alias("e")).groupBy("e.a", "e.b").agg(F.sum("e.docs").alias("count"))
    counts = common.written(counts, "align-counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))  # at most one row per entry of the vocabulary
    return counts.join(F.broadcast(most), "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def align(docs: DataFrame, id_col: str = "doc_id", text: str = "text", tokenizers: tuple[str, str] | None = None) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of ``docs``.

    ``tokenizers`` names a byte-level JSON file (A) and a piece model that puts a space before the text (B)."""
    from pyspark.sql.pandas.types import to_arrow_type
    spark = docs.sparkSession
    common.ship_package(spark)
    kind = docs.schema[id_col].dataType
    id_type, longs = to_arrow_type(kind), ", ".join(f"{c} array<long>" for c in ("n_a", "n_b", "n_groups", "n_links"))
    schema = (f"block string, ids array<{kind.simpleString()}>, {longs}, sha array<string>, a array<int>, b array<int>, "
              "docs array<long>, links binary, raw long")
    made = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(
        _to_blocks(tokenizers or default_tokenizers(), id_type), schema)
    blocks = common.written(made, "align-blocks")
    pairs = blocks.select("block", F.posexplode(F.arrays_zip("a", "b")).alias("pos", "e")).select("block", "pos", "e.a", "e.b")
    known = (pairs.join(pair_counts(blocks), ["a", "b"]).groupBy("block")
             .agg(F.collect_list(F.struct("pos", "count", "best")).alias("known")))  # as many as the block's dictionary
    rows = blocks.drop("a", "b", "docs").join(known, "block", "left")
    out = (f"{id_col} {kind.simpleString()}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")
    return rows.mapInArrow(_count_links(id_type, id_col), out)


def op13(spark, sf_dir):
    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"))
