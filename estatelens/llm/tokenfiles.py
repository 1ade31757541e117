"""Token ids as binary files of compressed byte planes.

A chunk holds the ids of consecutive documents.  Its ids are cut into blocks of
``BLOCK`` ids; each block is transposed into its four byte planes, and each plane
is packed with zstandard alone.  The chunk starts with its index:

    magic 4s, version u32, block size u32, documents u32, ids u64, blocks u32
    ids of each document       u64 each
    packed size of each plane  u32 each, four per block, lowest byte first
    the packed planes

Chunks are rows of a Parquet table in document order: part, place in the part,
ids of the part before the chunk, ids in it, document ids and the chunk itself.
"""

from __future__ import annotations

import json
import os
import struct
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelens.llm import common

MAGIC, VERSION, HEAD = b"TPLN", 1, "<4sIIIQI"
BLOCK = 1 << 16
CHUNK_IDS = 1 << 20
END_ID = 2
#: Words whose ids a worker remembers.
CACHE_WORDS = 800_000
#: Bytes of text whose words are held at once (a longer document is a slice of its own).
SLICE_BYTES = 1 << 20
#: Bytes of the longest word whose ids are remembered.
LONGEST_KNOWN = 256
_TAIL = ".,!?;:#$%&*"
_MARKS = _TAIL.encode()
_IS_MARK, _IS_LETTER = np.zeros((2, 256), bool)
_IS_MARK[list(_MARKS)] = True
_IS_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
#: First character behind the Latin blocks, whose letters and cases are the same in all Unicode versions in use.
_LATIN_END = "\u0250"
#: Fixed value: how a tokenizer that drops white space cuts words (its first pre-tokenizer).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# ------------------------------------------------------------------------ format

def pack_chunk(lengths: np.ndarray, ids: np.ndarray, block: int = BLOCK, level: int = 3) -> bytes:
    """One chunk of documents with ``lengths`` ids each; ``ids`` are unsigned 32-bit."""
    import zstandard
    packer = zstandard.ZstdCompressor(level=level)
    planes = []
    for at in range(0, len(ids), block):
        raw = ids[at:at + block].astype("<u4").view(np.uint8).reshape(-1, 4)
        planes += [packer.compress(np.ascontiguousarray(raw[:, p]).tobytes()) for p in range(4)]
    head = struct.pack(HEAD, MAGIC, VERSION, block, len(lengths), len(ids), len(planes) // 4)
    sizes = np.array([len(p) for p in planes], "<u4").tobytes()
    return b"".join([head, lengths.astype("<u8").tobytes(), sizes, *planes])


def unpack_chunk(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, ids) of one chunk."""
    import zstandard
    magic, version, block, docs, total, blocks = struct.unpack_from(HEAD, raw)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a chunk of token planes")
    at = struct.calcsize(HEAD)
    lengths = np.frombuffer(raw, "<u8", docs, at).astype(np.int64)
    sizes = np.frombuffer(raw, "<u4", 4 * blocks, at + 8 * docs).tolist()
    at += 8 * docs + 16 * blocks
    unpacker, ids = zstandard.ZstdDecompressor(), np.empty(total, "<u4")
    view = ids.view(np.uint8).reshape(-1, 4)
    for b in range(blocks):
        n = min(block, total - b * block)
        for p in range(4):
            plane = unpacker.decompress(raw[at:at + sizes[4 * b + p]], max_output_size=n)
            view[b * block:b * block + n, p] = np.frombuffer(plane, np.uint8)
            at += sizes[4 * b + p]
    return lengths, ids


# ---------------------------------------------------------------------- encoding

def drops_white_space(definition: dict) -> bool:
    """Whether a tokenizer cuts lower-cased words by ``WORD_PATTERN`` alone, so that white space only parts them."""
    steps = (definition.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    folds = [n.get("type") for n in (definition.get("normalizer") or {}).get("normalizers") or []]
    return (steps[0].get("pattern") == {"Regex": WORD_PATTERN} and steps[0].get("invert") is True
            and steps[0].get("behavior") == "Removed" and [x["type"] for x in steps[1:]] == ["ByteLevel"]
            and steps[1].get("use_regex") is False and not steps[1].get("add_prefix_space")
            and folds == ["NFC", "Replace", "Lowercase"] and definition.get("post_processor") is None
            and not any(definition.get(x) for x in ("truncation", "padding"))
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or len(t["content"].split()) != 1
                        for t in definition.get("added_tokens") or []))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _byte_characters() -> list[str]:
    """The character that byte-level tokens have for each byte: visible ones stand for themselves."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]


class WordIds(dict):
    """Ids of words, found when first asked for and remembered.

    Words of Latin letters, marks behind them or not, go straight to the
    tokenizer's merges: they are one token to be merged, whatever the Unicode
    version.  Any other word is encoded whole by the library."""

    def __init__(self, tokenizer):
        self.encode, self.merges = tokenizer.encode, tokenizer.model.tokenize
        self.spelling = dict(enumerate(_byte_characters()))

    def __missing__(self, word: bytes) -> bytes:
        if word.isalpha():  # letters a-z alone
            ids = self._merged(word.lower().decode("ascii"))
        else:
            core = word.rstrip(_MARKS)
            letters = unicodedata.normalize("NFC", core.decode("utf-8", "replace")).lower()
            if letters.isalpha() and max(letters) < _LATIN_END:
                ids = self._merged(letters.encode().decode("latin-1").translate(self.spelling))
                if core != word:
                    ids += self[word[len(core):]]
            else:
                ids = _packed(self.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids)
        if len(word) <= LONGEST_KNOWN:
            self[word] = ids
        return ids

    def _merged(self, letters: str) -> bytes:
        return _packed([t.id for t in self.merges(letters)])


class Encoder:
    """Ids of whole texts, those of the library.

    Where white space only parts tokens, a text's ids are those of its pieces
    between white space (:class:`WordIds`).  A mark behind a letter a-z always
    begins a token, so it is parted from it, and A-Z is lower-cased first unless
    a text holds combining marks (which may join small letters only) or an added
    token.  Any other tokenizer gets the whole texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        definition = json.loads(self.tokenizer.to_str())
        self.by_word = drops_white_space(definition)
        self.known = WordIds(self.tokenizer)
        added = [t["content"].encode() for t in definition.get("added_tokens") or []]
        self.case_matters = [b"\xcc", b"\xcd", *(x.lower() for x in added)]
        self.parts_marks = not any(m in x for x in added for m in _MARKS)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if not self.by_word:
            whole = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
            return [_packed(one.ids) for one in whole]
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        ids = self.known.__getitem__
        return [b"".join(map(ids, self._pieces(t))) for t in texts]

    def _pieces(self, text: bytes) -> list[bytes]:
        low = text.lower()
        if any(x in low for x in self.case_matters):
            low = text
        if self.parts_marks:
            raw = np.frombuffer(low, np.uint8)
            at = np.flatnonzero(_IS_MARK[raw[1:]] & _IS_LETTER[raw[:-1]]) + 1
            low = np.insert(raw, at, 0x20).tobytes()
        return low.split()


def _write_chunks(tokenizer: str, id_col: str, id_type: pa.DataType, end_id: int, chunk_ids: int, block: int):
    end = struct.pack("<I", end_id)

    def run(batches):
        from pyspark import TaskContext
        encoder = common.held(("tokens", tokenizer), lambda: Encoder(tokenizer))
        part, place, before = TaskContext.get().partitionId(), 0, 0
        names: list = []
        held: list[bytes] = []
        size = 0

        def chunk():
            nonlocal place, before, names, held, size
            lengths = np.array([len(x) // 4 for x in held], np.int64)
            ids = np.frombuffer(b"".join(held), "<u4")
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([place], pa.int32()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.array([names], pa.list_(id_type)), pa.array([pack_chunk(lengths, ids, block)], pa.binary())],
                names=["part", "place", "before", "count", "ids", "chunk"])
            place, before = place + 1, before + len(ids)
            names, held, size = [], [], 0
            return row

        for piece in common.slices(batches, size=SLICE_BYTES):
            buf, off = common.text_buffer(common.column_of(piece, "text"))
            raw = buf.tobytes()
            found = encoder.encode([raw[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist())])
            for name, ids in zip(common.column_of(piece, id_col).to_pylist(), found):
                names.append(name)
                held.append(ids + end)
                size += len(ids) // 4 + 1
                if size >= chunk_ids:
                    yield chunk()
        if held:
            yield chunk()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text: str = "text",
                 end_id: int = END_ID, chunk_ids: int = CHUNK_IDS, block: int = BLOCK) -> None:
    """Write the ids of ``docs`` in ascending id order (null first, repeated ids by text) as chunks under ``path``.

    Null text is empty and has the end id alone."""
    spark = docs.sparkSession
    common.ship_package(spark)
    mark = F.xxhash64("text")
    ordered = (docs.select(F.col(id_col), F.coalesce(F.col(text), F.lit("")).alias("text"))
               .repartitionByRange(common.shuffle_partitions(spark), F.col(id_col), mark)
               .sortWithinPartitions(F.col(id_col), mark, "text"))
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    schema = f"part int, place int, before long, count long, ids array<{docs.schema[id_col].dataType.simpleString()}>, chunk binary"
    chunks = ordered.mapInArrow(_write_chunks(tokenizer, id_col, id_type, end_id, chunk_ids, block), schema)
    chunks.write.option("compression", "none").parquet(path)


def read_tokens(spark, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) per document, from the files alone."""
    common.ship_package(spark)
    chunks = spark.read.parquet(path)
    id_type = chunks.schema["ids"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: common.column_of(batch, c)[i] for c in ("part", "before", "ids", "chunk")}
                lengths, ids = unpack_chunk(row["chunk"].as_py())
                ends = np.cumsum(lengths)
                raw = memoryview(ids.view(np.uint8))
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([
                    row["ids"].values, pa.array(np.full(len(lengths), row["part"].as_py(), np.int32)),
                    pa.array(row["before"].as_py() + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())],
                    names=["id", "part", "at", "n_tokens", "ids_crc32"])
        common.give_back()

    docs = chunks.mapInArrow(run, f"id {id_type}, part int, at long, n_tokens long, ids_crc32 long")
    # one row per part
    totals = chunks.groupBy("part").agg(F.sum("count").alias("n"))
    starts = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("first"))
    return docs.join(starts, "part").select(F.col("id").alias(id_col), (F.col("first") + F.col("at")).alias("start"),
                                            "n_tokens", "ids_crc32")


def encoded(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the ids of ``docs`` and return what the files hold of each document."""
    spark = docs.sparkSession
    path = common.new_path(spark, "tokens")
    write_tokens(docs, path, tokenizer or default_tokenizer())
    return common.written(read_tokens(spark, path), "token-index")


def op10(spark, sf_dir):
    return encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"))
