"""Token ids in patched frame-of-reference blocks.

File format.  A segment is one self-contained file image of at most ``SEGMENT_TOKENS`` ids (one
document more where a single document is larger); segments are the rows of a Parquet table written by
Spark, so that a lost executor repeats its tasks and half-written segments are never seen.

    segment   magic "PFB1", u32 ids, u32 documents, u32 blocks
    documents i64 id and u32 ids of each, with one null-id flag byte each
    index     u64 start of every block in the payload, and the end
    block     u32 minimum, u8 width, u8 exceptions, u16 values; then 128 values less the minimum,
              packed at ``width`` bits in 2 * width little-endian u64 words; then the
              exceptions: u8 place each, u32 high bits each

The width is that of the ``PERCENTILE`` largest offset of the block; what is wider keeps its low
bits in place and its high bits in the exception list.  The last block is filled up with its minimum.

Documents are written in ascending id order (null ids first, equal ids by their token bytes):
ranges of ids from percentiles of the id column alone, one shuffle of encoded documents,
then a sort inside each range.  Starts are running sums over segment headers, first within a range, then over ranges.

Edge cases: strings of special tokens inside texts get those tokens' ids, as the library gives them; null and
empty texts have no ids of their own, only the end id; an empty table writes an empty folder and reads as empty; columns of ``docs`` other than id and text are not written.
"""

from __future__ import annotations

import gc
import json
import re
import struct
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesprep.layout import shared_folder
from seriesprep.llm.byte_bpe import slices
from seriesprep.llm.common import query, shuffle_width, small, stage, table

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
BLOCK = 128
PERCENTILE = 0.92
SEGMENT_TOKENS = 250_000
CACHE_WORDS, CACHE_PRETOKENS = 40_000, 250_000  # of about 200 bytes; both are kept for two rounds
MAGIC = b"PFB1"


# ------------------------------------------------------------------- packing
def _pack(offsets: np.ndarray, width: int) -> np.ndarray:
    """(blocks, 128) offsets below 2**width to (blocks, 2 * width) words."""
    columns = np.ascontiguousarray(offsets.T)
    words = np.zeros((2 * width, offsets.shape[0]), np.uint64)
    for k in range(BLOCK):
        word, shift = divmod(k * width, 64)
        words[word] |= columns[k] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= columns[k] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    columns = np.ascontiguousarray(words.T)
    out = np.zeros((BLOCK, words.shape[0]), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for k in range(BLOCK if width else 0):
        word, shift = divmod(k * width, 64)
        value = columns[word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | columns[word + 1] << np.uint64(64 - shift)
        out[k] = value & mask
    return np.ascontiguousarray(out.T)


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits needed for each value below 2**53."""
    return np.frexp(x.astype(np.float64))[1].astype(np.int64)


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Block starts (with the end) and the payload of a run of unsigned 32-bit ids."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not blocks:
        return np.zeros(1, np.uint64), b""
    grid = np.empty(blocks * BLOCK, np.uint64)
    grid[:n] = ids
    last = grid[(blocks - 1) * BLOCK : n]
    grid[n:] = last.min()
    grid = grid.reshape(blocks, BLOCK)
    low = grid.min(axis=1)
    offsets = grid - low[:, None]
    pivot = np.partition(offsets, int(PERCENTILE * BLOCK), axis=1)[:, int(PERCENTILE * BLOCK)]
    width = _bits(pivot)
    high = offsets >> width[:, None].astype(np.uint64)
    patched = high > 0
    count = patched.sum(axis=1)
    values = np.full(blocks, BLOCK)
    values[-1] = len(last)
    lengths = 8 + 16 * width + 5 * count
    starts = np.concatenate(([0], np.cumsum(lengths)))
    out = np.zeros(starts[-1], np.uint8)

    def put(at: np.ndarray, parts: np.ndarray) -> None:
        """Write equally long byte rows at the given places."""
        if parts.size:
            out[at[:, None] + np.arange(parts.shape[1])] = parts

    head = np.zeros(blocks, np.dtype([("low", "<u4"), ("width", "u1"), ("count", "u1"), ("values", "<u2")]))
    head["low"], head["width"], head["count"], head["values"] = low, width, count, values
    put(starts[:-1], head.view(np.uint8).reshape(blocks, 8))
    for w in np.unique(width):
        if w:
            rows = np.flatnonzero(width == w)
            low_bits = offsets[rows] & np.uint64((1 << int(w)) - 1)
            put(starts[rows] + 8, _pack(low_bits, int(w)).astype("<u8").view(np.uint8).reshape(len(rows), -1))
    block, place = np.nonzero(patched)
    if len(block):
        nth = np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)
        base = starts[block] + 8 + 16 * width[block]
        out[base + nth] = place
        put(base + count[block] + 4 * nth, high[block, place].astype("<u4").view(np.uint8).reshape(-1, 4))
    return starts.astype("<u8"), out.tobytes()


def decode_blocks(starts: np.ndarray, payload: bytes) -> np.ndarray:
    """The ids of a run of blocks."""
    data = np.frombuffer(payload, np.uint8)
    blocks = len(starts) - 1
    if not blocks:
        return np.zeros(0, np.uint32)
    starts = starts.astype(np.int64)
    take = lambda at, size: data[at[:, None] + np.arange(size)]
    head = np.ascontiguousarray(take(starts[:-1], 8)).view(np.dtype([("low", "<u4"), ("width", "u1"), ("count", "u1"), ("values", "<u2")]))[:, 0]
    width, count = head["width"].astype(np.int64), head["count"].astype(np.int64)
    offsets = np.zeros((blocks, BLOCK), np.uint64)
    for w in np.unique(width):
        if w:
            rows = np.flatnonzero(width == w)
            words = np.ascontiguousarray(take(starts[rows] + 8, 16 * int(w))).view("<u8")
            offsets[rows] = _unpack(words, int(w))
    if count.sum():
        block = np.repeat(np.arange(blocks), count)
        nth = np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)
        base = starts[block] + 8 + 16 * width[block]
        high = np.ascontiguousarray(take(base + count[block] + 4 * nth, 4)).view("<u4")[:, 0]
        offsets[block, data[base + nth]] |= high.astype(np.uint64) << width[block].astype(np.uint64)
    values = offsets + head["low"].astype(np.uint64)[:, None]
    total = (blocks - 1) * BLOCK + int(head["values"][-1])
    return values.reshape(-1)[:total].astype(np.uint32)


def write_segment(docs: list[tuple[int | None, bytes]]) -> bytes:
    ids = np.frombuffer(b"".join(x for _, x in docs), "<u4")
    starts, payload = encode_blocks(ids)
    table_ = np.zeros(len(docs), np.dtype([("id", "<i8"), ("n", "<u4"), ("null", "u1")]))
    table_["id"] = [d or 0 for d, _ in docs]
    table_["n"] = [len(x) // 4 for _, x in docs]
    table_["null"] = [d is None for d, _ in docs]
    head = MAGIC + struct.pack("<III", len(ids), len(docs), len(starts) - 1)
    return head + table_.tobytes() + starts.tobytes() + payload


def read_segment(image: bytes) -> Iterator[tuple[int | None, int, bytes]]:
    """``(document id, start in the segment, ids)`` of every document."""
    if image[:4] != MAGIC:
        raise ValueError("not a token segment")
    _, documents, blocks = struct.unpack("<III", image[4:16])
    kind = np.dtype([("id", "<i8"), ("n", "<u4"), ("null", "u1")])
    table_ = np.frombuffer(image, kind, documents, 16)
    at = 16 + documents * kind.itemsize
    starts = np.frombuffer(image, "<u8", blocks + 1, at)
    ids = decode_blocks(starts, image[at + 8 * (blocks + 1) :])
    ends = np.cumsum(table_["n"].astype(np.int64))
    for row, end in zip(table_, ends.tolist()):
        first = end - int(row["n"])
        yield None if row["null"] else int(row["id"]), first, ids[first:end].tobytes()


# ------------------------------------------------------------------ encoding
class Pretokens(dict):
    """Pre-token to its ids, filled as pre-tokens turn up: from the table before this one, else by the library's merges."""

    def __init__(self, merge, letters: dict[int, str], older: Pretokens | None = None):
        self.merge, self.letters, self.older = merge, letters, older or {}
        if older is not None:
            older.older = {}

    def __missing__(self, pretoken: str) -> bytes:
        ids = self.older.get(pretoken)
        if ids is None:
            ids = array("I", [x.id for x in self.merge(pretoken.translate(self.letters))]).tobytes()
        self[pretoken] = ids
        return ids


class WordEncoder:
    """Ids of texts as the library encodes them, from bounded tables of parts.

    The tokenizer never joins anything across the cuts of its own pattern.  Latin-1 texts are cut by that pattern in one pass,
    and the library's model merges each new pre-token.  Of other
    texts, and of those with the string of a special token, the words go to the library one by one.
    """

    # The tokenizer's split pattern for Latin-1 text in lower case.
    LETTER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
    NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"

    def __init__(self, spec: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tk = Tokenizer.from_str(spec)
        # Latin-1 pre-tokens come in lower case and cut already: only the library's merges are left to do, on their
        # bytes written as letters.
        self.merge = self.tk.model.tokenize
        mapped = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.letters = {i: mapped(chr(i))[0][0] for i in range(256)}
        # Strings of special tokens stand for these, as the library has it, in any case of letters.
        self.special = [x["content"].lower() for x in json.loads(spec)["added_tokens"]]
        self.find = re.compile(f"[{self.LETTER}]+|'s|'t|'re|'ve|'m|'ll|'d|[{self.NUMBER}]|[^\t-\r {self.LETTER}{self.NUMBER}]+").findall
        self.plain = re.compile("[\t-\r !-~\xa1-\xac\xae-\xff]*+").fullmatch
        self.odd = re.compile("[\x1c-\x1f]").search
        self.cut = re.compile("[ \t\n\r\f\v]+").split
        self.words, self.older_words = {}, {}
        self.tokens = Pretokens(self.merge, self.letters)

    def _pretokens(self, text: str) -> list[str] | None:
        """The pre-tokens of a Latin-1 text; none of any other, nor of one with the string of a special token."""
        if not self.plain(text):
            return None
        lower = text.lower()
        return None if any(x in lower for x in self.special) else self.find(lower)

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            ids = self.older_words.get(word)
            if ids is None:
                ids = array("I", self.tk.encode(word, add_special_tokens=False).ids).tobytes()
            self.words[word] = ids
        return ids

    def encode(self, texts: list[str], end: bytes) -> list[bytes]:
        if len(self.words) > CACHE_WORDS:
            self.words, self.older_words = {}, self.words
        if len(self.tokens) > CACHE_PRETOKENS:
            self.tokens = Pretokens(self.merge, self.letters, self.tokens)
        gc.disable()  # nothing made here is cyclic
        try:
            get, word, out = self.tokens.__getitem__, self._word, []
            for text in texts:
                pretokens = self._pretokens(text)
                if pretokens is not None:
                    out.append(b"".join(map(get, pretokens)) + end)
                else:
                    out.append(b"".join(map(word, self.cut(text) if self.odd(text) else text.split())) + end)
            return out
        finally:
            gc.enable()


_READY: dict[int, WordEncoder] = {}


def _encoder(spec: str) -> WordEncoder:
    key = hash(spec)
    if key not in _READY:
        _READY.clear()
        _READY[key] = WordEncoder(spec)
    return _READY[key]


def encode(docs: DataFrame, path: str | None = None, end_id: int = END_ID, id_col="doc_id", text_col="text") -> DataFrame:
    """``(doc_id, ids)``: the ids of each text and the end id as little-endian unsigned 32-bit integers."""
    import public_tokenizers

    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(spec.value)
        for batch in batches:
            at = 0
            for texts in slices(batch["text"]):
                coded = pa.array(coder.encode(texts, end), pa.binary())
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(at, len(texts)), coded], ["doc_id", "ids"])
                at += len(texts)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids binary")


# ------------------------------------------------------------------- writing
def _ranges(ids: DataFrame, width: int) -> list[int]:
    """Limits of about ``width`` equal ranges of document ids."""
    steps = [i / width for i in range(1, width)]
    found = ids.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, steps)), 10_000)).first()[0] if steps else None
    return sorted(set(found or []))


def write(docs: DataFrame, path: str, **kw) -> None:
    """Encode ``docs`` and write segments in ascending id order under ``path``."""
    width = min(10_000, 4 * shuffle_width(docs.sparkSession))
    limits = _ranges(docs.select(F.col(kw.get("id_col", "doc_id")).cast("bigint").alias("doc_id")), width)
    coded = encode(docs, **kw)
    place = F.lit(0)
    if limits:  # binary search in a literal array keeps the plan small
        place = F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(F.lit(limits), lambda x: x <= F.col("doc_id"))))
    ordered = coded.withColumn("range", place.cast("int")).repartition(F.col("range")).sortWithinPartitions("range", F.col("doc_id").asc_nulls_first(), "ids")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, at, number = [], 0, None, 0

        def flush():
            tokens = sum(len(x) for _, x in held) // 4
            row = {"range": pa.array([at], pa.int32()), "segment": pa.array([number], pa.int32()), "tokens": [tokens], "documents": [len(held)], "data": [write_segment(held)]}
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for key, doc, ids in zip(batch["range"].to_pylist(), batch["doc_id"].to_pylist(), batch["ids"]):
                ids = ids.as_py()
                if held and (key != at or size + len(ids) > 4 * SEGMENT_TOKENS):
                    yield flush()
                    number, held, size = number + 1 if key == at else 0, [], 0
                elif not held and key != at:
                    number = 0
                at = key
                held.append((doc, ids))
                size += len(ids)
        if held:
            yield flush()

    schema = "range int, segment int, tokens bigint, documents bigint, data binary"
    ordered.mapInArrow(segments, schema).write.parquet(path)


def read(spark, path: str) -> DataFrame:
    """``(doc_id, start, ids)`` of every document of the written segments."""
    files = spark.read.schema("range int, segment int, tokens bigint, documents bigint, data binary").parquet(path)
    heads = files.select("range", "segment", "tokens")
    inside = Window.partitionBy("range").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    ranges = heads.groupBy("range").agg(F.sum("tokens").alias("tokens"))
    across = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    ranges = ranges.select("range", F.coalesce(F.sum("tokens").over(across), F.lit(0)).alias("base"))
    first = heads.select("range", "segment", F.coalesce(F.sum("tokens").over(inside), F.lit(0)).alias("first")).join(ranges, "range").select("range", "segment", (F.col("first") + F.col("base")).alias("first"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, image in zip(batch["first"].to_pylist(), batch["data"]):
                rows = list(read_segment(image.as_py()))
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "start": pa.array([first + r[1] for r in rows], pa.int64()), "ids": [r[2] for r in rows]})

    placed = files.select("range", "segment", "data").join(small(stage(first, "token-starts")), ["range", "segment"])
    return placed.select("first", "data").mapInArrow(documents, "doc_id bigint, start bigint, ids binary")


@query("op10_token_blocks")
def op10(spark, sf_dir):
    path = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write(table(spark, sf_dir, "documents"), path)
    return read(spark, path).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").cast("bigint").alias("ids_crc32"),
    )
