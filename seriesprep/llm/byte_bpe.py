"""Byte-level BPE through a sentencepiece model serialised directly from a rank vocabulary.

Every byte is mapped to one letter (``chr(256 + byte)``), a vocabulary entry becomes the string of
its letters, its score is the negative rank, and the model is written as a protobuf message with
an identity normaliser, so no training takes place and merging by best score equals merging by
lowest rank.  Text is cut into pre-tokens by the published pattern, each encoded on its own (a
pre-token that is itself an entry is taken as that entry); decoding maps ids back to letters and
letters to bytes.

Distinct pre-tokens repeat a lot, so a worker keeps a bounded table of those already encoded.
Cutting first at every space that is followed by a visible character keeps the pre-tokens as they are:
the pattern always gives such a space to what follows it.

Edge cases: null text is encoded as empty, to no ids; unknown ids raise; texts of any length are
encoded whole; other columns pass through, and an input column called like an output column
raises ``ValueError``.
"""

from __future__ import annotations

import base64
import gc
import re
import struct
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesprep.llm.common import give_back, query, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
CACHE_ENTRIES = 400_000  # of about 200 bytes


def read_ranks(path: str) -> list[bytes]:
    """Entries of a rank file, by rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    return [ranks[i] for i in range(len(ranks))]


def letters(token: bytes) -> str:
    return "".join(chr(256 + b) for b in token)


# ------------------------------------------------------------- model message
def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _field(number: int, value) -> bytes:
    """One protobuf field: bytes and str length-delimited, float fixed, int and bool varint."""
    if isinstance(value, str):
        value = value.encode()
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(int(value))


def serialise_model(tokens: list[bytes]) -> bytes:
    """The sentencepiece model: entries in rank order, then the unknown piece it insists on.

    Field numbers are those of the public ``sentencepiece_model.proto``: pieces 1 (piece 1, score 2,
    type 3), trainer_spec 2 (model_type 3: BPE is 2; unk_id 40, bos_id 41, eos_id 42, pad_id 43),
    normalizer_spec 3 (name 1, add_dummy_prefix 3, remove_extra_whitespaces 4, escape_whitespaces 5).
    """
    pieces = [_field(1, letters(t)) + _field(2, float(-i)) + _field(3, 1) for i, t in enumerate(tokens)]
    pieces.append(_field(1, "<unk>") + _field(2, 0.0) + _field(3, 2))
    none = (1 << 64) - 1  # -1
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, len(tokens)) + _field(41, none) + _field(42, none) + _field(43, none)
    normaliser = _field(1, "identity") + _field(3, False) + _field(4, False) + _field(5, False)
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normaliser)


# ------------------------------------------------------------------- encoder
class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids and back."""

    def __init__(self, model: bytes, pattern: str):
        import regex
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.unknown = self.sp.unk_id()
        self.pieces = [bytes(ord(c) - 256 for c in self.sp.id_to_piece(i)) for i in range(self.unknown)]
        self.whole = {t: struct.pack("<I", i) for i, t in enumerate(self.pieces)}
        self.find = regex.compile(pattern).findall
        self.visible = re.compile(r" (?=\S)")
        self.loose = re.compile(r" (?!\S)")
        self.first, self.later, self.tokens = {}, {}, {}

    def _pretokens(self, words: list[str]) -> None:
        """Encode pre-tokens that are in no table yet."""
        todo, raws = [], []
        for w in words:
            raw = w.encode()
            ids = self.whole.get(raw)
            if ids is None:
                todo.append(w)
                raws.append(raw)
            else:
                self.tokens[w] = ids
        if todo:
            shifted = (np.frombuffer(b"".join(raws), np.uint8).astype("<u2") + 256).tobytes().decode("utf-16-le")
            ends = list(accumulate(map(len, raws)))
            coded = self.sp.encode([shifted[a:b] for a, b in zip([0, *ends], ends)], num_threads=1)
            if any(self.unknown in ids for ids in coded):
                raise ValueError("a byte is missing in the vocabulary")
            self.tokens.update(zip(todo, [array("I", ids).tobytes() for ids in coded]))

    def _heads(self, parts: list[str]) -> None:
        split = [self.find(p) for p in parts]
        self._pretokens(list({t for ts in split for t in ts} - self.tokens.keys()))
        for p, ts in zip(parts, split):
            self.first[p] = b"".join(map(self.tokens.__getitem__, ts))

    def _rest(self, parts: list[str]) -> None:
        """The parts after a space: found together, as only their first pre-token has that space in front."""
        if not parts:
            return
        found = self.find(" " + " ".join(parts))
        self._pretokens(list(set(found) - self.tokens.keys()))
        ids = list(map(self.tokens.__getitem__, found))
        starts = [i for i, t in enumerate(found) if t[0] == " " and len(t) > 1]
        if len(starts) != len(parts):  # a part that holds spaces of its own
            self.later.update((p, b"".join(map(self.tokens.__getitem__, self.find(" " + p)))) for p in parts)
            return
        starts.append(len(found))
        self.later.update(zip(parts, [ids[a] if b - a == 1 else b"".join(ids[a:b]) for a, b in zip(starts, starts[1:])]))

    def forget(self) -> None:
        """Empty the tables: a worker keeps none of them from one task to the next."""
        self.first, self.later, self.tokens = {}, {}, {}

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.first) + len(self.later) + len(self.tokens) > CACHE_ENTRIES:
            self.forget()
        gc.disable()  # nothing made here is cyclic
        try:
            split = [t.split(" ") if not self.loose.search(t) else self.visible.split(t) for t in texts]
            self._heads(list({s[0] for s in split} - self.first.keys()))
            rest = set()
            for s in split:
                rest.update(s[1:])
            self._rest(list(rest - self.later.keys()))
            get = self.later.__getitem__
            return [self.first[s[0]] + b"".join(map(get, s[1:])) for s in split]
        finally:
            gc.enable()

    def decode(self, ids: bytes) -> bytes:
        numbers = np.frombuffer(ids, "<u4")
        if len(numbers) and numbers.max() >= self.unknown:
            raise ValueError("id outside the vocabulary")
        return b"".join(map(self.pieces.__getitem__, numbers.tolist()))


_READY: dict[int, Encoder] = {}


def _encoder(model: bytes, pattern: str) -> Encoder:
    """One encoder per worker process and model."""
    key = hash((model, pattern))
    if key not in _READY:
        _READY.clear()
        _READY[key] = Encoder(model, pattern)
    return _READY[key]


def vocabulary(path: str | None = None, pattern: str | None = None) -> tuple[bytes, str]:
    """The serialised model and the pattern; both are a few MB at most and read on the driver only."""
    import public_tokenizers

    return serialise_model(read_ranks(path or public_tokenizers.path(VOCABULARY))), pattern or public_tokenizers.PATTERN


def slices(texts: pa.Array, size: int = 1_000_000) -> Iterator[list[str]]:
    """The texts of an Arrow batch, about ``size`` bytes at a time; a longer text comes alone."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield texts.slice(start, stop - start).to_pylist()
        start = stop


def _added(docs: DataFrame, out: str) -> None:
    if out in docs.columns:
        raise ValueError(f"the table already has a column {out}")


def encode(docs: DataFrame, model: bytes, pattern: str, text_col="text", out="ids") -> DataFrame:
    """Add ``out``: the ids of the text as little-endian unsigned 32-bit integers."""
    _added(docs, out)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("binary")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = _encoder(shared.value, pattern)
        for batch in batches:
            yield pa.concat_arrays([pa.array([], pa.binary()), *[pa.array(coder.encode(t), pa.binary()) for t in slices(batch)]])
        coder.forget()

    return docs.withColumn(out, ids(F.coalesce(F.col(text_col), F.lit(""))))


def decode(rows: DataFrame, model: bytes, pattern: str, ids_col="ids", out="decoded") -> DataFrame:
    """Add ``out``: the bytes that the ids stand for; null for null."""
    _added(rows, out)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("binary")
    def raw(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = _encoder(shared.value, pattern)
        for batch in batches:
            yield pa.array([None if x is None else coder.decode(x) for x in batch.to_pylist()], pa.binary())

    return rows.withColumn(out, raw(F.col(ids_col)))


def encode_and_decode(docs: DataFrame, model: bytes, pattern: str, text_col="text", out="coded") -> DataFrame:
    """Add the struct ``out`` of ``ids`` and the bytes ``decoded`` from them, in one pass of one worker."""
    _added(docs, out)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["ids", "decoded"]

    @F.arrow_udf("ids binary, decoded binary")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = _encoder(shared.value, pattern)
        for batch in batches:
            done = [pa.StructArray.from_arrays([pa.array([], pa.binary())] * 2, names)]
            for texts in slices(batch):
                ids = coder.encode(texts)
                done.append(pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array([coder.decode(x) for x in ids], pa.binary())], names))
            yield pa.concat_arrays(done)
        coder.forget()

    return docs.withColumn(out, both(F.coalesce(F.col(text_col), F.lit(""))))


def encode_checked(docs: DataFrame, model: bytes, pattern: str, text_col="text", out="coded") -> DataFrame:
    """Add the struct ``out`` of ``ids`` and ``round_trip``: whether they decode to the text.  The decoded bytes never leave the worker."""
    _added(docs, out)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["ids", "round_trip"]

    @F.arrow_udf("ids binary, round_trip boolean")
    def checked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        give_back()  # what earlier stages left in this worker
        coder = _encoder(shared.value, pattern)
        for batch in batches:
            done = [pa.StructArray.from_arrays([pa.array([], pa.binary()), pa.array([], pa.bool_())], names)]
            for texts in slices(batch):
                ids = coder.encode(texts)
                intact = [coder.decode(x) == t.encode() for x, t in zip(ids, texts)]
                done.append(pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(intact, pa.bool_())], names))
            yield pa.concat_arrays(done)
        coder.forget()
        give_back()

    return docs.withColumn(out, checked(F.coalesce(F.col(text_col), F.lit(""))))


@query("op1_byte_bpe")
def op1(spark, sf_dir):
    model, pattern = vocabulary()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_and_decode(docs, model, pattern).select("doc_id", "coded.*")
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
