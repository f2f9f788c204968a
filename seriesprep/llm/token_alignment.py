"""Alignment of the tokens of two tokenizers over the same bytes.

Both token sequences cut the same byte string.  Every token points to the farthest-right token of the other side
that overlaps it; a token that ends where its partner ends is terminal.  Doubling the successors of all tokens
of a slice of documents at once (``succ = succ[succ]``) leads each to its component's terminal token, which labels the group.

Links are the pairs of overlapping token occurrences.  How often an id pair is linked over the corpus is
counted in chunks of documents: a chunk deals its distinct pairs with their counts to buckets by the id of the second
tokenizer, a bucket sums them (its table is bounded by the vocabularies, whatever the corpus) and answers every chunk in
the same order, and the chunk adds up the answers of its links.  A frequent pair is one entry of a chunk, never a hot key.

Edge cases: null and empty texts, and texts that either tokenizer doesn't reproduce byte for byte, have no tokens
and zeros; strings of special tokens are plain text; rows with equal or null ids are rows of their own; a text
of any length is one chunk at most; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesprep.llm.byte_bpe import slices
from seriesprep.llm.common import give_back, query, stage, table, text_or_empty

BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK_LINKS = 600_000
PIECE_LINKS = 100_000  # rows of the table stay small, whatever a chunk holds
DOCUMENT_LINKS = 20  # a document weighs so much more than its links
SLICE_BYTES = 250_000
BUCKETS = 512  # a bucket holds the pairs of 1 in BUCKETS ids of the second tokenizer
MERGE_PAIRS = 2_000_000


# ---------------------------------------------------------------- tokenizers
def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 as it is, others from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Side:
    """One tokenizer: ids of texts, and the bytes of every id."""

    def __init__(self, entries: list[bytes]):
        self.bytes = entries
        self.lengths = np.array([len(b) for b in entries], np.int64)

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


class ByteSide(Side):
    """Latin texts without very long runs are encoded by ranks, which gives the same ids several times faster."""

    # The published split pattern of byte-level vocabularies.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    LATIN = re.compile("[\0-\u024f]*").fullmatch
    LONG_RUN = re.compile(r"\s{400}|\S{2000}").search

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks
        import tiktoken

        self.spec, self.tk = spec, None
        parts = json.loads(spec)
        byte = byte_letters()
        names = {i: t for t, i in parts["model"]["vocab"].items()}
        special = {x["id"]: x["content"] for x in parts["added_tokens"]}
        names.update(special)
        super().__init__([bytes(byte[c] for c in names[i]) if i in names and i not in special else names.get(i, "").encode() for i in range(max(names) + 1)])
        ranks = {self.bytes[i]: i for i in names if i not in special}
        # Ranks say all there is only if every merge makes the next id and nothing else changes the text.
        merged = [ranks[b"".join(bytes(byte[c] for c in x) for x in (m.split(" ") if isinstance(m, str) else m))] for m in parts["model"]["merges"]]
        plain = parts["normalizer"] is None and parts["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self.by_rank = tiktoken.Encoding("ranks", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={}) if plain and merged == sorted(merged) else None

    def library(self):
        """The tokenizer itself, loaded when a text needs it."""
        if self.tk is None:
            from tokenizers import Tokenizer

            self.tk = Tokenizer.from_str(self.spec)
            self.tk.encode_special_tokens = True
        return self.tk

    def encode(self, texts: list[str]) -> list[list[int]]:
        out: list = [self.by_rank.encode_ordinary(" " + t) if self.by_rank and self.LATIN(t) and not self.LONG_RUN(t) else None for t in texts]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, e in zip(rest, self.library().encode_batch_fast([" " + texts[i] for i in rest], add_special_tokens=False) if rest else ()):
            out[i] = e.ids
        return out


class PieceSide(Side):
    def __init__(self, model: bytes):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        byte = re.compile("<0x([0-9A-F]{2})>").fullmatch
        super().__init__([bytes.fromhex(m[1]) if (m := byte(p)) else p.replace("▁", " ").encode() for p in pieces])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.sp.encode(texts, num_threads=1)


# ----------------------------------------------------------------- alignment
def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For all tokens of both sides, A first, the number of the B token that ends their component."""
    n = len(ends_a)
    over_a, over_b = np.searchsorted(ends_a, ends_b), np.searchsorted(ends_b, ends_a)
    own = np.arange(n, n + len(ends_b))
    succ = np.concatenate((over_b + n, np.where(ends_a[over_a] > ends_b, over_a, own)))
    while (further := succ[succ]).tobytes() != succ.tobytes():
        succ = further
    return succ - n


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token numbers and end of every overlap, in order: one for each stretch between two neighbouring ends."""
    ends = np.sort(np.concatenate((ends_a, ends_b)), kind="stable")
    ends = ends[np.diff(ends, prepend=0) > 0]
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends), ends


class Writer:
    """Groups as text: ``a1,a2|b1;a3|b2,b3``, from a table of every id with each separator."""

    def __init__(self, ids: int):
        width = len(str(ids)) + 1
        names = [f"{i}{s}".encode() for i in range(ids) for s in ",|;"]
        self.lengths = np.array([len(x) for x in names])
        self.table = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in names), np.uint8).reshape(-1, width)

    def write(self, a: np.ndarray, b: np.ndarray, label_a: np.ndarray, label_b: np.ndarray, docs_b: np.ndarray) -> list[bytes]:
        """One text per document; ``docs_b`` are the B token counts up to each document's end."""
        last = np.flatnonzero(np.diff(label_b, append=-1))  # of every group, on the B side
        group_ends_a = np.searchsorted(label_a, label_b[last], "right")
        sizes_a, sizes_b = np.diff(group_ends_a, prepend=0), np.diff(last + 1, prepend=0)
        codes = np.empty(len(a) + len(b), np.int64)
        place_a = np.arange(len(a)) + np.repeat(last + 1 - sizes_b, sizes_a)
        place_b = np.arange(len(b)) + np.repeat(group_ends_a, sizes_b)
        codes[place_a], codes[place_b] = 3 * a, 3 * b
        codes[place_a[group_ends_a - 1]] += 1
        codes[place_b[last]] += 2
        raw = self.table[codes].ravel()
        raw = raw[raw > 0].tobytes()
        ends = np.cumsum(self.lengths[codes])[place_b[docs_b - 1]].tolist()
        return [raw[x : y - 1] for x, y in zip([0, *ends], ends)]


@dataclass
class Aligned:
    """Documents of a slice: counts of each, the groups as text, and the linked ids of all links in order."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[bytes]
    linked_a: np.ndarray
    linked_b: np.ndarray


def aligned(texts: list[str], a: Side, b: Side, writer: Writer) -> Aligned:
    """Align the tokens of all texts at once; texts without tokens have zeros."""
    ids_a, ids_b = a.encode(texts), b.encode(texts)
    for k, text in enumerate(texts):
        raw = b" " + text.encode("utf-8", "surrogatepass")
        if not text or a.joined(ids_a[k]) != raw or b.joined(ids_b[k]) != raw:
            ids_a[k], ids_b[k] = [], []
    n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
    flat_a, flat_b = (np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())) for ids, n in ((ids_a, n_a), (ids_b, n_b)))
    out = Aligned(n_a, n_b, np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), [b""] * len(texts), flat_a[:0], flat_b[:0])
    full = np.flatnonzero(n_a)
    if not len(full):
        return out
    ends_a, ends_b = np.cumsum(a.lengths[flat_a]), np.cumsum(b.lengths[flat_b])
    docs_b = np.cumsum(n_b[full])
    stops = ends_b[docs_b - 1]
    label = terminals(ends_a, ends_b)
    label_a, label_b = label[: len(flat_a)], label[len(flat_a) :]
    terminal = np.flatnonzero(label_b == np.arange(len(flat_b)))
    at_a, at_b, ends = links(ends_a, ends_b)
    out.n_groups[full] = np.diff(np.searchsorted(terminal, docs_b), prepend=0)
    out.n_links[full] = np.diff(np.searchsorted(ends, stops, "right"), prepend=0)
    out.linked_a, out.linked_b = flat_a[at_a], flat_b[at_b]
    for k, text in zip(full.tolist(), writer.write(flat_a, flat_b, label_a, label_b, docs_b)):
        out.groups[k] = text
    return out


def _sides(shared) -> tuple[Side, Side, Writer]:
    a, b = ByteSide(shared.value[0]), PieceSide(shared.value[1])
    return a, b, Writer(max(len(a.bytes), len(b.bytes)))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))


def groups(docs: DataFrame, spec: str, model: bytes, id_col="doc_id", text_col="text") -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, groups)``: the alignment of every row as text."""
    shared = docs.sparkSession.sparkContext.broadcast((spec, model))  # two vocabulary files

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(shared)
        for batch in batches:
            at = 0
            for texts in slices(batch["text"], SLICE_BYTES):
                x = aligned(texts, *sides)
                columns = [batch["doc_id"].slice(at, len(texts)), x.n_a, x.n_b, x.n_groups, x.n_links, [g.decode() for g in x.groups]]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"])
                at += len(texts)

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string")


# -------------------------------------------------------------------- counts
FACTS = np.dtype([("id", "<i8"), ("null", "u1"), ("n_a", "<i8"), ("n_b", "<i8"), ("n_groups", "<i8"), ("n_links", "<i8"), ("sha", "V32")])


def _bucket(code: np.ndarray, size_a: int) -> np.ndarray:
    return (code // size_a % BUCKETS).astype(np.int64)


def _chunk_rows(chunk: int, facts: list, parts: list[np.ndarray], size_a: int) -> Iterator[pa.RecordBatch]:
    """One row about the documents of a chunk, rows with pieces of their links, and a row per bucket of its distinct pairs."""
    code = np.concatenate(parts)
    distinct, place, n = np.unique(code, return_inverse=True, return_counts=True)
    bucket = _bucket(distinct, size_a)
    order = np.argsort(bucket, kind="stable")  # by bucket, then by pair: the order in which answers come back
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    place = rank[place]
    distinct, n, bucket = distinct[order], n[order].astype("<u4"), bucket[order]
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    stops = [*starts[1:].tolist(), len(bucket)]
    spans = list(zip(starts.tolist(), stops))
    pieces = [place[x : x + PIECE_LINKS] for x in range(0, len(place), PIECE_LINKS)]
    # Two planes of 16 bits, as the upper one compresses well.
    planes = [(x & np.uint32(0xFFFF)).astype("<u2").tobytes() + (x >> np.uint32(16)).astype("<u2").tobytes() for x in pieces]
    yield pa.RecordBatch.from_pydict({
        "kind": pa.array([0] * (1 + len(pieces)) + [1] * len(spans), pa.int32()),
        "chunk": pa.array([chunk] * (1 + len(pieces) + len(spans)), pa.int64()),
        "bucket": pa.array([*range(-1 - len(pieces), 0), *bucket[starts].tolist()], pa.int32()),
        "pairs": pa.array([np.concatenate(facts).tobytes(), *[None] * len(pieces), *(distinct[x:y].tobytes() for x, y in spans)], pa.binary()),
        "data": pa.array([None, *planes, *(n[x:y].tobytes() for x, y in spans)], pa.binary()),
    })


ROWS = "kind int, chunk bigint, bucket int, pairs binary, data binary"


def _code_type(size_a: int, size_b: int) -> str:
    return "<u4" if size_a * size_b <= 1 << 32 else "<u8"


def _chunks(docs: DataFrame, shared) -> DataFrame:
    """Chunk rows of all documents (kind 0: documents and links, 1: distinct pairs of a bucket)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, writer = _sides(shared)
        size_a = len(a.bytes)
        dtype = _code_type(size_a, len(b.bytes))
        chunk = TaskContext.get().partitionId() << 24
        facts: list = []
        parts: list[np.ndarray] = []
        held = 0
        for batch in batches:
            names, at = batch["doc_id"].to_pylist(), 0
            for texts in slices(batch["text"], SLICE_BYTES):
                x = aligned(texts, a, b, writer)
                about = np.zeros(len(texts), FACTS)
                ids = names[at : at + len(texts)]
                at += len(texts)
                about["id"], about["null"] = [i or 0 for i in ids], [i is None for i in ids]
                for name in ("n_a", "n_b", "n_groups", "n_links"):
                    about[name] = getattr(x, name)
                about["sha"] = np.frombuffer(b"".join(hashlib.sha256(g).digest() for g in x.groups), "V32")
                facts.append(about)
                parts.append((x.linked_b.astype(dtype) * np.array(size_a, dtype) + x.linked_a.astype(dtype)).astype(dtype))
                held += len(parts[-1]) + DOCUMENT_LINKS * len(texts)
                if held > CHUNK_LINKS:
                    yield from _chunk_rows(chunk, facts, parts, size_a)
                    chunk, facts, parts, held = chunk + 1, [], [], 0
        if facts:
            yield from _chunk_rows(chunk, facts, parts, size_a)
        del a, b, writer, facts, parts
        give_back()

    return docs.mapInArrow(run, ROWS)


def _totals(blocks: DataFrame, size_a: int, dtype: str) -> DataFrame:
    """Per bucket one row: its distinct pairs, and twice their counts, plus one where it is the highest of the B id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, codes, counts, held = None, [], [], 0

        def merged():
            code, n = np.concatenate(codes), np.concatenate(counts)
            distinct, place = np.unique(code, return_inverse=True)
            total = np.zeros(len(distinct), np.int64)
            np.add.at(total, place, n)
            return distinct, total

        def flush():
            code, total = merged()
            starts = np.flatnonzero(np.diff((code // size_a).astype(np.int64), prepend=-1))
            highest = np.repeat(np.maximum.reduceat(total, starts), np.diff(np.append(starts, len(code))))
            row = {"kind": [0], "chunk": [-1], "bucket": [now], "pairs": [code.tobytes()], "data": [(2 * total + (total == highest)).astype("<i8").tobytes()]}
            yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("kind", pa.int32()), ("chunk", pa.int64()), ("bucket", pa.int32()), ("pairs", pa.binary()), ("data", pa.binary())]))

        for batch in batches:
            for bucket, pairs, data in zip(batch["bucket"].to_pylist(), batch["pairs"], batch["data"]):
                if now is not None and bucket != now:
                    yield from flush()
                    codes, counts, held = [], [], 0
                now = bucket
                codes.append(np.frombuffer(pairs.as_py(), dtype))
                counts.append(np.frombuffer(data.as_py(), "<u4").astype(np.int64))
                held += len(codes[-1])
                if held > MERGE_PAIRS:
                    code, total = merged()
                    codes, counts, held = [code], [total], 0  # bounded by the pairs of the bucket
        if now is not None:
            yield from flush()

    return blocks.repartition(F.col("bucket")).sortWithinPartitions("bucket").mapInArrow(run, ROWS)


def _answers(totals: DataFrame, blocks: DataFrame, dtype: str) -> DataFrame:
    """Every block of a chunk with the totals of its pairs; the bucket's totals come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = total = np.zeros(0, np.int64)
        for batch in batches:
            chunk, bucket, out = [], [], []
            for k, c, b, pairs, data in zip(*(batch[x].to_pylist() for x in ("kind", "chunk", "bucket", "pairs", "data"))):
                if k == 0:
                    known, total = np.frombuffer(pairs, dtype), np.frombuffer(data, "<i8")
                else:
                    chunk.append(c)
                    bucket.append(b)
                    out.append(total[np.searchsorted(known, np.frombuffer(pairs, dtype))].tobytes())
            yield pa.RecordBatch.from_pydict({
                "kind": pa.array([1] * len(out), pa.int32()), "chunk": pa.array(chunk, pa.int64()), "bucket": pa.array(bucket, pa.int32()),
                "pairs": pa.nulls(len(out), pa.binary()), "data": pa.array(out, pa.binary()),
            })

    rows = totals.unionByName(blocks)
    return rows.repartition(F.col("bucket")).sortWithinPartitions("bucket", "kind").mapInArrow(run, ROWS)


def _scored(chunks: DataFrame) -> DataFrame:
    """The documents of every chunk with the sums over their links."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("bucket")  # the documents first, then their links, then the answers in the order of the chunk's pairs
        facts = np.frombuffer(group["pairs"][0].as_py(), FACTS)
        first = int(np.searchsorted(group["bucket"].to_numpy(), 0))
        data = group["data"].to_pylist()
        planes = [np.frombuffer(x, "<u2").reshape(2, -1).astype(np.int64) for x in data[1:first]]
        place = np.concatenate([np.zeros(0, np.int64), *[low | high << 16 for low, high in planes]])
        answer = np.frombuffer(b"".join(data[first:]), "<i8")[place]
        stops = np.cumsum(facts["n_links"])
        per = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[stops], prepend=0)
        none = facts["n_a"] == 0
        return pa.table({
            "doc_id": pa.array(facts["id"], mask=facts["null"].astype(bool)),
            **{c: facts[c] for c in ("n_a", "n_b", "n_groups", "n_links")},
            "n_best": per(answer & 1), "count_sum": per(answer >> 1),
            "groups_sha256": ["" if z else x.tobytes().hex() for x, z in zip(facts["sha"], none)],
        })

    schema = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    return chunks.groupBy("chunk").applyInArrow(run, schema)


def align(docs: DataFrame, spec: str, model: bytes, id_col="doc_id", text_col="text") -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``: one row per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast((spec, model))  # two vocabulary files
    a, b = ByteSide(spec), PieceSide(model)
    dtype = _code_type(len(a.bytes), len(b.bytes))
    rows = stage(_chunks(_texts(docs, id_col, text_col), shared), "alignment-chunks")
    blocks = rows.filter("kind = 1")
    totals = stage(_totals(blocks, len(a.bytes), dtype), "alignment-totals")
    answers = _answers(totals, blocks, dtype)
    return _scored(rows.filter("kind = 0").unionByName(answers))


def vocabularies() -> tuple[str, bytes]:
    import public_tokenizers

    with open(public_tokenizers.path(BYTE_VOCABULARY), encoding="utf-8") as f, open(public_tokenizers.path(PIECE_VOCABULARY), "rb") as g:
        return f.read(), g.read()


@query("op12_token_alignment")
def op12(spark, sf_dir):
    return align(table(spark, sf_dir, "documents"), *vocabularies())
