"""Remove passages that repeat across documents, by content-defined chunks and runs of lines.

Lines are hashed, and a rolling hash over the last ``WINDOW`` line hashes ends a chunk where it is divisible by
``DIVISOR``; so where a passage was inserted or lines were added before it, the same chunks come back after
a line or two.  A chunk of at least ``LEAST_LINES`` lines with visible text that occurs elsewhere is
removed from all places but its first: the smallest document id, then the earliest line.

Chunks alone lose the ends of a passage and most short ones.  With ``least_words`` every shortest run of whole lines
with so many words is looked up too, from each line on and up to each line.  A shared passage of at least
``least_words`` words, of one line or more, is the union of such runs inside it, so all of its lines are found.

Pieces (chunks and runs) are keyed by 128 bits.  Those of one document whose first places continue each other are one span,
and spans count as equal only when their bytes are: they are compared in full with their first place by ``exact_dedup``'s
table, part by part before the shuffle, so a passage that a third of all documents share reaches one task once per part.

Documents stay, with the lines that are left; their other columns are untouched but for the text.

Edge cases: null text stays null; empty texts stay as they are; a document that repeats a passage
of its own keeps its first, also where the two overlap; rows that share both id and text are one document and treated alike;
null ids come last in the order of documents; very long texts are cut whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesprep.llm.byte_bpe import slices
from seriesprep.llm.common import give_back, query, small, stage, table
from seriesprep.llm.exact_dedup import resolve

WINDOW = 2  # lines the boundary hash looks at
DIVISOR = 3  # one line in so many ends a chunk
LEAST_LINES = 2
MOST_LINES = 64  # a chunk never grows beyond, so that runs of one line are cut too
LEAST_WORDS = 50  # of a passage that goes wherever it lies
FACTOR = np.uint64(0x9E3779B97F4A7C15)
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # of the two halves of a key
CONTENT_BYTES = 4_000_000  # compared at a time before the shuffle


def boundaries(lines: list[str]) -> list[int]:
    """The first line of every chunk, and the number of lines."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, lines), np.uint64, len(lines))
    rolled = np.zeros(len(lines), np.uint64)
    for back in range(WINDOW):
        rolled[back:] = rolled[back:] * FACTOR + hashes[: len(lines) - back]
    rolled ^= rolled >> np.uint64(29)
    cuts, start = [0], 0
    for end in (np.flatnonzero(rolled % np.uint64(DIVISOR) == 0) + 1).tolist() + [len(lines)]:
        while end - start > MOST_LINES:
            start += MOST_LINES
            cuts.append(start)
        if end > start:
            cuts.append(end)
            start = end
    return cuts


def chunks(text: str) -> Iterator[tuple[int, int, str]]:
    """``(first line, lines, content)`` of every multi-line chunk."""
    lines = text.split("\n")
    if len(lines) < LEAST_LINES:
        return
    cuts = boundaries(lines)
    for a, b in zip(cuts, cuts[1:]):
        if b - a >= LEAST_LINES and any(x.strip() for x in lines[a:b]):
            yield a, b - a, "\n".join(lines[a:b])


def runs(lines: list[str], least_words: int) -> set[tuple[int, int]]:
    """``(first line, lines)`` of the shortest runs with ``least_words`` words from each line on and up to each line."""
    words = np.concatenate(([0], np.cumsum([len(x.split()) for x in lines])))
    ends = np.searchsorted(words, words[:-1] + least_words, "left")
    starts = np.searchsorted(words, words[1:] - least_words, "right") - 1
    found = {(a, b - a) for a, b in enumerate(ends.tolist()) if b <= len(lines)}
    return found | {(a, b - a) for b, a in enumerate(starts.tolist(), 1) if a >= 0}


def pieces(text: str, least_words: int | None = None) -> tuple[np.ndarray, ...]:
    """``(first line, lines, key, mate)`` of every chunk and, with ``least_words``, every run; key and mate stand for the content."""
    spans = {(a, n) for a, n, _ in chunks(text)}
    lines = text.split("\n")
    if least_words:
        spans |= runs(lines, least_words)
    if not spans:
        return (np.zeros(0, np.int64),) * 4
    first, count = np.array(sorted(spans), np.int64).T
    keys = []
    for seed, factor in enumerate(FACTORS):
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(x, seed) for x in lines), np.uint64, len(lines))
        powers = np.cumprod(np.full(len(lines), factor, np.uint64))
        back = np.cumprod(np.full(len(lines), pow(factor, -1, 1 << 64), np.uint64))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * powers, dtype=np.uint64)))
        keys.append(((sums[first + count] - sums[first]) * back[first]).view(np.int64))
    return first, count, *keys


def _first_row():
    """Documents in order of id with nulls last, rows of one id told apart by the text."""
    return "id bigint, text_hash bigint"


def piece_rows(docs: DataFrame, least_words: int | None) -> DataFrame:
    """``(id, text_hash, line, lines, key, mate)`` of every piece, staged without its content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "text_hash", "line", "lines", "key", "mate"]
        for batch in batches:
            at = 0
            for texts in slices(batch["text"]):
                found = [pieces(text, least_words) for text in texts]
                row = pa.array(np.repeat(np.arange(at, at + len(texts)), [len(x[0]) for x in found]))
                at += len(texts)
                columns = [pa.array(np.concatenate(c)) for c in zip(*found)]
                yield pa.RecordBatch.from_arrays([batch["id"].take(row), batch["text_hash"].take(row), *columns], names)
        give_back()

    return stage(docs.mapInArrow(run, f"{_first_row()}, line bigint, lines bigint, key bigint, mate bigint"), "line-pieces")


def _same_place():
    """Whether a row is its own first place."""
    return F.col("id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash")) & (F.col("line") == F.col("first_line"))


def _merged(spans: DataFrame, by: list[str]) -> DataFrame:
    """Spans ``(line, lines)`` of each group that overlap or touch, made one."""
    order = Window.partitionBy(*by).orderBy("line")
    end = F.col("line") + F.col("lines")
    apart = spans.withColumn("_reach", F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    apart = apart.withColumn("_new", (F.col("_reach").isNull() | (F.col("line") > F.col("_reach"))).cast("bigint"))
    part = F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return apart.withColumn("_part", part).groupBy(*by, "_part").agg(F.min("line").alias("line"), (F.max(end) - F.min("line")).alias("lines")).drop("_part")


def _pairs(cut: DataFrame) -> DataFrame:
    """``(id, text_hash, line, lines, first_id, first_hash, first_line)``: spans of repeated pieces and where their keys come first."""
    keys = ["key", "mate"]
    repeated = stage(cut.groupBy(*keys).count().filter("count > 1").select(*keys), "line-repeated")
    held = stage(cut.join(small(repeated), keys), "line-held")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "text_hash", "line")
    firsts = stage(held.groupBy(*keys).agg(F.min(place).alias("first")), "line-firsts")
    firsts = firsts.select(*keys, F.col("first.id").alias("first_id"), F.col("first.text_hash").alias("first_hash"), F.col("first.line").alias("first_line"))
    later = held.join(small(firsts), keys).filter(~_same_place()).withColumn("ahead", F.col("line") - F.col("first_line"))
    spans = _merged(later, ["id", "text_hash", "first_id", "first_hash", "ahead"])
    return stage(spans.withColumn("first_line", F.col("line") - F.col("ahead")).drop("ahead"), "line-pairs")


def _places(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``(id, text_hash, line, lines, rep, digest, content)`` of spans: equal contents of a part share ``rep``.

    The documents that hold a span are scanned again with the list of its lines.
    Only the row that is first among equal ones keeps the content.
    """
    marks = spans.distinct().groupBy("id", "text_hash").agg(F.collect_list(F.struct("line", "lines")).alias("marks"))  # spans of one text
    marks = stage(marks, "line-marks").select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), "marks")
    kinds = [("id", pa.int64()), ("text_hash", pa.int64()), ("line", pa.int64()), ("lines", pa.int64()), ("rep", pa.int64()), ("digest", pa.string()), ("content", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33

        def part(place: list[tuple], contents: list[str]) -> pa.RecordBatch:
            n = len(place)
            digests = [xxhash.xxh3_128_hexdigest(c.encode("utf-8", "surrogatepass")) for c in contents]
            rep, keep = [0] * n, [None] * n
            for group in resolve(iter(zip((d * 2 for d in digests), contents, range(n))), memory=1 << 62):
                first = min(group, key=lambda i: (place[i][0] is None, place[i][0] or 0, place[i][1], place[i][2]))
                keep[first] = contents[first]
                for i in group:
                    rep[i] = row + first
            columns = [*zip(*place), rep, digests, keep]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], [k for k, _ in kinds])

        place: list[tuple] = []
        contents: list[str] = []
        size = 0
        for batch in batches:
            at = 0
            ids, hashes = batch["id"].to_pylist(), batch["text_hash"].to_pylist()
            for texts in slices(batch["text"]):
                for text in texts:
                    lines = text.split("\n")
                    for m in batch["marks"][at].as_py():
                        place.append((ids[at], hashes[at], m["line"], m["lines"]))
                        contents.append("\n".join(lines[m["line"] : m["line"] + m["lines"]]))
                        size += len(contents[-1]) + 100
                        if size > CONTENT_BYTES:
                            yield part(place, contents)
                            row, size = row + len(place), 0
                            place, contents = [], []
                    at += 1
        if place:
            yield part(place, contents)
        place, contents = [], []
        give_back()

    held = docs.join(small(marks), F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
    held = held.select("id", "text_hash", "text", "marks")
    return stage(held.mapInArrow(run, f"{_first_row()}, line bigint, lines bigint, rep bigint, digest string, content string"), "line-places")


def _later(places: DataFrame) -> DataFrame:
    """``(id, text_hash, line, lines)`` of every occurrence but the first of its content, less what the first itself covers."""
    kinds = [("rep", pa.int64()), ("first_id", pa.int64()), ("first_hash", pa.int64()), ("first_line", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for digest, content, *place in zip(*(batch[c].to_pylist() for c in ("digest", "content", "rep", "id", "text_hash", "line"))):
                    yield digest * 2, content, tuple(place)

        held: list[tuple] = []
        for group in resolve(rows()):
            _, i, h, line = min(group, key=lambda p: (p[1] is None, p[1] or 0, p[2], p[3]))
            held += [(rep, i, h, line) for rep, *_ in group]
            if len(held) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held), kinds)], [k for k, _ in kinds])
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held), kinds)], [k for k, _ in kinds])
        held = []
        give_back()

    firsts = places.filter("content IS NOT NULL").select("digest", "content", "rep", "id", "text_hash", "line")
    groups = firsts.repartition(F.substring("digest", 1, 4)).mapInArrow(run, "rep bigint, first_id bigint, first_hash bigint, first_line bigint")
    later = places.drop("content", "digest").join(groups, "rep").filter(~_same_place())
    own = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))
    start = F.when(own, F.greatest(F.col("line"), F.col("first_line") + F.col("lines"))).otherwise(F.col("line"))
    return later.select("id", "text_hash", start.alias("line"), (F.col("line") + F.col("lines") - start).alias("lines"))


def removals(docs: DataFrame, id_col="doc_id", text_col="text", least_words: int | None = None) -> DataFrame:
    """``(id, text_hash, spans)``: the lines to remove from each document that repeats an earlier passage."""
    text = F.col(text_col)
    rows = docs.filter(text.isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    pairs = _pairs(piece_rows(rows, least_words))
    firsts = pairs.select(F.col("first_id").alias("id"), F.col("first_hash").alias("text_hash"), F.col("first_line").alias("line"), "lines")
    later = _later(_places(rows, pairs.select("id", "text_hash", "line", "lines").unionByName(firsts)))
    spans = _merged(later, ["id", "text_hash"])
    return spans.groupBy("id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("line", "lines"))).alias("spans"))


def deduplicate(docs: DataFrame, id_col="doc_id", text_col="text", spans: str | None = None, least_words: int | None = None) -> DataFrame:
    """``docs`` with later occurrences of repeated chunks cut out of the text; ``spans`` names an optional column of the cuts.

    With ``least_words`` every repeated run of lines with so many words goes too, whole.
    """
    if spans in docs.columns:
        raise ValueError(f"the table already has a column {spans}")
    gone = stage(removals(docs, id_col, text_col, least_words), "line-removals").select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("spans").alias("_spans"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id_col).cast("bigint").alias("_key"), F.xxhash64(F.col(text_col)).alias("_text"))
    both = rows.join(small(gone), F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")), "left")

    @F.arrow_udf("string")
    def rest(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, cuts in batches:
            done = []
            for text, cut in zip(texts, cuts):
                text, cut = text.as_py(), cut.as_py()
                if text is not None and cut:
                    lines = text.split("\n")
                    for span in reversed(cut):
                        del lines[span["line"] : span["line"] + span["lines"]]
                    text = "\n".join(lines)
                done.append(text)
            yield pa.array(done, pa.string())
        give_back()

    text = rest(F.col("_row")[text_col], F.col("_spans"))
    columns = [(text if c == text_col else F.col("_row")[c]).alias(c) for c in docs.columns]
    return both.select(*columns, *([F.coalesce("_spans", F.array().cast("array<struct<line:bigint,lines:bigint>>")).alias(spans)] if spans else []))


@query("op4_line_dedup")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return deduplicate(docs, spans="removed", least_words=LEAST_WORDS).withColumn("n_removed", F.aggregate("removed", F.lit(0).cast("bigint"), lambda a, x: a + x["lines"]))
