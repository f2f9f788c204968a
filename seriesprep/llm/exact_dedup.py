"""Exact deduplication by Grace hashing.

Equal contents always share a hash, so rows are dealt to buckets by it, and each bucket is resolved
by an open-addressing table that compares complete contents.  The table holds every distinct content
once; a bucket whose distinct contents outgrow the memory bound is split by further hash digits into
spill files, and each of these is resolved the same way, recursively.  Spill files are scratch of one
task, like Spark's own sort spills: they never leave it, and a repeated task writes them anew.

Hot groups: before the shuffle each batch of a scan is resolved by the same table, so a group of copies reaches its
bucket as one content per batch, never as all its rows.  Rows point to their batch's representative, representatives to
the group, so the join back has no hot key either.

Edge cases: null counts as empty text, and empty texts are equal to each other; whole texts are compared;
of equal texts the largest id stays (null ids count as smallest); rows with the same id and text are
one group member each, so ``group_size`` counts rows; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesprep.llm.common import query, stage, table, text_or_empty

MEMORY = 64 << 20  # bytes of distinct contents that a table may hold
FANOUT = 16  # spill files of a bucket: one hash digit
DIGITS = 60  # of the hash, after the four that deal rows to buckets


class ContentTable:
    """Open addressing with linear probing; a slot matches only on equal complete content."""

    def __init__(self):
        self.slots = np.full(1024, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[str] = []
        self.bytes = 0

    def find(self, hashed: int, content: str) -> tuple[int, int]:
        """``(entry, slot)``; the entry is -1 where the content is new and ``slot`` is free for it."""
        mask = len(self.slots) - 1
        slot = hashed & mask
        while (entry := int(self.slots[slot])) >= 0:
            if self.hashes[entry] == hashed and self.contents[entry] == content:
                return entry, slot
            slot = (slot + 1) & mask
        return -1, slot

    def add(self, hashed: int, content: str, slot: int) -> int:
        entry = len(self.contents)
        self.slots[slot] = entry
        self.hashes.append(hashed)
        self.contents.append(content)
        self.bytes += 4 * len(content) + 64
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return entry

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for entry, hashed in enumerate(self.hashes):
            slot = hashed & mask
            while self.slots[slot] >= 0:
                slot = (slot + 1) & mask
            self.slots[slot] = entry


def number(digest: str) -> int:
    return int(digest[48:], 16)


def resolve(rows: Iterator[tuple[str, str, tuple]], level: int = 0, memory: int = MEMORY) -> Iterator[list[tuple]]:
    """Groups of equal content: the payloads of ``(digest, content, payload)`` rows, group by group.

    Contents that fit no more go to ``FANOUT`` spill files by the next digit of the digest.
    """
    found, groups, spills = ContentTable(), [], None
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        try:
            for digest, content, payload in rows:
                key = number(digest)
                entry, slot = found.find(key, content)
                if entry < 0:
                    if found.bytes > memory and level < DIGITS:
                        if spills is None:
                            spills = [open(f"{folder}/{i}", "wb") for i in range(FANOUT)]  # noqa: SIM115
                        pickle.dump((digest, content, payload), spills[int(digest[4 + level], 16)], pickle.HIGHEST_PROTOCOL)
                        continue
                    entry = found.add(key, content, slot)
                    groups.append([])
                groups[entry].append(payload)
            yield from groups
        finally:
            for f in spills or []:
                f.close()
        del found, groups
        for i in range(FANOUT if spills else 0):
            yield from resolve(_spilled(f"{folder}/{i}"), level + 1, memory)


def _spilled(path: str) -> Iterator[tuple[str, str, tuple]]:
    with open(path, "rb") as f:
        while True:
            try:
                yield pickle.load(f)
            except EOFError:
                return


def representatives(rows: DataFrame, memory: int = MEMORY) -> DataFrame:
    """``(key, digest, rep, n, content)`` for ``(key, digest, content)``, staged.

    ``rep`` names the batch's group of equal contents by a number of its own; only the first
    row of such a group keeps the content, and carries the group's largest key and its row count.
    """

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            n = len(frame)
            frame = frame.copy()
            content = frame["content"].tolist()
            keys = frame["key"]
            order = list(zip(frame["digest"].tolist(), content, range(n)))
            rep, count, best, keep = np.zeros(n, np.int64), np.zeros(n, np.int64), [None] * n, [None] * n
            numbers = frame["row"].to_numpy()
            for group in resolve(iter(order), memory=1 << 62):
                rep[group] = numbers[group[0]]
                count[group[0]], keep[group[0]] = len(group), content[group[0]]
                known = keys.iloc[group].dropna()
                best[group[0]] = int(known.max()) if len(known) else None
            yield pd.DataFrame({"key": keys.astype("Int64"), "digest": frame["digest"], "row": numbers, "rep": rep, "n": count, "best": pd.array(best, "Int64"), "content": keep})

    schema = "key bigint, digest string, row bigint, rep bigint, n bigint, best bigint, content string"
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    return stage(numbered.mapInPandas(batches, schema), "dedup-rows")


def groups(staged: DataFrame, memory: int = MEMORY) -> DataFrame:
    """``(rep, keep, group_size)`` for every representative of ``representatives``."""

    def buckets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            for frame in frames:
                for digest, content, rep, n, best in zip(frame["digest"], frame["content"], frame["rep"].tolist(), frame["n"].tolist(), frame["best"].tolist()):
                    yield digest, content, (rep, n, None if pd.isna(best) else int(best))

        held: list[tuple] = []
        for group in resolve(rows(), memory=memory):
            size = sum(n for _, n, _ in group)
            keep = max((b for _, _, b in group if b is not None), default=None)
            held += [(rep, keep, size) for rep, _, _ in group]
            if len(held) >= 10_000:
                yield frame_of(held)
                held = []
        if held:
            yield frame_of(held)

    def frame_of(held):
        reps, keeps, sizes = zip(*held)
        return pd.DataFrame({"rep": reps, "keep": pd.array(keeps, "Int64"), "group_size": sizes})

    firsts = staged.filter("content IS NOT NULL").select("digest", "content", "rep", "n", "best")
    return firsts.repartition(F.substring("digest", 1, 4)).mapInPandas(buckets, "rep bigint, keep bigint, group_size bigint")


def deduplicate(docs: DataFrame, id_col="doc_id", text_col="text", memory: int = MEMORY) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``: one row per row of ``docs``.

    Where several equal rows carry the kept id, all of them are marked kept.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("key"), text_or_empty(text_col).alias("content"))
    staged = representatives(rows.withColumn("digest", F.sha2("content", 256)), memory)
    found = groups(staged, memory)
    both = staged.drop("content", "n", "best").join(found, "rep")
    return both.select(
        F.col("key").alias("doc_id"),
        F.col("keep").alias("keep_id"),
        "group_size",
        F.col("key").eqNullSafe(F.col("keep")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256 FROM documents
"""


@query("op6_exact_dedup", SQL)
def op6(spark, sf_dir):
    return deduplicate(table(spark, sf_dir, "documents"))
