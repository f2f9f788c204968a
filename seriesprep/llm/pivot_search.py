"""Exact top-k search by inner product with a pivot-distance index.

Vectors get one more coordinate, sqrt(M - |x|^2) with M the largest squared norm (0 for a query), which
makes the largest inner product the smallest distance: d(q, x)^2 = |q|^2 + M - 2 q.x.  Every vector is keyed by its
nearest pivot and its distance r to it.  A cell's vectors lie in blocks sorted by r, so the vectors that the
triangle inequality allows, |r - d(q, pivot)| <= radius, are one annulus: a contiguous run of rows.
Queries first search their own cell, in annuli that grow around their own distance until the next one is
out of reach; the k-th score found is then the radius for all other cells, whose blocks are read only if
their annulus meets it.  Scores are integer inner products and exact.

Pivots: ``PIVOTS`` of a sample of ``SAMPLE`` rows (those of smallest id hash), far from each other; every row is indexed.
Blocks hold at most about ``max(BLOCK_ROWS, rows / BLOCKS)`` vectors of one cell, dealt by id hash, so a cell with most
rows, or many copies of one vector, is many blocks.  Block headers (at most a few per ``BLOCKS`` and pivot) are broadcast.

Edge cases: vectors that are null or hold null or non-finite components take no part; shorter vectors count as
padded with zeros; a query's own id is never its neighbour, also where rows repeat it; equal rows with one id count once and are
left out before blocks are formed, while different vectors of one id count each, as in the SQL; ties go to the smaller id; fewer than k candidates give fewer rows; an empty table gives an empty result.  Components whose
products exceed 2**53 in sum raise ``OverflowError``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesprep.llm.common import query, small, stage, table

SCALE = 256
TOP = 5
EVERY = 50
PIVOTS = 32
SAMPLE = 4096
BLOCK_ROWS = 2048
BLOCKS = 8192
QUERY_ROWS = 4096
ANNULUS = 256  # rows of the first annulus around a query


def quantised(vectors: DataFrame, id_col="vec_id", vector_col="embedding", scale: float = SCALE) -> DataFrame:
    """``(id, v)`` with integer components, padded to one length."""
    v = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale).cast("double"))
    usable = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.filter(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull()).filter(usable)
    size = rows.agg(F.max(F.size(vector_col))).first()[0] or 1
    pad = F.array_repeat(F.lit(0.0), F.lit(size) - F.size("v"))
    return rows.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v")).select("id", F.concat("v", pad).alias("v"))


def matrix(column) -> np.ndarray:
    """Equal lists of an Arrow column as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def choose_pivots(sample: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Rows of the sample, each as far as possible from those before it."""
    at = [0]
    far = np.linalg.norm(sample - sample[0], axis=1)
    while len(at) < min(count, len(sample)):
        if far.max() == 0:
            break
        at.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(sample - sample[at[-1]], axis=1))
    return sample[at]


def lifted(v: np.ndarray, largest: float) -> np.ndarray:
    return np.column_stack((v, np.sqrt(np.maximum(largest - (v * v).sum(axis=1), 0))))


def distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances of lifted rows to pivots."""
    square = (v * v).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * (v @ pivots.T)
    return np.sqrt(np.maximum(square, 0))


def keyed(rows: DataFrame, pivots: np.ndarray, largest: float, is_query: bool) -> DataFrame:
    """``(id, v, cell, r)``; queries are lifted with 0, indexed vectors by their missing norm."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = matrix(batch["v"])
                d = distances(np.column_stack((v, np.zeros(len(v)))) if is_query else lifted(v, largest), pivots)
                cell = d.argmin(axis=1)
                yield pa.RecordBatch.from_pydict({"id": batch["id"], "v": batch["v"], "cell": pa.array(cell.astype(np.int32)), "r": d[np.arange(len(d)), cell]})

    return rows.mapInArrow(key, "id bigint, v array<double>, cell int, r double")


def blocked(rows: DataFrame, size: int, prefix: str) -> DataFrame:
    """Rows of one cell packed into blocks sorted by r, dealt by id hash; ``floor`` packs along if present."""
    counts = rows.groupBy("cell").count().withColumn("slots", F.ceil(F.col("count") / size)).select("cell", "slots")
    placed = rows.join(F.broadcast(counts), "cell").withColumn("slot", F.pmod(F.xxhash64("id"), F.col("slots")).cast("int"))  # one row per pivot

    def pack(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by([("r", "ascending"), ("id", "ascending")])
        column = lambda name: group[name].combine_chunks() if group.num_rows else group[name]
        raw = lambda a: [np.ascontiguousarray(a).tobytes()]
        r = column("r").to_numpy()
        return pa.table({
            f"{prefix}_cell": pa.array([group["cell"][0].as_py()], pa.int32()),
            f"{prefix}_slot": pa.array([group["slot"][0].as_py()], pa.int32()),
            f"{prefix}_low": [r[0]],
            f"{prefix}_high": [r[-1]],
            f"{prefix}_ids": raw(column("id").to_numpy().astype("<i8")),
            f"{prefix}_r": raw(r.astype("<f8")),
            f"{prefix}_v": raw(matrix(column("v")).astype("<f8")),
            f"{prefix}_floor": raw(column("floor").to_numpy(zero_copy_only=False).astype("<f8")),
        })

    if "floor" not in placed.columns:
        placed = placed.withColumn("floor", F.lit(float("-inf")))
    schema = f"{prefix}_cell int, {prefix}_slot int, {prefix}_low double, {prefix}_high double, {prefix}_ids binary, {prefix}_r binary, {prefix}_v binary, {prefix}_floor binary"
    return placed.drop("slots").groupBy("cell", "slot").applyInArrow(pack, schema)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties to the smaller id."""
    if len(scores) > 4 * k:
        limit = np.partition(scores, len(scores) - k)[len(scores) - k]
        kept = np.flatnonzero(scores >= limit)
    else:
        kept = np.arange(len(scores))
    return kept[np.lexsort((ids[kept], -scores[kept]))[:k]]


class Search:
    """The queries of one block against the vectors of one block."""

    def __init__(self, pivots: np.ndarray, largest: float, k: int):
        self.pivots, self.largest, self.k = pivots, largest, k

    def radius(self, norms: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """How far a vector with at least the score ``floor`` can be, with room for rounding."""
        square = norms + self.largest - 2 * floor
        return np.sqrt(np.maximum(square, 0)) * (1 + 1e-9) + 1e-6 * math.sqrt(max(self.largest, 1.0))

    def pair(self, row: dict, grow: bool) -> tuple[list, list, list]:
        ids, r = np.frombuffer(row["x_ids"], "<i8"), np.frombuffer(row["x_r"], "<f8")
        v = np.frombuffer(row["x_v"], "<f8").reshape(len(ids), -1)
        qids = np.frombuffer(row["q_ids"], "<i8")
        q = np.frombuffer(row["q_v"], "<f8").reshape(len(qids), -1)
        norms = (q * q).sum(axis=1)
        at = distances(np.column_stack((q, np.zeros(len(q)))), self.pivots[[row["x_cell"]]])[:, 0]
        floor = np.frombuffer(row["q_floor"], "<f8")
        out: tuple[list, list, list] = ([], [], [])
        for i, query_id in enumerate(qids.tolist()):
            lo, hi = self._annulus(r, at[i], norms[i], floor[i], v, q[i], ids, query_id) if grow else self._reach(r, at[i], norms[i], floor[i])
            if lo >= hi:
                continue
            scores = v[lo:hi] @ q[i]
            own = ids[lo:hi] != query_id
            scores, found = scores[own], ids[lo:hi][own]
            for j in best(scores, found, self.k):
                out[0].append(query_id)
                out[1].append(int(found[j]))
                out[2].append(int(scores[j]))
        return out

    def _reach(self, r, at, norm, floor) -> tuple[int, int]:
        if floor == -np.inf:
            return 0, len(r)
        reach = self.radius(np.array([norm]), np.array([floor]))[0]
        return int(np.searchsorted(r, at - reach, "left")), int(np.searchsorted(r, at + reach, "right"))

    def _annulus(self, r, at, norm, floor, v, q, ids, query_id) -> tuple[int, int]:
        """Double the annulus around ``at`` until the k-th score inside it puts the rest out of reach."""
        middle, half = int(np.searchsorted(r, at)), ANNULUS // 2
        while True:
            lo, hi = max(0, middle - half), min(len(r), middle + half)
            if lo == 0 and hi == len(r):
                return lo, hi
            scores = v[lo:hi] @ q
            scores = scores[ids[lo:hi] != query_id]
            if len(scores) >= self.k:
                kth = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
                a, b = self._reach(r, at, norm, max(kth, floor))
                if lo <= a and b <= hi:
                    return a, b
            half *= 2


def _matches(pairs: DataFrame, search: Search, grow: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch[name][i].as_py() for name in batch.schema.names}
                out = search.pair(row, grow)
                yield pa.RecordBatch.from_pydict(dict(zip(("query_id", "vec_id", "score"), (pa.array(x, pa.int64()) for x in out))))

    return pairs.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")


def distinct_rows(vectors: DataFrame) -> DataFrame:
    """``(id, v)`` with repeats of a row left out; only rows whose id repeats are shuffled with their vectors."""
    ids = stage(vectors.groupBy("id").count().filter("count > 1").select("id"), "pivot-repeated")
    n = ids.count()
    if not n:
        return vectors
    once, often = (vectors.join(small(ids, n), "id", kind) for kind in ("left_anti", "left_semi"))
    return stage(once.unionByName(often.distinct()), "pivot-distinct")


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(vectors: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for ``(id, v)`` tables of equal vector length."""
    vectors, queries = distinct_rows(vectors), queries.distinct()
    n = vectors.count()
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    largest = vectors.agg(F.max(norm)).first()[0] or 0.0
    if max(largest, queries.agg(F.max(norm)).first()[0] or 0.0) >= 2.0**52:
        raise OverflowError("inner products are not exact beyond 2**53")
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()
    if not sample:
        return vectors.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.col("id").alias("score")).limit(0)
    pivots = choose_pivots(lifted(np.array([r["v"] for r in sample]), largest))
    engine = Search(pivots, largest, k)
    index = stage(blocked(keyed(vectors, pivots, largest, False), max(BLOCK_ROWS, -(-n // BLOCKS)), "x"), "pivot-index")
    asked = stage(keyed(queries, pivots, largest, True), "pivot-queries")
    first = stage(_matches(blocked(asked, QUERY_ROWS, "q").join(index, F.col("q_cell") == F.col("x_cell")), engine, True), "pivot-first")
    floors = ranked(first, k).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("floor"))
    known = stage(blocked(asked.join(floors, "id", "left").fillna({"floor": float("-inf")}), QUERY_ROWS, "q"), "pivot-query-blocks")
    headers = index.select("x_cell", "x_slot", "x_low", "x_high").collect()  # at most BLOCKS + PIVOTS rows
    cells, slots = np.array([h["x_cell"] for h in headers]), np.array([h["x_slot"] for h in headers])
    low, high = np.array([h["x_low"] for h in headers]), np.array([h["x_high"] for h in headers])

    def reachable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pairs of a query block and a block of another cell whose annulus a query reaches."""
        for batch in batches:
            for i in range(batch.num_rows):
                q = np.frombuffer(batch["q_v"][i].as_py(), "<f8")
                floor = np.frombuffer(batch["q_floor"][i].as_py(), "<f8")
                q = q.reshape(len(floor), -1)
                reach = engine.radius((q * q).sum(axis=1), floor)[:, None]
                at = distances(np.column_stack((q, np.zeros(len(q)))), pivots)[:, cells]
                meets = ((at - reach <= high) & (at + reach >= low)).any(axis=0) & (cells != batch["q_cell"][i].as_py())
                hit = np.flatnonzero(meets)
                yield pa.RecordBatch.from_pydict({
                    "c": pa.array(np.full(len(hit), batch["q_cell"][i].as_py()), pa.int32()), "s": pa.array(np.full(len(hit), batch["q_slot"][i].as_py()), pa.int32()),
                    "x_cell": pa.array(cells[hit], pa.int32()), "x_slot": pa.array(slots[hit], pa.int32()),
                })

    pairs = known.mapInArrow(reachable, "c int, s int, x_cell int, x_slot int")
    pairs = pairs.join(index, ["x_cell", "x_slot"]).join(known, (F.col("c") == F.col("q_cell")) & (F.col("s") == F.col("q_slot")))
    rest = _matches(pairs, engine, False)
    return ranked(first.unionByName(rest), k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s) WHERE rank <= 5
"""


@query("op3_pivot_search", SQL)
def op3(spark, sf_dir):
    vectors = stage(quantised(table(spark, sf_dir, "embeddings")), "pivot-vectors")
    return search(vectors, vectors.filter(F.col("id") % EVERY == 0))
