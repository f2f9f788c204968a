"""Connected components of an edge table.

Each task first replaces the edges it holds by a spanning forest (node to least node), which needs no
shuffle and leaves at most one edge per node and task.  While more than one task's worth of edges is left,
a round of large and small stars joins the forests of different tasks, and they are contracted again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesprep.llm.common import small, stage

TASK_EDGES = 400_000  # a task contracts about so many edges


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(node, root)`` for every node of the edges ``a - b`` that is not the least of its component."""
    nodes, place = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        lo, hi = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        open_ = lo != hi
        x, y = x[open_], y[open_]
        np.minimum.at(root, hi[open_], lo[open_])
        while (up := root[root]).tobytes() != root.tobytes():
            root = up
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def contracted(edges: DataFrame) -> DataFrame:
    """Each task's edges as a forest ``(a, b)`` with b the root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = b = np.zeros(0, np.int64)
        for batch in batches:
            a = np.concatenate((a, batch["a"].to_numpy()))
            b = np.concatenate((b, batch["b"].to_numpy()))
            if len(a) > TASK_EDGES:
                a, b = forest(a, b)
        a, b = forest(a, b)
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return edges.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")).mapInArrow(run, "a bigint, b bigint")


def _linked(edges: DataFrame, least: DataFrame) -> DataFrame:
    return edges.join(small(stage(least, "graph-least")), "a")


def _stars(edges: DataFrame) -> DataFrame:
    """One round: all larger neighbours of a node to its least, then all neighbours of a node to its least."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
    large = _linked(both, least).filter("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = stage(large.distinct(), "graph-large")
    linked = _linked(large, large.groupBy("a").agg(F.min("b").alias("m")))
    turned = linked.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return turned.unionByName(linked.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node with an edge to another; ``edges`` has ``a, b`` and the root is the least node."""
    now = stage(contracted(edges), "graph-edges")
    seen = None
    while (n := now.count()) > 0:
        tasks = -(-n // TASK_EDGES)
        now = stage(contracted(now.coalesce(tasks)), "graph-edges")
        if tasks == 1:
            break
        before, seen = seen, tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if seen == before:
            break
        now = stage(_stars(now), "graph-stars")
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
