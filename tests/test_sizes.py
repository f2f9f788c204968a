"""Memory of one task: it must not grow with the number of series."""

import tracemalloc

import numpy as np
import pyarrow as pa

from checks import base
from seriesprep.functions import kernels


def test_grid_of_many_series_is_made_by_many_tasks(spark):
    ids = spark.range(20_000).coalesce(1).selectExpr("CAST(id AS STRING) AS series_id")
    parts = base.spread(ids, base.WEEKS).rdd.glom().map(len).collect()
    assert sum(parts) == 20_000 and max(parts) * base.WEEKS < 2 * base.GRID_POINTS
    assert base.spread(ids.limit(0), base.WEEKS).count() == 0


def test_wanted_points_stay_in_flat_arrays():
    rows, n = 2_000, 100
    level = pa.array([list(range(n))] * rows, pa.list_(pa.int64()))
    wanted = pa.array([[{"j": j, "k": 0} for j in range(n)]] * rows, pa.list_(pa.struct([("j", pa.int64()), ("k", pa.int64())])))
    lo = pa.array(np.arange(rows))
    tracemalloc.start()
    found = kernels.nth_exceeding.func(level, lo, wanted)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 * rows * n  # bytes an entry; as dicts it took several hundred
    assert found[3].as_py() == [{"j": j, "k": 0, "t": 3 + j} for j in range(n)]


def test_wanted_points_of_sliced_batches_and_missing_levels():
    level = pa.array([[9], [0, None, 2, 1], []], pa.list_(pa.int64()))[1:]
    wanted = pa.array([[], [{"j": 1, "k": 1}, {"j": 0, "k": 0}, {"j": 1, "k": 0}], []], pa.list_(pa.struct([("j", pa.int64()), ("k", pa.int64())])))[1:]
    found = kernels.nth_exceeding.func(level, pa.array([100, 200]), wanted)
    assert [[x["t"] for x in row] for row in found.to_pylist()] == [[103, 100, 102], []]
