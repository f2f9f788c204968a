"""Forms that only long periods and long series take, held against the plain ones."""

import subprocess
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import assert_same, points, some_series
from seriesprep.functions import kernels
from seriesprep.operators import autocorr, library, order


def dense(y, q, span):
    """The smooth from one weight row per position."""
    n = y.shape[-1]
    rows = []
    for i in range(n):
        left = 0 if n <= q else int(np.clip(i - (q - 1) // 2, 0, n - q))
        right = n - 1 if n <= q else left + q - 1
        row = np.zeros(n)
        row[left : right + 1] = kernels._tricube(i, left, right, q, n, span)
        rows.append(row)
    return y @ np.array(rows).T


@pytest.mark.parametrize("n, q", [(1000, 301), (900, 601), (700, 901), (600, 600), (601, 601), (257, 300), (2500, 2499), (300, 5)])
def test_wide_loess_equals_weight_rows(n, q):
    rng = np.random.default_rng(n + q)
    for y in (np.cumsum(rng.normal(size=(2, n)), axis=1) * 10 + 1e6, rng.normal(size=(1, n)), np.full((1, n), 3.5)):
        for span in (float(n - 1), 10.0 * n):
            np.testing.assert_allclose(kernels._wide_loess(y, q, span), dense(y, q, span), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("p", [100, 250])
def test_decomposition_does_not_depend_on_the_form(p, monkeypatch):
    t = np.arange(1000)
    y = (np.sin(2 * np.pi * t / p) + t / 500 + 0.1 * np.random.default_rng(1).normal(size=1000))[None, :]
    narrow = kernels.stl(y, p)
    monkeypatch.setattr(kernels, "DENSE_WIDTH", 10)
    kernels._loess_plan.cache_clear()
    for a, b in zip(narrow, kernels.stl(y, p)):
        np.testing.assert_allclose(a, b, rtol=1e-8, atol=1e-8)


def test_long_period_in_bounded_memory():
    """100,000 points at a period of 30,000: under 1 GB, where rows of weights would take 13 GB."""
    code = (
        "import numpy as np, resource; from seriesprep.functions import kernels\n"
        "y = np.sin(2 * np.pi * np.arange(100_000) / 30_000)[None, :] + np.arange(100_000) / 1e5\n"
        "s, t = kernels.stl(y, 30_000)\n"
        "r = y - s - t\n"
        "assert r.var() < 1e-3 * (y - t).var(), r.var()\n"
        "print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=Path(__file__).parent.parent)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) < 1000


@pytest.mark.parametrize("form", ["acf_features", "first_nonpositive"])
def test_lag_rows_are_read_where_the_row_of_lags_ends(spark, form, monkeypatch):
    series = some_series() | {"flat": np.full(150, 2.0), "alternating": np.tile([1.0, -1.0], 90), "rising": np.arange(200.0)}
    p = points(spark, series).cache()
    build = getattr(autocorr, form)
    whole = build(p, autocorr.lag_sums(p))
    monkeypatch.setattr(autocorr, "ROW_LAGS", 2)
    sums = autocorr.lag_sums(p, 60)
    assert max(r[0] for r in sums.selectExpr("size(s)").collect()) == 40  # only the series of one block keeps all
    assert_same(whole, build(p, sums, 60), tol=1e-6)


@pytest.mark.parametrize("kind", ["ties", "outlier", "heavy", "spread"])
def test_value_buckets_stay_small_and_ranks_exact(spark, kind):
    rng = np.random.default_rng(9)
    n, block = 1500, 60
    v = {
        "ties": np.where(rng.random(n) < 0.99, 5.0, rng.normal(size=n)),
        "outlier": np.append(rng.normal(size=n - 1), 1e12),
        "heavy": rng.choice([1.0, 2.0, 2.5, 7.0], n, p=[0.4, 0.3, 0.29, 0.01]),
        "spread": np.exp(rng.normal(size=n) * 8),
    }[kind]
    p = points(spark, {"a": v, "short": v[:40]}).repartition(3).cache()
    placed = order.by_value(p, block)
    # a task orders one even bucket, or one block of an odd one
    sizes = placed.selectExpr("*", "if(bucket % 2 = 1, block, 0) AS sub").groupBy("series_id", "bucket", "sub").count()
    assert sizes.agg({"count": "max"}).first()[0] <= block
    odd = placed.filter("bucket % 2 = 1").groupBy("series_id", "bucket").agg(F.countDistinct("v").alias("k"))
    assert odd.filter("k > 1").count() == 0
    got = {(r["series_id"], r["t"]): (r["rank"], r["n"]) for r in order.ranked(p, block).collect()}
    for name, x in (("a", v), ("short", v[:40])):
        rank = np.empty(len(x), int)
        rank[np.lexsort((np.arange(len(x)), x))] = np.arange(len(x))
        assert all(got[name, t] == (r, len(x)) for t, r in enumerate(rank.tolist()))
    pairs = {r["series_id"]: r["pairs"] for r in order.inversions(p, block).collect()}
    assert pairs["a"] == sum(int((v[i] > v[i + 1 :]).sum()) for i in range(n))


@pytest.mark.parametrize("block", [16, 70])
def test_fluctuation_of_long_series_of_odd_length(spark, block):
    """Windows over several blocks, an odd length, a constant series and one with fewer than 12 scales."""
    rng = np.random.default_rng(5)
    series = {"walk": np.cumsum(rng.normal(size=331)), "noise": rng.normal(size=257), "flat": np.full(90, 2.0), "brief": rng.normal(size=21)}
    p = points(spark, series).repartition(3).cache()
    assert_same(library.fluctuation(p), library.fluctuation(p, block), tol=1e-9)


def test_fluctuation_hands_on_few_rows_a_block():
    """A block gives one row for the windows inside and at most two more for each scale, whatever its length."""
    values = np.random.default_rng(2).normal(size=5000)
    rows = kernels.window_parts.func(*[pd.Series([x]) for x in (values, 5000, 3.0, 20_000, 20_000, True)])[0]
    assert len(rows) <= 3 * len(kernels.scale_grid(20_000))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 16, 17, 250, 1001])
def test_holt_maps_equal_single_steps(n):
    x = np.random.default_rng(n).normal(size=n)
    state, q = kernels._holt_block(x)
    for g, (alpha, beta) in enumerate(kernels.HOLT_GRID):
        level, slope, total = 0.7, -0.3, 0.0
        for v in x:
            e = v - level - slope
            level, slope, total = level + slope + alpha * e, slope + alpha * beta * e, total + e * e
        h = np.array([0.7, -0.3, 1.0])
        np.testing.assert_allclose(state[g] @ h, [level, slope, 1.0], rtol=1e-9, atol=1e-9)
        np.testing.assert_allclose(h @ q[g] @ h, total, rtol=1e-9, atol=1e-9)
