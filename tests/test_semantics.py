"""Edge cases and independent re-computation on small fixtures."""

import math

import numpy as np
import pytest

from helpers import points, some_series, table
from seriesprep.functions import kernels
from seriesprep.functions.scalars import adf_pvalue, adjust_period, bin_period, kpss_pvalue, normal_cdf
from seriesprep.layout import BLOCK_LEN
from seriesprep.operators import autocorr, channels, decompose, divergence, library, order, repair, screen, spectrum, stats, symbolic, unitroot
from seriesprep.params import Params
from seriesprep.plans import pipeline, report
from pyspark.sql import functions as F


def one(df, key="s"):
    return table(df)[(key, "0")]


# ------------------------------------------------------------ scalar functions
def test_periods(spark):
    rows = spark.createDataFrame([(p,) for p in (2, 3, 9, 43, 44, 49, 50, 55, 1640, 1641)], "p bigint")
    got = [r[0] for r in rows.select(adjust_period(F.col("p"))).collect()]
    assert got == [2, 4, 9, 43, 48, 48, 52, 55, 1440, 1641]
    r = spark.createDataFrame([(5, 2), (7, 2)], "n bigint, k bigint").select(bin_period(F.col("n"), F.col("k"))).collect()
    assert [x[0] for x in r] == [2, 4]


def test_normal_cdf(spark):
    from math import erfc, sqrt

    zs = [float(z) for z in np.linspace(-9, 9, 181)]
    got = [r[0] for r in spark.createDataFrame([(z,) for z in zs], "z double").select(normal_cdf(F.col("z"))).collect()]
    want = [0.5 * erfc(-z / sqrt(2)) for z in zs]
    assert np.allclose(got, want, rtol=1e-9, atol=1e-15)


def test_pvalue_tables(spark):
    rows = spark.createDataFrame([(-2.86,), (-3.43,), (3.0,), (-20.0,), (None,)], "s double").select(adf_pvalue(F.col("s"))).collect()
    assert abs(rows[0][0] - 0.05) < 0.001 and abs(rows[1][0] - 0.01) < 0.001
    assert [r[0] for r in rows[2:]] == [1.0, 0.0, None]
    k = spark.createDataFrame([(0.1,), (0.405,), (2.0,)], "s double").select(kpss_pvalue(F.col("s"))).collect()
    assert [round(r[0], 4) for r in k] == [0.1, 0.075, 0.01]


# ------------------------------------------------------------------- repair
def repaired(spark, values, **kw):
    rows = repair.repair(points(spark, {"s": values}), Params(**kw)).orderBy("t").collect()
    return [r["repaired"] for r in rows], [r["is_outlier"] for r in rows]


def test_low_points(spark):
    assert repaired(spark, [10, 11, 1, 13, 10])[0] == [10, 11, 12, 13, 10]
    assert repaired(spark, [1, 12, 10, 11, 10])[0][0] == 12
    assert repaired(spark, [10, 12, 10, 11, 1])[0][4] == 11
    assert repaired(spark, [10, 12, 1, 1, 18, 12])[0] == [10, 12, 14, 16, 18, 12]


def test_negative_series_is_left_alone(spark):
    got, flags = repaired(spark, [-10.0] * 6)
    assert got == [-10.0] * 6 and all(flags)
    assert not any(repaired(spark, [-10.0] * 6, repair_positive_median_only=True)[1])


def test_local_rule_needs_a_missing_neighbour(spark):
    assert not any(repaired(spark, [10, 10.1, 10, 500, 10, 10.1, 10])[1])
    assert repaired(spark, [10, 10.1, 10, 10.1, None, 500, None, 10, 10.1, 10])[1][5]


def test_unflagged_points_never_change(spark):
    rows = repair.repair(points(spark, some_series())).collect()
    assert all(r["is_outlier"] or r["repaired"] == r["v"] for r in rows)


# ------------------------------------------------------------------- screen
def test_zero_rules(spark):
    data = {"fifty": [0] * 50 + [10] * 60, "more": [0] * 51 + [10] * 60, "low": [-50.0] * 120, "zero": [0] * 120, "ok": list(range(5, 125))}
    got = {k[0]: v["zero_or_constant"] for k, v in table(screen.zero_flags(points(spark, data))).items()}
    assert got == {"fifty": False, "more": True, "low": True, "zero": True, "ok": False}
    off = screen.zero_flags(points(spark, data), Params(enable_zero_check=False))
    assert not any(r["zero_or_constant"] for r in off.collect())


def test_thresholds_pass_when_equal_or_missing(spark):
    cols = "series_id string, channel string, Trend double, Transition double, Seasonality double, Shifting double, Long_term_jsd double"
    rows = [("edge", "0", 0.75, 0.09, 0.64, -0.24, 0.3), ("gone", "0", None, None, float("nan"), None, None), ("bad", "0", 0.74, 0.0, 1.0, 0.0, 0.0)]
    got = {r[0]: r[1] for r in spark.createDataFrame(rows, cols).select("series_id", screen.passes_quality()).collect()}
    assert got == {"edge": True, "gone": True, "bad": False}


# --------------------------------------------------------------- statistics
def test_counts(spark):
    p = points(spark, {"s": [5, 4, 3, 2, 1], "flat": [1, 2, 2, 1, 3], "high": [9, 1, 9, 1]})
    inv = table(order.inversions(p))
    assert inv[("s", "0")]["inversions"] == 2.0
    f = table(stats.point_features(p, ["turning_points", "series_in_series"]))
    assert f[("flat", "0")]["turning_points"] == 1 / 5
    # every maximal run counts, also a leading one above the median
    assert f[("high", "0")]["series_in_series"] == 1.0


def test_constant_and_zero_series(spark):
    p = points(spark, {"c": [3.0] * 400, "z": [0.0] * 400})
    core = table(report.core_report(p))
    for k in ("c", "z"):
        r = core[(k, "0")]
        assert r["adf_pvalue"] is None and r["stability"] is None
        assert r["SB_TransitionMatrix_3ac_sumdiagcov"] is None and r["DN_OutlierInclude_p_001_mdrmd"] == 0.0
        assert r["short_term_jsd"] == 0.0 and r["long_term_jsd"] == 0.0
    simple = table(stats.other_features(p))
    assert simple[("z", "0")]["rsd"] is None and simple[("c", "0")]["skewness"] is None


def test_inversions_by_brute_force(spark):
    data = some_series(n=90)
    got = table(order.inversions(points(spark, data), block_len=16))
    for k, v in data.items():
        x = np.asarray(v)
        assert got[(k, "0")]["pairs"] == int(np.triu(x[:, None] > x[None, :], 1).sum())


# --------------------------------------------------------------- divergence
def bell(z):
    return math.exp(-z * z / 2) / math.sqrt(2 * math.pi)


def test_divergence_of_two_valued_windows(spark):
    """Half zeros, half ones: mean and deviation 1/2, and the least risk is that of the most bins, 100, of which only
    the first and last hold values.  The mixture is of densities, so it is scaled by its own sum."""
    windows = {"one": [0.0, 1.0] * 15, "two": ([0.0, 1.0] * 15 + [5.0, 7.0] * 15)}
    got = table(divergence.series_divergence(points(spark, windows)))
    bins = 100
    density = [bins / 2 if i in (0, bins - 1) else 0.0 for i in range(bins)]
    curve = [2 * bell(((i + 0.5) / bins - 0.5) * 2) for i in range(bins)]
    mixture = [(p + q) / 2 for p, q in zip(density, curve)]

    def against(p):
        total, other = sum(p), sum(mixture)
        return sum(x / total * math.log(x / total / (m / other)) for x, m in zip(p, mixture) if x > 0)

    want = (against(density) + against(curve)) / 2
    for k in windows:  # shifting and stretching a window changes nothing
        assert abs(got[(k, "0")]["short_term_jsd"] - want) < 1e-9 and got[(k, "0")]["long_term_jsd"] is None


def test_divergence_of_flat_and_short_windows(spark):
    rng = np.random.default_rng(3)
    noise = rng.normal(size=30)
    data = {"flat": [2.0] * 700, "half": [0.0] * 30 + list(noise), "noise": noise, "tail": list(noise) + [9.0] * 29, "short": [1.0, 2.0]}
    got = {k[0]: r["short_term_jsd"] for k, r in table(divergence.series_divergence(points(spark, data))).items()}
    assert got["flat"] == 0.0 and got["short"] is None
    assert abs(got["half"] - got["noise"] / 2) < 1e-12  # a window without spread counts as 0
    assert got["tail"] == got["noise"]  # an unfinished window is left out
    assert 0 < got["noise"] < math.log(2)


# ------------------------------------------------------------ decomposition
def slow_stl(y, p):
    """The published procedure, one point at a time."""

    def loess(y, q, at):
        n = len(y)
        out = []
        for x in at:
            if q >= n:
                lo, hi = 0, n
            else:
                lo = int(min(max(x - (q - 1) // 2, 0), n - q))
                hi = lo + q
            j = np.arange(lo, hi)
            h = max(x - lo, hi - 1 - x) + ((q - n) // 2 if q > n else 0)
            d = np.abs(j - x)
            w = np.where(d <= 0.001 * h, 1.0, np.where(d <= 0.999 * h, (1 - (d / h) ** 3) ** 3, 0))
            w = w / w.sum()
            a = (w * j).sum()
            c = (w * (j - a) ** 2).sum()
            if np.sqrt(c) > 0.001 * (n - 1):
                w = w * (1 + (x - a) * (j - a) / c)
            out.append((w * y[lo:hi]).sum())
        return np.array(out)

    n = len(y)
    odd = lambda k: k + (k % 2 == 0)
    qt, ql = odd(int(np.ceil(1.5 * p / (1 - 1.5 / 7)))), odd(p + 1)
    trend = np.zeros(n)
    for _ in range(5):
        c = np.empty(n + 2 * p)
        for k in range(p):
            sub = (y - trend)[k::p]
            c[k::p] = loess(sub, 7, np.arange(-1, len(sub) + 1))
        mean = lambda a, w: np.convolve(a, np.ones(w) / w, "valid")
        low = loess(mean(mean(mean(c, p), p), 3), ql, np.arange(n))
        seasonal = c[p : p + n] - low
        trend = loess(y - seasonal, qt, np.arange(n))
    return seasonal, trend


@pytest.mark.parametrize("n,p", [(100, 4), (131, 7), (200, 24), (36, 11), (300, 96)])
def test_stl_against_the_definition(n, p):
    y = np.random.default_rng(n).normal(size=n).cumsum() + np.sin(2 * np.pi * np.arange(n) / p)
    s, t = kernels.stl(y[None, :], p)
    s2, t2 = slow_stl(y, p)
    assert np.allclose(s[0], s2, atol=1e-8) and np.allclose(t[0], t2, atol=1e-8)


def test_sine_and_line(spark):
    t = np.arange(720)
    rng = np.random.default_rng(1)
    p = points(spark, {"sine": np.sin(2 * np.pi * t / 24) + 0.01 * rng.normal(size=720), "line": t * 1.0 + 0.1 * rng.normal(size=720)})
    core = table(report.core_report(p))
    sine, line = core[("sine", "0")], core[("line", "0")]
    assert sine["period_value1"] % 24 == 0 and sine["seasonal_strength1"] > 0.99 and sine["if_season"]
    assert line["trend_strength1"] > 0.99
    first = table(spectrum.candidate_periods(spectrum.spectrum(p)))[("sine", "0")]["detected"][0]
    assert first == 24


def test_padding(spark):
    p = points(spark, {"s": np.random.default_rng(0).normal(size=30)})
    tested = spectrum.tested_periods(spectrum.candidate_periods(spectrum.spectrum(p)))
    ps = table(tested)[("s", "0")]["periods"]
    assert all(4 <= x < 12 for x in ps)
    cols = "series_id string, channel string, period bigint, seasonal_strength double, trend_strength double"
    few = spark.createDataFrame([("s", "0", 4, 0.05, 0.5), ("s", "0", 7, 0.05, 0.6)], cols)
    plain = one(decompose.best_periods(few))
    assert (plain["period_value1"], plain["period_value2"], plain["period_value3"]) == (4, 7, 0)
    old = one(decompose.best_periods(few, compat=True))
    assert [old[f"period_value{i}"] for i in (1, 2, 3)] == [0, 0, 7] and old["seasonal_strength1"] == -1.0


# --------------------------------------------------------------- unit roots
def slow_adf(x):
    n = len(x)
    m = min(n // 2 - 2, int(np.ceil(12 * (n / 100) ** 0.25)))
    dx = np.diff(x)

    def fit(lags, start):
        t = np.arange(start, n - 1)
        z = np.column_stack([np.ones(len(t)), x[t], *[dx[t - k] for k in range(1, lags + 1)]])
        b, *_ = np.linalg.lstsq(z, dx[t], rcond=None)
        e = dx[t] - z @ b
        return b, e, z

    aic = []
    for lag in range(m + 1):
        b, e, z = fit(lag, m)
        aic.append(len(e) * np.log(e @ e / len(e)) + 2 * (lag + 2))
    best = int(np.argmin(aic))
    b, e, z = fit(best, best)
    cov = np.linalg.inv(z.T @ z) * (e @ e) / (len(e) - z.shape[1])
    return b[1] / np.sqrt(cov[1, 1]), best


def test_adf_against_least_squares(spark):
    data = some_series()
    got = table(unitroot.adf(points(spark, data)))
    for k, v in data.items():
        stat, lag = slow_adf(np.asarray(v, float))
        assert got[(k, "0")]["adf_lag"] == lag and abs(got[(k, "0")]["adf_stat"] - stat) < 1e-6, k
    assert got[("walk", "0")]["adf_pvalue"] > got[("noise", "0")]["adf_pvalue"] and got[("noise", "0")]["adf_pvalue"] < 0.05


# ------------------------------------------------------------------ library
def test_level_shift_and_impulse(spark):
    step = np.r_[np.zeros(100), np.ones(100)] + 1e-3 * np.random.default_rng(0).normal(size=200)
    r = one(library.shift_features(points(spark, {"s": step})))
    # windows 91..100 and 101..110 (1-based) meet at the step
    assert abs(r["max_level_shift"] - 2.0) < 0.05 and r["time_level_shift"] == 100
    pulse = np.zeros(200)
    pulse[150] = 1.0
    assert abs(one(symbolic.outlier_timing(points(spark, {"s": pulse})))["DN_OutlierInclude_p_001_mdrmd"] - (151 / 100 - 1)) < 1e-9


def test_pacf_of_an_autoregression(spark):
    rng = np.random.default_rng(5)
    x = np.zeros(3000)
    for i in range(1, 3000):
        x[i] = 0.7 * x[i - 1] + rng.normal()
    r = one(autocorr.acf_pacf(points(spark, {"s": x})))
    assert abs(r["x_pacf5"] - 0.49) < 0.06 and abs(r["x_acf1"] - 0.7) < 0.05


def test_arch_and_nonlinearity_against_least_squares(spark):
    x = np.asarray(some_series()["walk"])
    z = (x - x.mean()) / x.std(ddof=1)
    w = z * z
    a = np.column_stack([np.ones(len(w) - 12), *[w[12 - k : len(w) - k] for k in range(1, 13)]])
    e = w[12:] - a @ np.linalg.lstsq(a, w[12:], rcond=None)[0]
    want = 1 - e @ e / ((w[12:] - w[12:].mean()) ** 2).sum()
    p = points(spark, {"s": x})
    assert abs(one(library.arch_statistic(p))["arch_stat"] - want) < 1e-8
    y, l = z[1:], z[:-1]
    ssr = lambda m: ((y - m @ np.linalg.lstsq(m, y, rcond=None)[0]) ** 2).sum()
    stat = len(y) * np.log(ssr(np.column_stack([np.ones_like(l), l])) / ssr(np.column_stack([np.ones_like(l), l, l**2, l**3])))
    assert abs(one(library.nonlinearity(p))["nonlinearity"] - 10 * stat / len(x)) < 1e-6


def test_walker_by_loop(spark):
    x = np.asarray(some_series()["noise"])
    z = (x - x.mean()) / x.std(ddof=1)
    w = np.zeros(len(z))
    for i in range(1, len(z)):
        w[i] = w[i - 1] + 0.1 * (z[i - 1] - w[i - 1])
    want = np.mean((w[:-1] - z[:-1]) * (w[1:] - z[1:]) < 0)
    assert abs(one(library.walker_crossing(points(spark, {"s": x})))["walker_propcross"] - want) < 1e-12


# -------------------------------------------------------- channels, pipelines
def test_correlation_of_channels(spark):
    rng = np.random.default_rng(2)
    m = rng.normal(size=(7, 5))
    cols = [f"f{i}" for i in range(5)]
    rows = [("a", str(i), *map(float, r)) for i, r in enumerate(m)] + [("b", "0", *map(float, m[0]))]
    df = spark.createDataFrame(rows, "series_id string, channel string, " + ", ".join(f"{c} double" for c in cols))
    z = (m - m.min(0)) / (m.max(0) - m.min(0))
    c = np.abs(np.corrcoef(z))[np.triu_indices(7, 1)]
    want = 2 * (c.mean() + 1 / (c.var() + 2)) / 3
    for tile in (512, 2):
        got = {r[0]: r[1] for r in channels.correlation_score(df, cols, tile).collect()}
        assert abs(got["a"] - want) < 1e-9 and got["b"] is None


def test_clean_keeps_good_series_only(spark, tmp_path):
    t = np.arange(720)
    rng = np.random.default_rng(4)
    good = 20 + t * 0.02 + 5 * np.sin(2 * np.pi * t / 24) + 0.05 * rng.normal(size=720)
    good[300] = 0.5
    holes = good.copy()
    holes[5] = np.nan
    p = points(spark, {"good": good, "noise": rng.normal(size=720), "zero": np.zeros(720), "holes": holes})
    params = Params(transition_threshold=0.2, shifting_threshold=0.9)
    rows = table(pipeline.clean(p, params), ("t",))
    assert {k[0] for k in rows} == {"good"} and len(rows) == 720
    assert rows[("good", "0", 300)]["v"] > 10
    assert [r["series_id"] for r in report.rejects(p).collect()] == ["holes"]
    strict = pipeline.clean(p, Params(trend_threshold=2.0))
    pipeline.write_cleaned(strict, str(tmp_path / "none"))
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0


def test_report_columns(spark, tmp_path):
    p = points(spark, {"a": some_series()["sine"]})
    got = pipeline.profile(p, ["tiles", "hurst"])
    assert {"lumpiness", "tile_stability", "hurst", "seasonal_strength1"} <= set(got.columns)
    pipeline.write_report(got, str(tmp_path / "r"))
    short = spark.read.parquet(str(tmp_path / "r" / "short"))
    assert short.columns[2:] == ["Correlation", "Transition", "Shifting", "Seasonality", "Trend", "Stationarity", "Short_term_jsd", "Long_term_jsd"]
    with pytest.raises(ValueError):
        pipeline.profile(p, ["nothing"])
