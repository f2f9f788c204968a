"""Every operator gives the same rows when a series is cut into many blocks."""

import pytest
from pyspark.sql import functions as F

from helpers import assert_same, points, some_series
from seriesprep.operators import autocorr, decompose, divergence, library, order, repair, spectrum, stats, symbolic, unitroot
from seriesprep.plans import report
from seriesprep.sources import tables

SMALL = 60


def periods(spark, p, longest=None, block_len=10**6):
    return spectrum.tested_periods(spectrum.candidate_periods(spectrum.spectrum(p, block_len, longest)))


def all_lags(p, b):
    """Every lag of every series: from the rows of whole series, or from lag rows."""
    if b > 1000:
        return autocorr.lag_sums(p, b).select("series_id", "channel", "n", "s")
    lags = autocorr.lag_rows(p, order.describe(p), b)
    packed = lags.groupBy("series_id", "channel", "n").agg(F.sort_array(F.collect_list(F.struct("t", "s"))).alias("ts"))
    return packed.select("series_id", "channel", "n", F.col("ts.s").alias("s"))


CASES = {
    "quantiles": lambda p, b: order.quantiles(p, {"a": 0.25, "b": 0.5, "c": 0.9}, block_len=b),
    "midpoint": lambda p, b: order.quantiles(p, {"a": 1 / 3, "b": 2 / 3}, midpoint=True, block_len=b),
    "inversions": lambda p, b: order.inversions(p, b),
    "points": lambda p, b: stats.point_features(p, list(stats.POINT_FEATURES), b),
    "repair": lambda p, b: repair.repair(p, block_len=b),
    "lag_sums_short": lambda p, b: autocorr.lag_sums(p, b).selectExpr("series_id", "channel", "n", "sd", "slice(s, 1, 30) AS s"),
    "acf_features": lambda p, b: autocorr.acf_features(p, autocorr.lag_sums(p, b), b),
    "lag_sums_full": lambda p, b: all_lags(p, b),
    "periodicity": lambda p, b: library.periodicity(p, b),
    "acf_pacf": lambda p, b: autocorr.acf_pacf(p, b),
    "gaussian": lambda p, b: autocorr.gaussian_information(p, b),
    "tau": lambda p, b: autocorr.first_nonpositive(p, autocorr.lag_sums(p, b), b),
    "adf": lambda p, b: unitroot.adf(p, b),
    "cumulative": lambda p, b: unitroot.cumulative_square(p, b),
    "phillips_perron": lambda p, b: unitroot.phillips_perron(p, b),
    "transition": lambda p, b: symbolic.transition(p, autocorr.lag_sums(p, b), b),
    "timing": lambda p, b: symbolic.outlier_timing(p, 1, b),
    "timing_low": lambda p, b: symbolic.outlier_timing(p, -1, b),
    "motif": lambda p, b: symbolic.motif_entropy(p, b),
    "modes": lambda p, b: symbolic.histogram_modes(p, b),
    "information": lambda p, b: symbolic.lag2_information(p, b),
    "stretches": lambda p, b: symbolic.long_stretches(p, b),
    "flat": lambda p, b: symbolic.flat_spots(p, b),
    "tiles": lambda p, b: library.tile_features(p, block_len=b),
    "shifts": lambda p, b: library.shift_features(p, block_len=b),
    "kl": lambda p, b: library.density_shift(p, block_len=b),
    "arch": lambda p, b: library.arch_statistic(p, block_len=b),
    "nonlinearity": lambda p, b: library.nonlinearity(p, b),
    "heterogeneity": lambda p, b: library.heterogeneity(p, b),
    "welch": lambda p, b: library.welch_features(p, b),
    "fluctuation": lambda p, b: library.fluctuation(p, b),
    "walker": lambda p, b: library.walker_crossing(p, b),
    "holt": lambda p, b: library.holt_parameters(p, b),
    "box_cox": lambda p, b: library.box_cox(p, b),
    "trend": lambda p, b: library.trend_features(p, b),
    "embedding": lambda p, b: library.embedding_misfit(p, b),
    "jsd": lambda p, b: divergence.series_divergence(p, 10, 30, b),
    "drop_missing": lambda p, b: tables.drop_missing(p, b),
    "candidates": lambda p, b: spectrum.series_candidates(p, False, b).selectExpr("series_id", "channel", "n", "array_join(detected, ',') AS d"),
    "amplitudes": lambda p, b: spectrum.spectrum_bins(p, b),
    "entropy": lambda p, b: library.spectral_entropy(spectrum.spectrum(p, b), spectrum.long_bins(p, b), b),
    "hurst": lambda p, b: library.log_periodogram(spectrum.spectrum(p, b), spectrum.long_bins(p, b)),
}
EXTRA = {"repair": ("t",), "drop_missing": ("t",), "amplitudes": ("k",)}


@pytest.mark.parametrize("name", CASES)
def test_blocks_do_not_matter(spark, name):
    p = points(spark, some_series()).repartition(4).cache()
    assert_same(CASES[name](p, 10**6), CASES[name](p, SMALL), EXTRA.get(name, ()), 1e-6)


def test_strengths(spark):
    p = points(spark, some_series())
    tested = periods(spark, p, 230).cache()
    assert_same(decompose.strengths(p, tested), decompose.strengths(p, tested, SMALL), ("period",))


def test_components(spark):
    p = points(spark, some_series(n=600))
    assert_same(decompose.components(p, 4), decompose.components(p, 4, 100), ("t",))


def test_report_forms(spark):
    """Whole-row form, block-wise form and the mix of both agree."""
    from seriesprep.params import Params

    params = Params(short_window=10, long_window=30)
    p = points(spark, some_series()).cache()
    whole = report.core_report(p, params, longest=230)
    assert_same(whole, report.core_blockwise(p, params), tol=1e-6)
    assert_same(whole, report.core_report(p, params, block_len=90), tol=1e-6)
    arrays = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in some_series().items()], "series_id string, values array<double>")
    assert_same(whole, report.core_report_arrays(arrays, params), tol=1e-6)
    assert_same(whole, report.core_report_arrays(arrays, params, block_len=90), tol=1e-6)


def test_a_bound_that_is_too_small_is_an_error(spark):
    p = points(spark, some_series())
    for run in (lambda: report.core_report(p, longest=50, block_len=90), lambda: repair.repair(p, longest=50), lambda: order.quantiles(p, {"a": 0.5}, longest=50)):
        with pytest.raises(Exception, match="longer than longest=50"):
            run().collect()
