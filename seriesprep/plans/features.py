"""Which operator computes which feature columns, so that unrequested ones cost nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..layout import BLOCK_LEN, longest_series
from ..operators import autocorr, library, spectrum, stats, symbolic, unitroot, whole
from .report import CORE_COLUMNS

CORE = CORE_COLUMNS

POINTWISE = [
    "skewness", "kurt", "rsd", "std_of_first_derivative", "turning_points", "series_in_series", "mean", "var",
    "CO_trev_1_num", "MD_hrv_classic_pnn40", "FC_LocalSimple_mean3_stderr", "crossing_points", "trev_num", "std1st_der",
]

# group -> (columns, function of the points, a supplier of shared inputs and the longest length)
GROUPS: dict[str, tuple[list[str], Callable]] = {
    "pointwise": (POINTWISE, lambda p, s, m: stats.point_features(p, POINTWISE, longest=m)),
    "inversions": (["inversions"], lambda p, s, m: stats.inversions(p, longest=m).drop("pairs")),
    "outlier_low": (["DN_OutlierInclude_n_001_mdrmd"], lambda p, s, m: symbolic.outlier_timing(p, -1)),
    "modes": (["DN_HistogramMode_5", "DN_HistogramMode_10", "histogram_mode"], lambda p, s, m: symbolic.histogram_modes(p)),
    "acf_points": (
        ["CO_f1ecac", "CO_FirstMin_ac", "firstmin_ac", "firstzero_ac"],
        lambda p, s, m: autocorr.acf_features(p, s("sums"), longest=m),
    ),
    "lag2_information": (["CO_HistogramAMI_even_2_5"], lambda p, s, m: symbolic.lag2_information(p)),
    "stretches": (
        ["SB_BinaryStats_mean_longstretch1", "SB_BinaryStats_diff_longstretch0"],
        lambda p, s, m: symbolic.long_stretches(p, longest=m),
    ),
    "periodicity": (["PD_PeriodicityWang_th0_01"], lambda p, s, m: library.periodicity(p, longest=m)),
    "embedding": (["CO_Embed2_Dist_tau_d_expfit_meandiff"], lambda p, s, m: library.embedding_misfit(p, longest=m)),
    "gaussian_information": (["IN_AutoMutualInfoStats_40_gaussian_fmmi"], lambda p, s, m: autocorr.gaussian_information(p)),
    "tau_ratio": (["FC_LocalSimple_mean1_tauresrat"], lambda p, s, m: library.residual_tau_ratio(p, s("sums"), longest=m)),
    "welch": (
        ["SP_Summaries_welch_rect_area_5_1", "SP_Summaries_welch_rect_centroid"],
        lambda p, s, m: library.welch_features(p, longest=m),
    ),
    "motif": (["SB_MotifThree_quantile_hh"], lambda p, s, m: symbolic.motif_entropy(p, longest=m)),
    "fluctuation": (
        ["SC_FluctAnal_2_rsrangefit_50_1_logi_prop_r1", "SC_FluctAnal_2_dfa_50_1_2_logi_prop_r1"],
        lambda p, s, m: library.fluctuation(p, longest=m),
    ),
    "kl_shift": (["max_kl_shift", "time_kl_shift"], lambda p, s, m: library.density_shift(p, longest=m)),
    "shifts": (
        ["max_level_shift", "time_level_shift", "max_var_shift", "time_var_shift"],
        lambda p, s, m: library.shift_features(p),
    ),
    "acf_pacf": (
        ["x_acf1", "x_acf10", "x_pacf5", "diff1_acf1", "diff1_acf10", "diff1x_pacf5", "diff2_acf1", "diff2_acf10", "diff2x_pacf5"],
        lambda p, s, m: autocorr.acf_pacf(p),
    ),
    "arch": (["arch_stat"], lambda p, s, m: library.arch_statistic(p)),
    "entropy": (["entropy"], lambda p, s, m: library.spectral_entropy(s("spectra"), s("bins"))),
    "flat_spots": (["flat_spots"], lambda p, s, m: symbolic.flat_spots(p)),
    "holt": (["alpha", "beta"], lambda p, s, m: library.holt_parameters(p)),
    "hurst": (["hurst"], lambda p, s, m: library.log_periodogram(s("spectra"), s("bins"))),
    "tiles": (["lumpiness", "tile_stability"], lambda p, s, m: library.tile_features(p).withColumnRenamed("stability", "tile_stability")),
    "nonlinearity": (["nonlinearity"], lambda p, s, m: library.nonlinearity(p)),
    "unitroot": (["unitroot_kpss", "unitroot_pp"], lambda p, s, m: unitroot.unitroot_stats(p, s("sums"), longest=m)),
    "walker": (["walker_propcross"], lambda p, s, m: library.walker_crossing(p)),
    "heterogeneity": (["arch_acf", "arch_r2"], lambda p, s, m: library.heterogeneity(p, longest=m)),
    "decomposition": (
        ["nperiods", "seasonal_period", "trend", "spike", "linearity", "curvature", "e_acf1", "e_acf10"],
        lambda p, s, m: library.trend_features(p, longest=m),
    ),
    "box_cox": (["lambdas"], lambda p, s, m: library.box_cox(p)),
}


def _groups(features: list[str] | None) -> list[str]:
    if features is None:
        return list(GROUPS)
    known = set(GROUPS) | set(CORE) | {c for cols, _ in GROUPS.values() for c in cols}
    unknown = [f for f in features if f not in known]
    if unknown:
        raise ValueError(f"unknown features: {unknown}")
    return [g for g, (cols, _) in GROUPS.items() if g in features or set(cols) & set(features)]


def columns_of(features: list[str]) -> set[str]:
    """Requested columns, groups expanded."""
    return {c for f in features for c in (GROUPS[f][0] if f in GROUPS else [f])}


def computed(
    points: DataFrame, features: list[str] | None = None, longest: int | None = None, placed: bool = False
) -> list[DataFrame]:
    """DataFrames of the needed groups, all keyed by series and channel.

    One per group; but of points that are ``placed`` by series (see ``arrange``), none longer than a block, all
    groups that have a one-row form come together, from one pass over the points.
    """
    longest = longest_series(points, longest)
    makers = {"sums": autocorr.lag_sums, "spectra": spectrum.spectrum, "bins": spectrum.long_bins}
    shared: dict[str, DataFrame | None] = {}

    def supply(name: str) -> DataFrame | None:
        if name not in shared:
            shared[name] = makers[name](points, longest=longest)
        return shared[name]

    groups = _groups(features)
    together = [g for g in groups if g in whole.COVERED] if placed and longest <= BLOCK_LEN else []
    out = [whole.features(points, together)] if together else []
    return out + [GROUPS[g][1](points, supply, longest) for g in groups if g not in together]
