"""The one-row forms of the feature groups: series that fit a block and lie by (series, channel).

A series is packed once, with its standardised values, and every group here is scored on that row, as
``report.core_whole`` does.  The block-wise operators give the same columns to series of any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import kernels, row_kernels
from ..functions.scalars import pretty_step
from ..layout import KEY

# group -> (the row's inputs, kernel, columns in the kernel's order)
SCORES: dict[str, tuple] = {
    "modes": (("z", "step"), row_kernels.modes, ["DN_HistogramMode_5", "DN_HistogramMode_10", "histogram_mode"]),
    "periodicity": (("z", "t"), row_kernels.periodicity, ["PD_PeriodicityWang_th0_01"]),
    "embedding": (("z", "t"), row_kernels.embedding, ["CO_Embed2_Dist_tau_d_expfit_meandiff"]),
    "tau_ratio": (("x", "t"), row_kernels.tau_ratio, ["FC_LocalSimple_mean1_tauresrat"]),
    "welch": (("z",), row_kernels.welch, ["SP_Summaries_welch_rect_area_5_1", "SP_Summaries_welch_rect_centroid"]),
    "kl_shift": (("z",), row_kernels.density, ["max_kl_shift", "time_kl_shift"]),
    "shifts": (("z", "t"), row_kernels.shifts, ["max_level_shift", "time_level_shift", "max_var_shift", "time_var_shift"]),
    "acf_pacf": (
        ("values", "t"),
        row_kernels.acf_pacf,
        ["x_acf1", "x_acf10", "x_pacf5", "diff1_acf1", "diff1_acf10", "diff1x_pacf5", "diff2_acf1", "diff2_acf10", "diff2x_pacf5"],
    ),
    "arch": (("z",), row_kernels.arch, ["arch_stat"]),
    "holt": (("z",), row_kernels.holt, ["alpha", "beta"]),
    "tiles": (("z", "t"), row_kernels.tiles, ["lumpiness", "tile_stability"]),
    "nonlinearity": (("z",), row_kernels.nonlinearity, ["nonlinearity"]),
    "heterogeneity": (("z",), row_kernels.heterogeneity, ["arch_acf", "arch_r2"]),
    "decomposition": (("z",), row_kernels.decomposition, ["trend", "spike", "linearity", "curvature", "e_acf1", "e_acf10"]),
    "walker": (("z",), row_kernels.walker, ["walker_propcross"]),
    "lag2_information": (("z",), row_kernels.lag2_information, ["CO_HistogramAMI_even_2_5"]),
    "stretches": (
        ("values", "t", "mean"),
        row_kernels.stretches,
        ["SB_BinaryStats_mean_longstretch1", "SB_BinaryStats_diff_longstretch0"],
    ),
    "motif": (("values",), row_kernels.motif, ["SB_MotifThree_quantile_hh"]),
    "flat_spots": (("values", "t"), row_kernels.flat_spots, ["flat_spots"]),
    "gaussian_information": (("values", "t", "mean"), row_kernels.gaussian, ["IN_AutoMutualInfoStats_40_gaussian_fmmi"]),
    "box_cox": (("values", "t"), row_kernels.box_cox, ["lambdas"]),
}
COVERED = {*SCORES, "outlier_low"}
# constant series have no standardised values; these columns are fixed there
CONSTANT = {"lumpiness": 0.0, "tile_stability": 0.0, "max_level_shift": 0.0, "max_var_shift": 0.0}
COUNTS = {"flat_spots"}
FIXED = {"decomposition": {"nperiods": 0.0, "seasonal_period": 1.0}}


def packed(points: DataFrame) -> DataFrame:
    """One row per series: times, values, and for series that vary the values ``x`` and ``z``, standardised."""
    rows = points.groupBy(*KEY).agg(
        F.sort_array(F.collect_list(F.struct("t", "v"))).alias("tv"),
        F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("sd"),
    )
    rows = rows.select(*KEY, F.col("tv.t").alias("t"), F.col("tv.v").alias("values"), "mean", "sd")
    z = F.transform("values", lambda v: (v - F.col("mean")) / F.col("sd"))
    varies = F.col("sd") > 0
    rows = rows.withColumn("z", F.when(varies, z)).withColumn("x", F.when(varies, F.col("values")))
    rows = rows.withColumn("low", F.array_min("z")).withColumn("high", F.array_max("z"))
    return rows.withColumn("step", pretty_step(F.col("low"), F.col("high"), 10))


def features(points: DataFrame, groups: list[str]) -> DataFrame:
    """The columns of ``groups``, all of them COVERED, in one pass over the points."""
    chosen = {g: SCORES[g] for g in groups if g in SCORES}
    scored = [score(*inputs).alias(f"_{g}") for g, (inputs, score, _) in chosen.items()]
    if "outlier_low" in groups:
        scored.append(kernels.outlier_timing_whole("values", "mean", "sd", F.lit(-1)).alias("DN_OutlierInclude_n_001_mdrmd"))
    rows = packed(points).select(*KEY, *scored)

    def column(g: str, i: int, name: str) -> Column:
        found = F.get(f"_{g}", F.lit(i))
        found = F.coalesce(found, F.lit(CONSTANT[name])) if name in CONSTANT else found
        return (found.cast("bigint") if name in COUNTS else found).alias(name)

    out = [column(g, i, name) for g, (_, _, names) in chosen.items() for i, name in enumerate(names)]
    out += [F.lit(x).alias(name) for g in chosen for name, x in FIXED.get(g, {}).items()]
    return rows.select(*KEY, *out, *(["DN_OutlierInclude_n_001_mdrmd"] if "outlier_low" in groups else []))
