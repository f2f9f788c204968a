"""The feature report: all columns of the screen for every series (REP1-REP5, MATH14).

A series that fits one block is a row with its values: every report column is
computed on that row and nothing is shuffled after the values are together.
Longer series go through the block-wise operators, which give the same columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.scalars import adf_pvalue, kpss_pvalue
from ..layout import BLOCK_KEY, BLOCK_LEN, KEY, arrays_to_blocks, arrays_to_points, longest_series, to_blocks, within
from ..operators import autocorr, decompose, divergence, spectrum, symbolic, unitroot
from ..params import Params

PERIOD_COLUMNS = [f"{x}{i}" for i in (1, 2, 3) for x in ("period_value", "seasonal_strength", "trend_strength")]
TEST_COLUMNS = ["if_season", "if_trend", "adf_pvalue", "kpss_pvalue", "stability"]
CORE_COLUMNS = [
    "length",
    *PERIOD_COLUMNS,
    *TEST_COLUMNS,
    "short_term_jsd",
    "long_term_jsd",
    "SB_TransitionMatrix_3ac_sumdiagcov",
    "DN_OutlierInclude_p_001_mdrmd",
]

# Report name of each screen column.
SHORT_REPORT = {
    "correlation": "Correlation",
    "SB_TransitionMatrix_3ac_sumdiagcov": "Transition",
    "DN_OutlierInclude_p_001_mdrmd": "Shifting",
    "seasonal_strength1": "Seasonality",
    "trend_strength1": "Trend",
    "adf_pvalue": "Stationarity",
    "short_term_jsd": "Short_term_jsd",
    "long_term_jsd": "Long_term_jsd",
}


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def core_whole(rows: DataFrame, params: Params = Params()) -> DataFrame:
    """CORE_COLUMNS for rows (KEY, values) that each hold a whole series."""
    n = F.col("length")
    rows = rows.withColumn("length", F.size("values").cast("bigint")).filter("length > 0")
    rows = rows.withColumn("mean", _total(F.col("values")) / n)
    square = F.aggregate(
        "values", F.lit(0.0), lambda s, x: s + (x - F.col("mean")) * (x - F.col("mean"))
    )
    rows = rows.withColumn("sd", F.sqrt(F.try_divide(square, n - 1)))
    rows = rows.withColumn("lags", unitroot.adf_lags(n))
    testable = (n >= 4) & (F.col("sd") > 0)
    safe_lags = F.when(testable, F.col("lags")).otherwise(F.lit(0))
    gram = kernels.adf_gram("values", F.lit(0), F.lit(0), safe_lags, "mean")
    rows = rows.select(
        *KEY,
        "values",
        "length",
        "mean",
        "sd",
        kernels.amplitudes("values").alias("amps"),
        kernels.lag_products("values", "values", "mean", F.lit(0), n).alias("s"),
        kernels.window_jsd_udf(params.short_window)("values").alias("a"),
        kernels.window_jsd_udf(params.long_window)("values").alias("b"),
        kernels.outlier_timing_whole("values", "mean", "sd", F.lit(1)).alias("DN_OutlierInclude_p_001_mdrmd"),
        F.when(testable, kernels.adf_solve(gram, "values", safe_lags, "length", "mean")["stat"]).alias("adf_stat"),
    )
    tested = rows.withColumn("n", n)
    tested = spectrum.with_candidates(tested, params.compat)
    tested = spectrum.tested_periods(tested)
    moments = kernels.stl_moments("values", "periods", F.lit(0), n, n)
    tau = F.coalesce(autocorr.first_index(F.col("s"), lambda x, _: x <= 0), n)
    lags = unitroot.kpss_lags(F.col("s"), n)
    run = unitroot.running_sums(F.col("values"), F.col("mean"))
    rows = tested.select(
        *KEY,
        "values",
        "length",
        "sd",
        "s",
        "periods",
        F.try_divide(_total(F.col("a")), F.size("a")).alias("short_term_jsd"),
        F.try_divide(_total(F.col("b")), F.size("b")).alias("long_term_jsd"),
        "DN_OutlierInclude_p_001_mdrmd",
        "adf_stat",
        moments.alias("p"),
        tau.alias("tau"),
        F.when(F.col("sd") > 0, lags).alias("kpss_lag"),
        run["c2"].alias("q"),
    )
    stat = unitroot.kpss_statistic(F.col("q"), F.col("s"), F.col("kpss_lag"), n, F.col("sd"))
    best = decompose.best_of(decompose.moment_strengths(F.col("p"), F.col("periods")), params.compat)
    rows = rows.withColumn("kpss_stat", stat).withColumn("best", best)
    pvalues = unitroot.joint_pvalues(adf_pvalue(F.col("adf_stat")), kpss_pvalue(F.col("kpss_stat")))
    shift = symbolic.transition_whole(F.col("values"), F.col("tau"))
    return rows.select(
        *KEY,
        "length",
        *decompose.best_columns(F.col("best")),
        *pvalues,
        "short_term_jsd",
        "long_term_jsd",
        F.when(F.col("sd") > 0, shift).alias("SB_TransitionMatrix_3ac_sumdiagcov"),
        "DN_OutlierInclude_p_001_mdrmd",
    ).select(
        *KEY,
        "length",
        *PERIOD_COLUMNS,
        *decompose.season_flags(),
        "adf_pvalue",
        "kpss_pvalue",
        "stability",
        *CORE_COLUMNS[-4:],
    )


def core_blockwise(
    points: DataFrame, params: Params = Params(), block_len: int = BLOCK_LEN, longest: int | None = None
) -> DataFrame:
    """CORE_COLUMNS from points of any length, block by block."""
    points = within(points, longest)
    longest = longest_series(points, longest)
    sums = autocorr.lag_sums(points, block_len, longest)
    tested = spectrum.tested_periods(spectrum.series_candidates(points, params.compat, block_len, longest))
    periods = decompose.best_periods(
        decompose.strengths(points, tested, block_len), tested, compat=params.compat
    )
    jsd = divergence.series_divergence(points, params.short_window, params.long_window, block_len)
    parts = [
        periods,
        unitroot.stationarity(points, sums, block_len, longest),
        jsd,
        symbolic.transition(points, sums, block_len, longest),
        symbolic.outlier_timing(points, 1, block_len),
    ]
    out = points.groupBy(*KEY).agg(F.count("*").alias("length"))
    for part in parts:
        out = out.join(part, KEY, "left")
    return out.select(*KEY, *CORE_COLUMNS)


def core_report(
    points: DataFrame, params: Params = Params(), block_len: int = BLOCK_LEN, longest: int | None = None, placed: bool = False
) -> DataFrame:
    """CORE_COLUMNS for points of mixed lengths; ``longest`` skips the length probe, and points that are
    ``placed`` by series (see ``arrange``) are not moved."""
    points = within(points, longest)
    longest = longest_series(points, longest)
    size = divergence.aligned_block_len((params.short_window, params.long_window), block_len)
    # without a count of its own, so that the partitions follow the size of the data
    spread = points.withColumn("block", F.floor(F.col("t") / size))
    spread = spread if placed else spread.repartition(*BLOCK_KEY)
    blocks = to_blocks(spread, block_len=size)
    whole = (F.col("block") == 0) & (F.size("values") < size)
    out = core_whole(blocks.filter(whole).select(*KEY, "values"), params)
    if longest < size:
        return out
    rest = blocks.filter(~whole).select(*KEY, "lo", F.posexplode("values").alias("i", "v"))
    rest = rest.select(*KEY, (F.col("lo") + F.col("i")).alias("t"), "v")
    return out.unionByName(core_blockwise(rest, params, size, longest))


def core_report_arrays(arrays: DataFrame, params: Params = Params(), block_len: int = BLOCK_LEN) -> DataFrame:
    """CORE_COLUMNS for sample arrays: no shuffle for those that fit a block, block by block for longer ones."""
    size = divergence.aligned_block_len((params.short_window, params.long_window), block_len)
    n = F.size("values")
    longest = arrays.agg(F.max(n)).first()[0] or 0
    blocks = arrays_to_blocks(arrays.filter(n < size), block_len=size)
    out = core_whole(blocks.select(*KEY, "values"), params)
    if longest < size:
        return out
    return out.unionByName(core_blockwise(arrays_to_points(arrays.filter(n >= size)), params, size, longest))


def rejects(points: DataFrame) -> DataFrame:
    """Series with missing observations: they are reported, not profiled."""
    bad = points.groupBy(*KEY).agg(F.count("*").alias("n"), F.count("v").alias("present"))
    return bad.filter("present < n").select(*KEY, F.lit("missing observations").alias("reason"))


def short_report(report: DataFrame) -> DataFrame:
    """REP2-REP4: eight named columns; correlation is NULL unless it was computed."""
    if "correlation" not in report.columns:
        report = report.withColumn("correlation", F.lit(None).cast("double"))
    report = report.withColumn("DN_OutlierInclude_p_001_mdrmd", F.abs("DN_OutlierInclude_p_001_mdrmd"))
    keys = [k for k in KEY if k in report.columns]
    return report.select(*keys, *[F.col(a).alias(b) for a, b in SHORT_REPORT.items()])
