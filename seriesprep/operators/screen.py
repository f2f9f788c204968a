"""Zero/constant detection, quality screen and reject reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..layout import KEY
from ..params import Params


def zero_profile(points: DataFrame, params: Params = Params()) -> DataFrame:
    """F3-F5 inputs and flags, one aggregation per series, partial sums first."""
    head = F.col("t") < params.zero_check_len
    is_zero = F.coalesce(F.col("v") == 0, F.lit(False))
    agg = points.groupBy(*KEY).agg(
        F.avg(F.when(head, is_zero.cast("int"))).alias("zero_ratio"),
        F.coalesce(F.min(F.when(~is_zero, F.col("t"))), F.count("*")).alias("zero_streak"),
        F.avg(F.when(head, F.col("v"))).alias("_m"),
        F.stddev_pop(F.when(head, F.col("v"))).alias("_s"),
        F.count(F.when(head & F.col("v").isNull(), 1)).alias("_gaps"),
    )
    no_gap = F.col("_gaps") == 0
    flat = (F.col("_m") < params.near_zero_threshold) & (F.col("_s") < params.zero_std_threshold) & no_gap
    return agg.select(
        *KEY,
        "zero_ratio",
        "zero_streak",
        F.when(no_gap, F.col("_m")).alias("head_mean"),
        F.when(no_gap, F.col("_s")).alias("head_std"),
        (F.col("zero_ratio") > params.zero_ratio_threshold).alias("mostly_zero"),
        (F.col("zero_streak") > params.zero_streak_threshold).alias("leading_zeros"),
        F.coalesce(flat, F.lit(False)).alias("nearly_constant"),
    )


def zero_flags(points: DataFrame, params: Params = Params()) -> DataFrame:
    """is the series zero or constant?  Always false when the check is off."""
    flag = F.col("mostly_zero") | F.col("leading_zeros") | F.col("nearly_constant")
    if not params.enable_zero_check:
        flag = F.lit(False)
    return zero_profile(points, params).withColumn("zero_or_constant", flag)


def quality_tests(params: Params = Params()) -> dict[str, Column]:
    """Reject tests over the report columns; a missing metric never rejects."""
    tests = {
        "trend": F.col("Trend") < params.trend_threshold,
        "transition": F.col("Transition") > params.transition_threshold,
        "seasonality": F.col("Seasonality") < params.seasonality_threshold,
        "shifting": F.abs("Shifting") > params.shifting_threshold,
        "long_term_jsd": F.col("Long_term_jsd") > params.long_term_jsd_threshold,
    }

    def known(name: str, test: Column) -> Column:
        column = {"long_term_jsd": "Long_term_jsd"}.get(name, name.capitalize())
        return F.coalesce(test & ~F.isnan(column), F.lit(False))

    return {k: known(k, t) for k, t in tests.items()}


def passes_quality(params: Params = Params()) -> Column:
    """F1 as one boolean column over the report columns."""
    rejected = F.lit(False)
    for test in quality_tests(params).values():
        rejected = rejected | test
    return ~rejected


def with_verdict(report: DataFrame, zeros: DataFrame, params: Params = Params()) -> DataFrame:
    """the report with the zero flag, reject reasons and ``keep``.

    Both sides hold one row per series, so the join never meets a hot key.
    """
    tests = {**quality_tests(params), "zero_or_constant": F.coalesce("zero_or_constant", F.lit(False))}
    reasons = F.array_compact(F.array(*[F.when(t, F.lit(k)) for k, t in tests.items()]))
    return (
        report.join(zeros.select(*KEY, "zero_or_constant"), KEY, "left")
        .withColumn("reasons", reasons)
        .withColumn("keep", F.size("reasons") == 0)
    )
