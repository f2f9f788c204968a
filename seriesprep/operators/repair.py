"""Outlier flags and repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..layout import BLOCK_KEY, BLOCK_LEN, KEY, attach, earlier_blocks, in_order, later_blocks, longest_series, split_blocks, within
from ..params import Params
from .order import describe


def nearest(
    rows: DataFrame, value: Column, prev: str, next_: str, inclusive: bool, one_block: bool = False
) -> DataFrame:
    """Add the nearest non-null ``value`` on each side of every row, across blocks.

    ``rows`` carry a block and hold owned rows only.  Inside a block this is a
    window; across blocks one summary row per block is scanned.
    """
    edge = 0 if inclusive else 1
    w = in_order()
    rows = rows.withColumn("_x", value)
    back = w.rowsBetween(Window.unboundedPreceding, -edge)
    ahead = w.rowsBetween(edge, Window.unboundedFollowing)
    if one_block:
        return (
            rows.withColumn(prev, F.last("_x", ignorenulls=True).over(back))
            .withColumn(next_, F.first("_x", ignorenulls=True).over(ahead))
            .drop("_x")
        )
    at = F.when(F.col("_x").isNotNull(), F.col("t"))
    ends = rows.groupBy(*BLOCK_KEY).agg(F.min_by("_x", at).alias("_first"), F.max_by("_x", at).alias("_last"))
    carry = ends.select(
        *BLOCK_KEY,
        F.last("_last", ignorenulls=True).over(earlier_blocks()).alias("_before"),
        F.first("_first", ignorenulls=True).over(later_blocks()).alias("_after"),
    )
    return (
        rows.withColumn("_p", F.last("_x", ignorenulls=True).over(back))
        .withColumn("_n", F.first("_x", ignorenulls=True).over(ahead))
        .join(carry, BLOCK_KEY)
        .withColumn(prev, F.coalesce("_p", "_before"))
        .withColumn(next_, F.coalesce("_n", "_after"))
        .drop("_x", "_p", "_n", "_before", "_after")
    )


def rolling(points: DataFrame, window: int = 3, block_len: int = BLOCK_LEN) -> DataFrame:
    """Centred rolling mean and sample std; NULL unless the frame is full."""
    after = (window - 1) // 2
    before = window - 1 - after
    frame = in_order().rowsBetween(-before, after)
    full = F.count("v").over(frame) == window
    return (
        split_blocks(points, before, after, block_len)
        .withColumn("roll_mean", F.when(full, F.avg("v").over(frame)))
        .withColumn("roll_std", F.when(full, F.stddev_samp("v").over(frame)))
        .filter("own")
        .drop("own")
    )


def filled_rolling(
    points: DataFrame, window: int = 3, block_len: int = BLOCK_LEN, longest: int | None = None
) -> DataFrame:
    """Frames that are not full take the next one, else the previous one;
    a zero std becomes the std of the series."""
    points = within(points, longest)
    longest = longest_series(points, longest)
    rows = rolling(points, window, block_len)
    fit = F.when(
        F.col("roll_mean").isNotNull(), F.struct(F.col("roll_mean").alias("m"), F.col("roll_std").alias("s"))
    )
    rows = nearest(rows, fit, "_prev_fit", "_next_fit", inclusive=True, one_block=longest <= block_len)
    rows = attach(rows, describe(points, median=True, block_len=block_len, longest=longest), block_len)
    best = F.coalesce("_next_fit", "_prev_fit")
    return (
        rows.withColumn("roll_mean", best["m"])
        .withColumn("roll_std", F.when(best["s"] == 0, F.col("sd")).otherwise(best["s"]))
        .drop("_prev_fit", "_next_fit")
    )


def flag_outliers(
    points: DataFrame, params: Params = Params(), block_len: int = BLOCK_LEN, longest: int | None = None
) -> DataFrame:
    """Local deviation flag and extreme-low flag per point."""
    rows = filled_rolling(points, params.repair_window, block_len, longest)
    low = F.col("v") < F.col("med") * params.repair_low_ratio
    if params.repair_positive_median_only:
        low = low & (F.col("med") > 0)
    local = F.abs(F.col("v") - F.col("roll_mean")) > F.col("roll_std") * params.repair_threshold
    return rows.withColumn("local_outlier", F.coalesce(local, F.lit(False))).withColumn(
        "low_outlier", F.coalesce(low, F.lit(False))
    )


def repair(
    points: DataFrame, params: Params = Params(), block_len: int = BLOCK_LEN, longest: int | None = None
) -> DataFrame:
    """Flagged points are interpolated between the nearest unflagged ones.

    Anchors keep their original values; with one side missing the other is
    copied, with none the point stays.  Adds ``repaired`` and ``is_outlier``.
    """
    points = within(points, longest)
    longest = longest_series(points, longest)
    flags = flag_outliers(points, params, block_len, longest).select(
        *BLOCK_KEY, "t", "v", (F.col("local_outlier") | F.col("low_outlier")).alias("is_outlier")
    )
    anchor = F.when(~F.col("is_outlier"), F.struct("t", "v"))
    rows = nearest(flags, anchor, "_l", "_r", inclusive=False, one_block=longest <= block_len)
    left, right = F.col("_l"), F.col("_r")
    between = (right["v"] - left["v"]) / (right["t"] - left["t"]) * (F.col("t") - left["t"]) + left["v"]
    value = (
        F.when(~F.col("is_outlier"), F.col("v"))
        .when(left.isNotNull() & right.isNotNull(), between)
        .when(left.isNotNull(), left["v"])
        .when(right.isNotNull(), right["v"])
        .otherwise(F.col("v"))
    )
    return rows.select(*KEY, "t", "v", "is_outlier", value.alias("repaired"))
