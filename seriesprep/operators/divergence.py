"""Divergence of windowed histograms from the fitted normal curve (AGG13-AGG16, W9)."""

from __future__ import annotations

from math import lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import kernels
from ..layout import BLOCK_LEN, KEY, to_blocks


def aligned_block_len(windows: tuple[int, ...], block_len: int = BLOCK_LEN) -> int:
    """Smallest multiple of all windows that is at least ``block_len``."""
    unit = lcm(*windows)
    return -(-block_len // unit) * unit


def window_divergence(points: DataFrame, window: int, block_len: int = BLOCK_LEN) -> DataFrame:
    """AGG14 per window: ``window_id`` and ``jsd`` of every full window."""
    size = aligned_block_len((window,), block_len)
    jsd = kernels.window_jsd_udf(window)
    return (
        to_blocks(points, block_len=size)
        .select(*KEY, "block", F.posexplode(jsd("values")).alias("i", "jsd"))
        .select(*KEY, (F.col("block") * (size // window) + F.col("i")).alias("window_id"), "jsd")
    )


def divergence(blocks: DataFrame, short: int = 30, long: int = 336) -> DataFrame:
    """AGG15/AGG16 from aligned blocks: mean divergence of the short and long windows.

    One pass over the blocks gives the sum and count per block; a series with no
    full window of a size gets NULL.
    """
    parts = blocks.select(
        *KEY,
        kernels.window_jsd_udf(short)("values").alias("a"),
        kernels.window_jsd_udf(long)("values").alias("b"),
    )

    def total(c):
        return F.aggregate(c, F.lit(0.0), lambda s, x: s + x)

    return (
        parts.groupBy(*KEY)
        .agg(*[f(x).alias(n) for x, n in (("a", "short"), ("b", "long")) for f, n in (
            (lambda c: F.sum(total(c)), n + "_sum"), (lambda c: F.sum(F.size(c)), n + "_count"))])
        .select(
            *KEY,
            F.try_divide("short_sum", "short_count").alias("short_term_jsd"),
            F.try_divide("long_sum", "long_count").alias("long_term_jsd"),
        )
    )


def series_divergence(
    points: DataFrame, short: int = 30, long: int = 336, block_len: int = BLOCK_LEN
) -> DataFrame:
    """AGG16 from points."""
    return divergence(to_blocks(points, block_len=aligned_block_len((short, long), block_len)), short, long)


def js_divergence(bins: DataFrame, key: list[str], p: str, q: str) -> DataFrame:
    """MATH6: divergence of two columns of bin masses per key, natural log.

    The midpoint uses the masses as given; all three are then normalised.
    """
    w = Window.partitionBy(*key)
    mid = (F.col(p) + F.col(q)) / 2
    rows = (
        bins.withColumn("_m", mid)
        .withColumn("_sp", F.sum(p).over(w))
        .withColumn("_sq", F.sum(q).over(w))
        .withColumn("_sm", F.sum("_m").over(w))
    )

    def term(mass: str, total: str) -> Column:
        share = F.col(mass) / F.col(total)
        return F.when(F.col(mass) > 0, share * F.log(share / (F.col("_m") / F.col("_sm")))).otherwise(F.lit(0.0))

    return rows.groupBy(*key).agg(((F.sum(term(p, "_sp")) + F.sum(term(q, "_sq"))) / 2).alias("jsd"))
