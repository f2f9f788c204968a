"""Exact ranks, quantiles and inversion counts without collecting a series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import kernels
from ..layout import BLOCK_KEY, BLOCK_LEN, KEY, attach, longest_series, split_blocks, to_blocks, within


SPLITTERS = 1024  # quantiles that a summary of a series is asked for


def by_value(points: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """``(KEY, n, block, t, v, bucket)``: every present point with a bucket that follows the order of values.

    The bucket borders are quantiles from mergeable summaries, about four to a block, so they follow the
    data however skewed it is.  A value that takes a large share of a series is itself a border: borders have
    buckets of their own (odd numbers), which hold one value only, so whoever orders them may cut them by t.
    """
    fractions = F.array(*[F.lit(i / SPLITTERS) for i in range(1, SPLITTERS)])
    shape = points.groupBy(*KEY).agg(F.count("*").alias("n"), F.percentile_approx("v", fractions, 10 * SPLITTERS).alias("q"))
    parts = F.least(F.ceil(F.col("n") / block_len) * 4, F.lit(SPLITTERS)).cast("int")
    chosen = F.transform(F.sequence(F.lit(1), parts - 1), lambda i: F.get("q", F.floor(i * SPLITTERS / parts).cast("int") - 1))
    none = F.array().cast("array<double>")
    shape = shape.select(*KEY, "n", F.when(F.col("n") > block_len, chosen).otherwise(none).alias("q"))
    packed = split_blocks(points, block_len=block_len).groupBy(*BLOCK_KEY).agg(F.sort_array(F.collect_list(F.struct("t", "v"))).alias("tv"))
    cover = points.groupBy(*KEY).agg((F.max("t") + 1).alias("n"))  # t may have gaps
    rows = attach(packed, cover, block_len).drop("n").join(
        # per block, so that the key of a long series isn't hot
        cover.join(shape.withColumnRenamed("n", "_n"), KEY)
        .select(*KEY, "_n", "q", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / block_len))).alias("block")),
        BLOCK_KEY,
    )
    zipped = F.arrays_zip(F.col("tv.t").alias("t"), F.col("tv.v").alias("v"), kernels.value_slots("tv.v", "q").alias("bucket"))
    return rows.select(*BLOCK_KEY, F.col("_n").alias("n"), F.explode(zipped).alias("x")).select(*KEY, "n", "block", "x.*")


def ranked(points: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """Add ``n`` and ``rank`` (0-based, by value then t) to every present point.

    Ranks inside a bucket of ``by_value`` come from a window, the offset of a bucket from the counts of the lower
    ones.  A bucket of equal values is cut by the block of t, which is its order.
    """
    rows = by_value(points, block_len).withColumn("sub", F.when(F.col("bucket") % 2 == 1, F.col("block")).otherwise(F.lit(0)))
    key = [*KEY, "bucket", "sub"]
    counts = rows.groupBy(*key).agg(F.count("*").alias("_c"))
    lower = Window.partitionBy(*KEY).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = counts.groupBy(*KEY, "bucket").agg(F.sum("_c").alias("_c"))
    buckets = buckets.select(*KEY, "bucket", F.coalesce(F.sum("_c").over(lower), F.lit(0)).alias("_base"))
    earlier = Window.partitionBy(*KEY, "bucket").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    offset = counts.select(*key, F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_part")).join(buckets, [*KEY, "bucket"])
    inside = Window.partitionBy(*key).orderBy("v", "t")
    placed = rows.withColumn("_r", F.row_number().over(inside) - 1).join(offset, key)
    rank = F.col("_base") + F.col("_part") + F.col("_r")
    return placed.select(*KEY, "n", "t", "v", rank.alias("rank"))


def array_at(sorted_values: Column, pos: Column) -> Column:
    """Linear interpolation in a sorted array at a fractional 0-based position."""
    lo = F.floor(pos)
    a = F.get(sorted_values, lo.cast("int"))
    b = F.get(sorted_values, F.ceil(pos).cast("int"))
    return a + (pos - lo) * (b - a)


def quantiles(
    points: DataFrame,
    probs: dict[str, float],
    midpoint: bool = False,
    block_len: int = BLOCK_LEN,
    longest: int | None = None,
) -> DataFrame:
    """Exact quantiles of the present values, one column per entry of ``probs``.

    ``midpoint=False`` interpolates between ranks ``q*(n-1)`` (the median and the
    usual linear rule); ``midpoint=True`` uses ``q*n - 0.5``.  A series that fits
    one block is sorted inside its row; longer ones go through ``ranked``.
    """
    points = within(points, longest)
    present = points.filter(F.col("v").isNotNull()).select(*KEY, "t", "v")

    def pos(n: Column, q: float) -> Column:
        p = n * q - 0.5 if midpoint else (n - 1) * q
        return F.least(F.greatest(p, F.lit(0.0)), n - 1)

    longest = longest_series(points, longest)

    def in_row(whole: DataFrame) -> DataFrame:
        ordered = whole.withColumn("s", F.array_sort("values")).withColumn("n", F.size("s"))
        return ordered.select(*KEY, *[array_at(F.col("s"), pos(F.col("n"), q)).alias(k) for k, q in probs.items()])

    blocks = to_blocks(present, block_len=block_len)
    if longest <= block_len:
        return in_row(blocks)
    counts = present.groupBy(*KEY).agg(F.count("*").alias("n"), F.max("t").alias("_tmax"))
    short = blocks.filter("block = 0").join(
        counts.filter(F.col("_tmax") < block_len), KEY, "left_semi"
    )
    small = in_row(short)

    long_keys = counts.filter(F.col("_tmax") >= block_len).select(
        *KEY, F.explode(F.sequence(F.lit(0), F.floor(F.col("_tmax") / block_len))).alias("block")
    )
    long_points = split_blocks(present, block_len=block_len).join(long_keys, BLOCK_KEY).drop("block", "own")
    r = ranked(long_points, block_len=block_len)
    terms = []
    for k, q in probs.items():
        p = pos(F.col("n"), q)
        lo, frac = F.floor(p), p - F.floor(p)
        terms.append(F.max(F.when(F.col("rank") == lo, F.col("v"))).alias(f"_a_{k}"))
        terms.append(F.max(F.when(F.col("rank") == F.ceil(p), F.col("v"))).alias(f"_b_{k}"))
        terms.append(F.max(frac).alias(f"_f_{k}"))
    big = (
        r.groupBy(*KEY)
        .agg(*terms)
        .select(
            *KEY,
            *[
                (F.col(f"_a_{k}") + F.col(f"_f_{k}") * (F.col(f"_b_{k}") - F.col(f"_a_{k}"))).alias(k)
                for k in probs
            ],
        )
    )
    return small.unionByName(big)


def describe(
    points: DataFrame, median: bool = False, block_len: int = BLOCK_LEN, longest: int | None = None
) -> DataFrame:
    """Per-series columns other operators attach: n, mean, sd, sd_pop, vmin, vmax[, med]."""
    base = points.groupBy(*KEY).agg(
        F.count("*").alias("n"),
        F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("sd"),
        F.stddev_pop("v").alias("sd_pop"),
        F.min("v").alias("vmin"),
        F.max("v").alias("vmax"),
    )
    if not median:
        return base
    return base.join(quantiles(points, {"med": 0.5}, block_len=block_len, longest=longest), KEY, "left")


def inversions(points: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None) -> DataFrame:
    """AGG6/J5: pairs i < j with x_i > x_j, divided by n; no pair is ever emitted.

    Pairs inside a block are counted on the block array.  Two different blocks
    first differ in one bit of the block number: at that bit the earlier block
    has 0 and the later one 1, so for every bit the points that share the higher
    bits are ordered by value and each point on the 0 side counts the points on
    the 1 side below it.  A series with one block needs none of the second part.
    """
    points = within(points, longest)
    inside = to_blocks(points, block_len=block_len).select(
        *KEY, kernels.inversion_count(F.col("values")).alias("c"), F.size("values").alias("m")
    )
    if longest_series(points, longest) <= block_len:
        return inside.select(*KEY, F.col("c").alias("pairs"), (F.col("c") / F.col("m")).alias("inversions"))
    sizes = points.groupBy(*KEY).agg(F.count("*").alias("n")).filter(F.col("n") > block_len)
    many = attach(split_blocks(points, block_len=block_len), sizes, block_len).select(*KEY, "t", "v")
    last = F.floor((F.col("n") - 1) / block_len)
    bits = F.floor(F.log2(last)) + 1
    levels = (
        by_value(many, block_len)
        .withColumn("bit", F.explode(F.sequence(F.lit(0), (bits - 1).cast("int"))))
        .select(
            *KEY,
            "bucket",
            "bit",
            "v",
            F.expr("shiftright(block, bit + 1)").alias("prefix"),
            F.expr("shiftright(block, bit) & 1").alias("side"),
        )
    )
    group = [*KEY, "bit", "prefix"]
    sides = levels.groupBy(*group, "bucket").agg(F.sum("side").alias("later"), F.sum(1 - F.col("side")).alias("zeros"))
    lower = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = sides.select(
        *group, "bucket", "zeros", F.coalesce(F.sum("later").over(lower), F.lit(0)).alias("carry")
    )
    # Only buckets between two borders hold different values; in those of equal values nothing lies below.
    # ties: the 0 side sorts first, so an equal value on the 1 side is not counted
    order = Window.partitionBy(*group, "bucket").orderBy("v", "side").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    below = levels.filter("bucket % 2 = 0").withColumn("below", F.sum("side").over(order)).filter("side = 0")
    within_bucket = below.select(*KEY, F.col("below").alias("c"), F.lit(0).alias("m"))
    across = within_bucket.unionByName(carry.select(*KEY, (F.col("zeros") * F.col("carry")).alias("c"), F.lit(0).alias("m")))
    return (
        inside.unionByName(across)
        .groupBy(*KEY)
        .agg(F.sum("c").alias("pairs"), F.sum("m").alias("n"))
        .select(*KEY, "pairs", (F.col("pairs") / F.col("n")).alias("inversions"))
    )
