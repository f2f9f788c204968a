"""Running-line smoothing of series longer than a block (the long form of L35)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..layout import BLOCK_KEY, BLOCK_LEN, KEY, attach, cut_lineage, in_order, split_blocks


def _prefix(points: DataFrame, y: str, block_len: int) -> DataFrame:
    """Sums over 0..t of y and x*y, x = t centred; a scan in blocks and one over blocks."""
    rows = split_blocks(points, block_len=block_len)
    x = F.col("t") - (F.col("n") - 1) / 2.0
    rows = rows.withColumn("_a", F.sum(y).over(in_order())).withColumn(
        "_b", F.sum(x * F.col(y)).over(in_order())
    )
    ends = rows.groupBy(*BLOCK_KEY).agg(F.max_by("_a", "t").alias("ea"), F.max_by("_b", "t").alias("eb"))
    before = Window.partitionBy(*KEY).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = ends.select(
        *BLOCK_KEY,
        F.coalesce(F.sum("ea").over(before), F.lit(0.0)).alias("ba"),
        F.coalesce(F.sum("eb").over(before), F.lit(0.0)).alias("bb"),
    )
    return rows.join(base, BLOCK_KEY).select(
        *KEY, "t", (F.col("_a") + F.col("ba")).alias("a"), (F.col("_b") + F.col("bb")).alias("b")
    )


def running_line(points: DataFrame, y: str, half: Column, block_len: int = BLOCK_LEN) -> DataFrame:
    """Local-linear fit ``fit`` and leave-one-out residual ``gap`` on t-half .. t+half.

    The window sums are differences of prefix sums, fetched by equi-joins on t.
    """
    n = F.col("n")
    half = F.least(half, F.floor((n - 1) / 2))
    lo = F.least(F.greatest(F.col("t") - half, F.lit(0)), F.greatest(n - half * 2 - 1, F.lit(0)))
    hi = F.least(lo + half * 2 + 1, n)
    rows = points.withColumn("_lo", lo - 1).withColumn("_hi", hi - 1)
    pre = _prefix(points, y, block_len)
    first = pre.select(*KEY, F.col("t").alias("_lo"), F.col("a").alias("a0"), F.col("b").alias("b0"))
    last = pre.select(*KEY, F.col("t").alias("_hi"), F.col("a").alias("a1"), F.col("b").alias("b1"))
    rows = rows.join(last, [*KEY, "_hi"]).join(first, [*KEY, "_lo"], "left")
    m = (F.col("_hi") - F.col("_lo")).cast("double")
    x = F.col("t") - (n - 1) / 2.0
    mx = (F.col("_lo") + 1 + F.col("_hi")) / 2.0 - (n - 1) / 2.0
    vx = m * (m * m - 1) / 12.0
    my = (F.col("a1") - F.coalesce("a0", F.lit(0.0))) / m
    cxy = F.col("b1") - F.coalesce("b0", F.lit(0.0)) - m * mx * my
    fit = my + F.when(vx > 0, cxy / vx).otherwise(F.lit(0.0)) * (x - mx)
    lever = 1 - 1 / m - F.when(vx > 0, (x - mx) * (x - mx) / vx).otherwise(F.lit(0.0))
    rows = rows.withColumn("fit", fit)
    gap = F.abs(F.col(y) - F.col("fit")) / F.when(lever > 1e-9, lever).otherwise(F.lit(1.0))
    return rows.withColumn("gap", gap).drop("_lo", "_hi", "a0", "b0", "a1", "b1")


def long_smooth(points: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """Trend per point with the span chosen by cross-validation (Friedman 1984)."""
    sizes = points.groupBy(*KEY).agg(F.count("*").alias("n"))
    rows = attach(split_blocks(points, block_len=block_len), sizes, block_len).select(*KEY, "n", "t", "v")
    spans = (0.05, 0.2, 0.5)  # fixed values
    half = [F.greatest(F.floor(F.col("n") * (0.5 * s) + 0.5), F.lit(2)) for s in spans]
    # every pass reads its input three times, so each result is written out once
    for i in range(3):
        rows = running_line(rows, "v", half[i], block_len)
        rows = cut_lineage(rows.withColumnRenamed("fit", f"f{i}").withColumnRenamed("gap", f"g{i}"))
    for i in range(3):
        rows = running_line(rows, f"g{i}", half[1], block_len).drop("gap")
        rows = cut_lineage(rows.withColumnRenamed("fit", f"r{i}"))
    best = F.least("r0", "r1", "r2")
    pick = F.when(F.col("r0") == best, spans[0]).when(F.col("r1") == best, spans[1]).otherwise(spans[2])
    rows = cut_lineage(running_line(rows.withColumn("pick", pick), "pick", half[1], block_len).drop("gap"))
    span = F.least(F.greatest(F.col("fit"), F.lit(spans[0])), F.lit(spans[2]))
    rows = rows.withColumn("span", span).drop("fit")
    low = (F.col("span") - spans[0]) / (spans[1] - spans[0])
    high = (F.col("span") - spans[1]) / (spans[2] - spans[1])
    mix = F.when(
        F.col("span") < spans[1], (1 - low) * F.col("f0") + low * F.col("f1")
    ).otherwise((1 - high) * F.col("f1") + high * F.col("f2"))
    rows = running_line(rows.withColumn("mix", mix), "mix", half[0], block_len)
    return rows.select(*KEY, "t", "v", F.col("fit").alias("trend"))
