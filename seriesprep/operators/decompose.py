"""Seasonal-trend decomposition and the strengths derived from it (MATH7-9, MATH13, TOP2, TOP3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from ..layout import BLOCK_KEY, BLOCK_LEN, KEY, attach, split_blocks, to_blocks


def _slices(points: DataFrame, tested: DataFrame, block_len: int) -> DataFrame:
    """Blocks with the halo the widest tested period of their series needs.

    Five passes of local smoothing reach a bounded distance, so a block with that
    halo decomposes exactly like the whole series.  One-block series have no halo.
    """
    widest = F.coalesce(F.array_max("periods"), F.lit(0))
    reach = F.when(F.col("n") > block_len, kernels.stl_reach(widest)).otherwise(F.lit(0)).cast("bigint")
    plan = tested.select(*KEY, "n", "periods", reach.alias("reach"))
    rows = attach(split_blocks(points, block_len=block_len), plan.select(*KEY, "n", "reach"), block_len)
    rows = rows.drop("block", "own")  # placed again below, with the halo
    blocks = to_blocks(rows, F.col("reach"), F.col("reach"), block_len)
    start = F.col("block") * block_len
    own = F.least(F.col("n") - start, F.lit(block_len))
    return (
        attach(blocks, plan, block_len)
        .withColumn("head", start - F.col("lo"))
        .withColumn("own", own)
    )


def strengths(points: DataFrame, tested: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """MATH7-9: ``seasonal_strength`` and ``trend_strength`` per series and tested period.

    ``tested`` has KEY, ``n`` and the array ``periods``.  Each block returns means
    and centred squares per period; blocks of a series are combined here.
    """
    blocks = _slices(points, tested, block_len)
    parts = blocks.select(
        *KEY,
        F.explode(kernels.stl_moments("values", "periods", "head", "own", "n")).alias("p"),
    ).select(*KEY, "p.*")

    def pooled(mean: str, square: str) -> Column:
        m, x = F.col("m"), F.col(mean)
        between = F.sum(m * x * x) - F.sum(m * x) * F.sum(m * x) / F.sum(m)
        within = F.sum(square)
        return F.when(F.count("*") == 1, within).otherwise(within + between)

    sums = parts.groupBy(*KEY, "period").agg(
        pooled("r", "rr").alias("rr"), pooled("d", "dd").alias("dd"), pooled("s", "ss").alias("ss")
    )
    return sums.select(
        *KEY,
        "period",
        strength(F.col("rr"), F.col("dd")).alias("seasonal_strength"),
        strength(F.col("rr"), F.col("ss")).alias("trend_strength"),
    )


def strength(resid_var: Column, other_var: Column) -> Column:
    """max(0, 1 - var(remainder) / var(other)), 0 when the other variance is 0."""
    return F.when(other_var == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), 1 - resid_var / other_var))


def components(points: DataFrame, period: int, block_len: int = BLOCK_LEN) -> DataFrame:
    """MATH7: ``seasonal``, ``trend`` and ``resid`` per point at one period."""
    sizes = points.groupBy(*KEY).agg(F.count("*").alias("n"))
    tested = sizes.withColumn("periods", F.array(F.lit(period).cast("bigint")))
    blocks = _slices(points, tested, block_len)
    parts = blocks.select(
        *KEY,
        "lo",
        "head",
        "own",
        F.posexplode(
            F.arrays_zip("values", kernels.stl_components("values", F.lit(period), "n").alias("c"))
        ).alias("i", "x"),
    ).filter((F.col("i") >= F.col("head")) & (F.col("i") < F.col("head") + F.col("own")))
    return parts.select(
        *KEY,
        (F.col("lo") + F.col("i")).alias("t"),
        F.col("x.values").alias("v"),
        F.col("x.c.seasonal").alias("seasonal"),
        F.col("x.c.trend").alias("trend"),
    ).withColumn("resid", F.col("v") - F.col("seasonal") - F.col("trend"))


def component_strengths(parts: DataFrame) -> DataFrame:
    """MATH8 and MATH9 from given components, one row per series."""
    agg = parts.groupBy(*KEY).agg(
        F.var_samp("resid").alias("r"),
        F.var_samp(F.col("v") - F.col("trend")).alias("d"),
        F.var_samp(F.col("v") - F.col("seasonal")).alias("s"),
    )
    return agg.select(
        *KEY,
        strength(F.col("r"), F.col("d")).alias("seasonal_strength"),
        strength(F.col("r"), F.col("s")).alias("trend_strength"),
    )


def moment_strengths(moments: Column, periods: Column) -> Column:
    """Strengths per tested period from the moments of one whole series, as an array
    of structs (period, pos, ss, ts)."""

    def one(p: Column) -> Column:
        return F.struct(
            p["period"].alias("period"),
            F.array_position(periods, p["period"]).cast("bigint").alias("pos"),
            strength(p["rr"], p["dd"]).alias("ss"),
            strength(p["rr"], p["ss"]).alias("ts"),
        )

    return F.transform(moments, one)


def best_of(tested: Column, compat: bool = False) -> Column:
    """TOP2/TOP3 on an array of structs (period, pos, ss, ts), at most 16 per series.

    Best seasonal strength first, ties in tested order; missing ranks are padded
    with (0, -1, -1), sorted last.  ``compat`` keeps the last tested of equal
    strengths and ranks the pads as strengths 0.1, 0.2 and 0.3.
    """

    def entry(key, pos, period, ss, ts):
        return F.struct(key.alias("key"), pos.alias("pos"), period.alias("period"), ss.alias("ss"), ts.alias("ts"))

    def pad(key: float) -> Column:
        return entry(
            F.lit(key), F.lit(99).cast("bigint"), F.lit(0).cast("bigint"), F.lit(-1.0), F.lit(-1.0)
        )

    if compat:
        tested = F.filter(
            tested, lambda x: ~F.exists(tested, lambda y: (y["ss"] == x["ss"]) & (y["pos"] > x["pos"]))
        )
    ranked = F.transform(tested, lambda x: entry(-x["ss"], x["pos"], x["period"], x["ss"], x["ts"]))
    pads = F.array(*[pad(-0.1 * (i + 1) if compat else 2.0) for i in range(3)])
    missing = F.slice(pads, F.lit(1), F.greatest(F.lit(0), F.lit(3) - F.size(ranked)))
    if compat:
        ranked = F.filter(ranked, lambda x: ~F.exists(missing, lambda y: y["key"] == x["key"]))
    return F.array_sort(F.concat(ranked, missing))


def best_columns(best: Column) -> list[Column]:
    """The first three entries of ``best_of`` as nine columns."""
    cols = []
    for i in range(3):
        x = F.get(best, F.lit(i))
        cols += [
            x["period"].alias(f"period_value{i + 1}"),
            x["ss"].alias(f"seasonal_strength{i + 1}"),
            x["ts"].alias(f"trend_strength{i + 1}"),
        ]
    return cols


def season_flags() -> list[Column]:
    """MATH13."""
    return [
        (F.col("seasonal_strength1") >= 0.9).alias("if_season"),
        (F.col("trend_strength1") >= 0.85).alias("if_trend"),
    ]


def best_periods(rows: DataFrame, tested: DataFrame | None = None, compat: bool = False) -> DataFrame:
    """TOP2, TOP3 and MATH13 from one row per (series, period).

    With ``tested`` the tested order breaks ties, otherwise the period does.
    """
    pos = F.col("period")
    if tested is not None:
        rows = rows.join(tested.select(*KEY, "periods"), KEY)
        pos = F.array_position("periods", F.col("period"))
    one = F.struct(
        "period",
        pos.cast("bigint").alias("pos"),
        F.col("seasonal_strength").alias("ss"),
        F.col("trend_strength").alias("ts"),
    )
    listed = rows.groupBy(*KEY).agg(F.collect_list(one).alias("x")).withColumn("best", best_of(F.col("x"), compat))
    return listed.select(*KEY, *best_columns(F.col("best"))).select("*", *season_flags())
