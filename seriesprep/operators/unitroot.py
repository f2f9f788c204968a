"""Unit-root tests (MATH10-MATH12) and the KPSS and Phillips-Perron statistics."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.scalars import adf_pvalue, kpss_pvalue
from ..layout import (
    BLOCK_KEY,
    BLOCK_LEN,
    KEY,
    attach,
    earlier_blocks,
    in_order,
    longest_series,
    merge_block_arrays,
    split_blocks,
    to_blocks,
    within,
)
from .autocorr import lag_sums
from .order import describe

def adf_halo(longest: int) -> int:
    """Observations before a block that its lag products reach: the largest lag of the longest series, and two."""
    return max(64, math.ceil(12 * (longest / 100.0) ** 0.25) + 2)


def adf_lags(n: Column) -> Column:
    """Largest lag tried: ceil(12 (n/100)^(1/4)), at most n // 2 - 2."""
    return F.least(F.ceil(F.pow(n / 100.0, F.lit(0.25)) * 12), F.floor(n / 2) - 2)


def adf(points: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None) -> DataFrame:
    """MATH10: statistic, chosen lag and p-value; NULL for constant or tiny series.

    Blocks deliver cross-product matrices, which add up over the blocks of a
    series; the regressions are solved once per series on the summed matrix.
    """
    points = within(points, longest)
    stats = describe(points)
    longest = longest_series(points, longest)
    halo = adf_halo(longest)
    usable = stats.filter((F.col("n") >= 4) & (F.col("sd") > 0)).select(
        *KEY, "n", "mean", adf_lags(F.col("n")).alias("lags")
    )
    blocks = attach(to_blocks(points, before=halo, block_len=block_len), usable, block_len)
    gram = kernels.adf_gram("values", "lo", F.col("block") * block_len, "lags", "mean")
    if longest <= block_len:
        solved = blocks.select(*KEY, kernels.adf_solve(gram, "values", "lags", "n", "mean").alias("r"))
        solved = solved.select(*KEY, F.col("r.stat").alias("adf_stat"), F.col("r.lag").alias("adf_lag"))
        return _with_pvalue(stats, solved)
    parts = blocks.select(*BLOCK_KEY, "n", gram.alias("g"))
    heads = blocks.filter("block = 0").select(
        *KEY, "mean", "lags", F.slice("values", 1, halo).alias("head")
    )
    solved = (
        merge_block_arrays(parts, "g", block_len)
        .join(heads, KEY)
        .select(*KEY, kernels.adf_solve("g", "head", "lags", "n", "mean").alias("r"))
        .select(*KEY, F.col("r.stat").alias("adf_stat"), F.col("r.lag").alias("adf_lag"))
    )
    return _with_pvalue(stats, solved)


def _with_pvalue(stats: DataFrame, solved: DataFrame) -> DataFrame:
    return (
        stats.select(*KEY).join(solved, KEY, "left").withColumn("adf_pvalue", adf_pvalue(F.col("adf_stat")))
    )


def running_sums(values: Column, mean: Column) -> Column:
    """Struct of the last running sum ``c`` of v - mean, and the sums of c and c^2."""
    zero = F.struct(F.lit(0.0).alias("c"), F.lit(0.0).alias("c1"), F.lit(0.0).alias("c2"))

    def step(a: Column, v: Column) -> Column:
        c = a["c"] + v - mean
        return F.struct(c.alias("c"), (a["c1"] + c).alias("c1"), (a["c2"] + c * c).alias("c2"))

    return F.aggregate(values, zero, step)


def cumulative_square(points: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """Sum over t of (running sum of v - mean)^2: a scan inside blocks and one over blocks."""
    stats = describe(points).select(*KEY, "n", "mean")
    blocks = attach(to_blocks(points, block_len=block_len), stats, block_len)
    sums = blocks.select(
        *BLOCK_KEY, F.size("values").alias("m"), running_sums(F.col("values"), F.col("mean")).alias("r")
    ).select(*BLOCK_KEY, "m", F.col("r.c").alias("last"), F.col("r.c1").alias("c1"), F.col("r.c2").alias("c2"))
    base = F.coalesce(F.sum("last").over(earlier_blocks()), F.lit(0.0))
    return (
        sums.withColumn("base", base)
        .groupBy(*KEY)
        .agg(
            F.sum(F.col("c2") + F.col("base") * F.col("c1") * 2 + F.col("base") * F.col("base") * F.col("m")).alias("q")
        )
    )


def _weighted(s: Column, lags: Column) -> Column:
    """s[0] + 2 * sum over k = 1..lags of (1 - k / (lags + 1)) s[k]."""
    ks = F.when(lags >= 1, F.sequence(F.lit(1).cast("bigint"), lags)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(
        ks,
        F.get(s, F.lit(0)),
        lambda acc, k: acc + F.get(s, k.cast("int")) * 2 * (1 - k / (lags + 1.0)),
    )


def kpss_lags(s: Column, n: Column) -> Column:
    """Automatic lag count from the first n^(2/9) lag products (Hobijn et al. 1998)."""
    cov = F.floor(F.pow(n, F.lit(2.0 / 9.0)))
    ks = F.when(cov >= 1, F.sequence(F.lit(1).cast("bigint"), cov)).otherwise(F.array().cast("array<bigint>"))
    acc = F.aggregate(
        ks,
        F.struct((F.get(s, F.lit(0)) / n).alias("s0"), F.lit(0.0).alias("s1")),
        lambda a, k: F.struct(
            (a["s0"] + F.get(s, k.cast("int")) / (n / 2.0)).alias("s0"),
            (a["s1"] + k * F.get(s, k.cast("int")) / (n / 2.0)).alias("s1"),
        ),
    )
    ratio = F.try_divide(acc["s1"], acc["s0"])
    gamma = F.pow(ratio * ratio, F.lit(1.0 / 3.0)) * 1.1447
    return F.least(F.floor(gamma * F.pow(n, F.lit(1.0 / 3.0))), n - 1)


def kpss_statistic(q: Column, s: Column, lags: Column, n: Column, sd: Column) -> Column:
    """Scaled cumulative square over the weighted lag products."""
    return F.when(sd > 0, F.try_divide(q / (n * n), _weighted(s, lags) / n))


def kpss(points: DataFrame, sums: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """MATH11: statistic, lag count and p-value around a constant."""
    n = F.col("n")
    rows = sums.join(cumulative_square(points, block_len), KEY).withColumn("lags", kpss_lags(F.col("s"), n))
    stat = kpss_statistic(F.col("q"), F.col("s"), F.col("lags"), n, F.col("sd"))
    return rows.withColumn("kpss_stat", stat).select(
        *KEY, "kpss_stat", F.col("lags").alias("kpss_lag"), kpss_pvalue(F.col("kpss_stat")).alias("kpss_pvalue")
    )


def joint_pvalues(adf_p: Column, kpss_p: Column) -> list[Column]:
    """Both p-values and ``stability`` (MATH12), all NULL if one is."""
    known = adf_p.isNotNull() & kpss_p.isNotNull()
    return [
        F.when(known, adf_p).alias("adf_pvalue"),
        F.when(known, kpss_p).alias("kpss_pvalue"),
        F.when(known, (adf_p <= 0.05) | (kpss_p >= 0.05)).alias("stability"),
    ]


def stationarity(
    points: DataFrame, sums: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None
) -> DataFrame:
    """MATH10-12 side by side; if one test is undefined, all three columns are NULL."""
    both = adf(points, block_len, longest).join(kpss(points, sums, block_len), KEY, "left")
    return both.select(*KEY, *joint_pvalues(F.col("adf_pvalue"), F.col("kpss_pvalue")))


def unitroot_stats(
    points: DataFrame, sums: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None
) -> DataFrame:
    """KPSS and Phillips-Perron (Z-alpha) statistics with short lags.

    Fixed values: lag counts trunc(4 (n/100)^(1/4)), for Phillips-Perron on n - 1.
    The input is standardised, which leaves both statistics unchanged.
    """
    n = F.col("n")
    short = F.floor(F.pow(n / 100.0, F.lit(0.25)) * 4)
    rows = sums.join(cumulative_square(points, block_len), KEY)
    kp = kpss_statistic(F.col("q"), F.col("s"), short, n, F.col("sd"))
    kpss_part = rows.select(*KEY, kp.alias("unitroot_kpss"))
    return kpss_part.join(phillips_perron(points, block_len, longest_series(points, longest)), KEY, "left")


def phillips_perron(points: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None) -> DataFrame:
    """Z-alpha of y(t) = a + rho y(t-1) + e with Bartlett-weighted residual products."""
    points = within(points, longest)
    stats = describe(points)
    rows = attach(split_blocks(points, 1, 0, block_len), stats.select(*KEY, "n", "mean", "sd"), block_len)
    y = F.col("v") - F.col("mean")
    pairs = (
        rows.withColumn("y", y)
        .withColumn("x", F.lag("y").over(in_order()))
        .filter("own AND x IS NOT NULL")
    )
    fit = pairs.groupBy(*KEY).agg(
        F.count("*").alias("m"),
        F.avg("x").alias("mx"),
        F.avg("y").alias("my"),
        F.var_pop("x").alias("vx"),
        F.var_pop("y").alias("vy"),
        F.covar_pop("x", "y").alias("cxy"),
        F.first("n").alias("n"),
    )
    fit = fit.withColumn("rho", F.try_divide("cxy", "vx")).withColumn("icpt", F.col("my") - F.col("rho") * F.col("mx"))
    resid = (
        attach(pairs.drop("n", "own"), fit.select(*KEY, "n", "rho", "icpt"), block_len)
        .filter(F.col("rho").isNotNull())
        .select(*KEY, (F.col("t") - 1).alias("t"), (F.col("y") - F.col("icpt") - F.col("rho") * F.col("x")).alias("v"))
    )
    s = lag_sums(resid, block_len, longest_series(points, longest)).select(*KEY, "s")
    m = F.col("m")
    lags = F.floor(F.pow(m / 100.0, F.lit(0.25)) * 4)
    out = fit.join(s, KEY, "left").withColumn("long_run", _weighted(F.col("s"), lags) / m)
    shift = (F.col("long_run") - F.get("s", F.lit(0)) / m) * 0.5 * m / F.col("vy")
    z = m * (F.col("rho") - 1) - shift
    return out.select(*KEY, F.when(F.col("vx") > 0, z).alias("unitroot_pp"))
