"""Amplitude spectrum, its peaks and the candidate periods (MATH2-4, W10, TOP1, SET1, F8-F10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.scalars import DEFAULT_PERIODS, adjust_period, bin_period, period_limit
from ..layout import BLOCK_LEN, KEY, in_order, longest_series, split_blocks, to_blocks, within
from .fourier import long_cells


def spectrum(points: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None) -> DataFrame:
    """MATH2: ``n`` and ``amps`` (bin k at index k) of every series that fits one block.

    The bins of longer series are rows and never one array, see ``long_bins`` and ``spectrum_bins``.
    """
    points = within(points, longest)
    longest = longest_series(points, longest)
    blocks = to_blocks(points, block_len=block_len)
    if longest <= block_len:
        n = F.size("values").cast("bigint")
        return blocks.select(*KEY, n.alias("n"), kernels.amplitudes("values").alias("amps"))
    sizes = points.groupBy(*KEY).agg(F.count("*").alias("n"))
    whole = blocks.join(sizes.filter(F.col("n") <= block_len), KEY)
    return whole.select(*KEY, "n", kernels.amplitudes("values").alias("amps"))


def long_bins(points: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None) -> DataFrame | None:
    """``(KEY, n, t, amp)``: one row per bin t of every series longer than a block; None if there can't be any."""
    points = within(points, longest)
    if longest_series(points, longest) <= block_len:
        return None
    sizes = points.groupBy(*KEY).agg(F.count("*").alias("n"))
    return long_cells(points, sizes.filter(F.col("n") > block_len), block_len)


def spectrum_bins(points: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None) -> DataFrame:
    """MATH2 as rows: ``(KEY, n, k, amp)`` for series of any length."""
    whole = spectrum(points, block_len, longest).select(*KEY, "n", F.posexplode("amps").alias("k", "amp"))
    whole = whole.withColumn("k", F.col("k").cast("bigint"))
    far = long_bins(points, block_len, longest)
    return whole if far is None else whole.unionByName(far.withColumnRenamed("t", "k"))


def peak_list(amps: Column, fmin: float = 0.0, compat: bool = False) -> Column:
    """MATH3, F8, W10: interior strict maxima as structs (loss = -amp, k), best first.

    Equal amplitudes are ordered by bin.  ``compat`` keeps one bin per distinct
    amplitude and, for fmin > 0, pairs the remaining amplitudes with the first bins.
    """
    inner = F.when(F.size(amps) >= 3, F.sequence(F.lit(1), F.size(amps) - 2)).otherwise(F.array().cast("array<int>"))

    def is_peak(k: Column) -> Column:
        here = F.get(amps, k)
        return (here > F.get(amps, k - 1)) & (here > F.get(amps, k + 1))

    def entry(k: Column) -> Column:
        return F.struct((-F.get(amps, k)).alias("loss"), k.alias("k"))

    bins = F.filter(inner, is_peak)
    strong = F.filter(F.transform(bins, entry), lambda x: -x["loss"] >= fmin)
    if not compat:
        return F.array_sort(strong)
    paired = F.transform(strong, lambda x, i: F.struct(x["loss"].alias("loss"), F.get(bins, i).alias("k")))
    ordered = F.array_sort(paired)
    return F.filter(ordered, lambda x, i: (i == 0) | (x["loss"] != F.get(ordered, i - 1)["loss"]))


def candidate_periods(spectra: DataFrame, fmin: float = 0.0, compat: bool = False) -> DataFrame:
    """TOP1: ``detected`` = first three distinct adjusted periods >= 4 in amplitude order."""
    return with_candidates(spectra, compat, fmin).select(*KEY, "n", "detected")


def with_candidates(spectra: DataFrame, compat: bool = False, fmin: float = 0.0) -> DataFrame:
    """The rows of ``spectra`` (``n``, ``amps``) with the column ``detected``."""
    listed = spectra.withColumn("peaks", peak_list(F.col("amps"), fmin, compat))
    snapped = F.transform("peaks", lambda x: adjust_period(bin_period(F.col("n"), x["k"])))
    valid = F.array_distinct(F.filter(snapped, lambda p: p >= 4))
    return listed.withColumn("detected", F.slice(valid, 1, 3)).drop("peaks")


def series_candidates(
    points: DataFrame, compat: bool = False, block_len: int = BLOCK_LEN, longest: int | None = None
) -> DataFrame:
    """TOP1 straight from points; the spectrum of a long series never becomes one row.

    Its bins stay rows: peaks by a window with a halo of one bin, then one row per
    distinct adjusted period, of which the three strongest are kept.
    """
    points = within(points, longest)
    if longest_series(points, longest) <= block_len:
        return candidate_periods(spectrum(points, block_len, block_len), compat=compat)
    sizes = points.groupBy(*KEY).agg(F.count("*").alias("n"))
    blocks = to_blocks(points, block_len=block_len)
    whole = blocks.join(sizes.filter(F.col("n") <= block_len), KEY)
    short = candidate_periods(whole.select(*KEY, "n", kernels.amplitudes("values").alias("amps")), compat=compat)
    bins = split_blocks(long_cells(points, sizes.filter(F.col("n") > block_len), block_len), 1, 1, block_len)
    w = in_order()
    peaks = (
        bins.withColumn("a", F.lag("amp").over(w))
        .withColumn("b", F.lead("amp").over(w))
        .filter("own AND amp > a AND amp > b")
        .select(*KEY, "n", F.col("t").alias("k"), "amp")
    )
    if compat:
        peaks = peaks.groupBy(*KEY, "n", "amp").agg(F.min("k").alias("k"))
    period = adjust_period(bin_period(F.col("n"), F.col("k")))
    best = (
        peaks.withColumn("period", period)
        .filter("period >= 4")
        .groupBy(*KEY, "n", "period")
        .agg(F.max(F.struct("amp", (-F.col("k")).alias("k"))).alias("top"))
    )
    order = Window.partitionBy(*KEY).orderBy(F.desc("top"))
    three = best.withColumn("pos", F.row_number().over(order)).filter("pos <= 3")
    found = three.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("pos", "period")))["period"].alias("detected"))
    none = F.array().cast("array<bigint>")
    long = sizes.filter(F.col("n") > block_len).join(found, KEY, "left")
    return short.unionByName(long.select(*KEY, "n", F.coalesce("detected", none).alias("detected")))


def tested_periods(candidates: DataFrame) -> DataFrame:
    """SET1, F9: detected then default periods, distinct, below the length limit."""
    defaults = F.array(*[F.lit(p).cast("bigint") for p in DEFAULT_PERIODS])
    union = F.array_distinct(F.concat("detected", defaults))
    limit = period_limit(F.col("n"))
    return candidates.withColumn("periods", F.filter(union, lambda p: (p >= 4) & (p < limit)))


def spectral_peaks(spectra: DataFrame, fmin: float = 0.0, compat: bool = False) -> DataFrame:
    """One row per peak with its rank, bin, amplitude, period and adjusted period."""
    rows = spectra.select(*KEY, "n", F.posexplode(peak_list(F.col("amps"), fmin, compat)).alias("pos", "p"))
    period = bin_period(F.col("n"), F.col("k"))
    return rows.select(
        *KEY, "n", (F.col("pos") + 1).alias("rank"), F.col("p.k").alias("k"), (-F.col("p.loss")).alias("amp")
    ).select("*", period.alias("period"), adjust_period(period).alias("adjusted"))
