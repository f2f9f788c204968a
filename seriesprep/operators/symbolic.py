"""Features of the series coded into few symbols or thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.scalars import pretty_step
from ..layout import BLOCK_KEY, BLOCK_LEN, KEY, attach, earlier_blocks, in_order, longest_series, split_blocks, within
from .autocorr import first_nonpositive
from .order import array_at, describe, quantiles
from .repair import nearest


# ------------------------------------------------------------ tercile coding
def coded_pairs(points: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None) -> DataFrame:
    """Counts ``c11`` .. ``c33`` of successive tercile codes and the number of pairs ``m``."""
    cuts = quantiles(points, {"q1": 1.0 / 3.0, "q2": 2.0 / 3.0}, midpoint=True, block_len=block_len, longest=longest)
    sizes = points.groupBy(*KEY).agg(F.count("*").alias("n"))
    rows = attach(split_blocks(points, 0, 1, block_len), sizes.join(cuts, KEY), block_len)
    code = 1 + (F.col("v") > F.col("q1")).cast("int") + (F.col("v") > F.col("q2")).cast("int")
    rows = rows.withColumn("a", code).withColumn("b", F.lead("a").over(in_order()))
    rows = rows.filter("own AND b IS NOT NULL")
    cells = [
        F.sum(((F.col("a") == i) & (F.col("b") == j)).cast("int")).alias(f"c{i}{j}")
        for i in (1, 2, 3)
        for j in (1, 2, 3)
    ]
    return rows.groupBy(*KEY).agg(F.count("*").alias("m"), *cells)


def transition(points: DataFrame, sums: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None) -> DataFrame:
    """L1: thin by tau, code into terciles, sum the column variances of the transition shares."""
    points = within(points, longest)
    longest = longest_series(points, longest)
    tau = first_nonpositive(points, sums, block_len, longest)
    live = tau.filter(F.col("sd") > 0).select(*KEY, "n", "tau")
    thin = (
        attach(split_blocks(points, block_len=block_len), live, block_len)
        .filter(F.col("t") % F.col("tau") == 0)
        .select(*KEY, F.floor(F.col("t") / F.col("tau")).alias("t"), "v")
    )
    pairs = coded_pairs(thin, block_len, longest)
    cells = [F.col(f"c{i}{j}") for i in (1, 2, 3) for j in (1, 2, 3)]
    out = pairs.select(
        *KEY, column_variances(cells, F.col("m")).alias("SB_TransitionMatrix_3ac_sumdiagcov")
    )
    return tau.select(*KEY).join(out, KEY, "left")


def column_variances(cells: list[Column], m: Column) -> Column:
    """Sum of the column variances (ddof 1) of a row-major 3x3 count table over m pairs."""
    total = F.lit(0.0)
    for j in range(3):
        col = [cells[3 * i + j] / m for i in range(3)]
        mean = (col[0] + col[1] + col[2]) / 3
        total = total + sum(((x - mean) * (x - mean) for x in col), F.lit(0.0)) / 2
    return total


def transition_whole(values: Column, tau: Column) -> Column:
    """L1 of a series held in one row; same rule as ``transition``."""
    thin = F.filter(values, lambda x, i: i % tau == 0)
    ordered = F.array_sort(thin)
    m = F.size(thin)
    cuts = [array_at(ordered, F.least(F.greatest(m * q - 0.5, F.lit(0.0)), m - 1)) for q in (1.0 / 3.0, 2.0 / 3.0)]

    def words(packed: Column) -> Column:
        code = F.transform(
            packed["x"],
            lambda x: (x > packed["q1"]).cast("int") + (x > packed["q2"]).cast("int"),
        )
        size = F.size(packed["x"]) - 1
        return F.zip_with(F.slice(code, F.lit(1), size), F.slice(code, F.lit(2), size), lambda a, b: a * 3 + b)

    def tally(word: Column, k: int) -> Column:
        return F.size(F.filter(word, lambda w: w == k))

    def score(word: Column) -> Column:
        return column_variances([tally(word, k) for k in range(9)], F.size(word))

    # bound once each through a one-element array, so nothing is evaluated twice
    packed = F.array(F.struct(thin.alias("x"), cuts[0].alias("q1"), cuts[1].alias("q2")))
    scored = F.transform(F.transform(packed, words), score)
    return F.when(m >= 2, F.get(scored, F.lit(0)))


def motif_entropy(points: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None) -> DataFrame:
    """Entropy of two-letter words in tercile coding."""
    pairs = coded_pairs(points, block_len, longest)
    out = F.lit(0.0)
    for i in (1, 2, 3):
        for j in (1, 2, 3):
            p = F.col(f"c{i}{j}") / F.col("m")
            out = out - F.when(p > 0, p * F.log(p)).otherwise(F.lit(0.0))
    return pairs.select(*KEY, out.alias("SB_MotifThree_quantile_hh"))


# ------------------------------------------------------------ outlier timing
LEVEL = 0.01  # fixed value: threshold step on the standardised series


def outlier_timing(points: DataFrame, sign: int = 1, block_len: int = BLOCK_LEN) -> DataFrame:
    """L2 (sign 1) and L3 (sign -1): where in time the large values sit.

    For every threshold j * 0.01 the position of the median exceeding point is an
    order statistic.  Counts per block and level locate the block holding it; only
    then is the position looked up, inside that one block.
    """
    name = f"DN_OutlierInclude_{'p' if sign > 0 else 'n'}_001_mdrmd"
    stats = describe(points)
    rows = attach(split_blocks(points, block_len=block_len), stats.select(*KEY, "n", "mean", "sd"), block_len)
    z = F.try_divide(F.col("v") - F.col("mean"), F.col("sd")) * sign
    q = F.floor(F.col("z") / LEVEL)
    q = q - (F.col("z") < q * LEVEL).cast("int")
    q = q + (F.col("z") >= (q + 1) * LEVEL).cast("int")
    levels = rows.filter(F.col("sd") > 0).withColumn("z", z).withColumn("q", q)

    counts = levels.filter("q >= 0").groupBy(*BLOCK_KEY, "q").agg(F.count("*").alias("c"), F.first("n").alias("n"))
    down = Window.partitionBy(*BLOCK_KEY).orderBy(F.desc("q")).rowsBetween(Window.unboundedPreceding, 0)
    up = Window.partitionBy(*BLOCK_KEY).orderBy("q")
    dense = (
        counts.withColumn("c", F.sum("c").over(down))
        .withColumn("from", F.coalesce(F.lag("q").over(up) + 1, F.lit(0)))
        .select(*BLOCK_KEY, "n", "c", F.explode(F.sequence("from", "q")).alias("j"))
    )
    by_level = Window.partitionBy(*KEY, "j")
    dense = dense.withColumn("m", F.sum("c").over(by_level)).withColumn(
        "prior",
        F.coalesce(
            F.sum("c").over(by_level.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ),
    )
    total = dense.filter("j = 0").groupBy(*KEY).agg(F.first("m").alias("tot"))
    kept = dense.join(total, KEY).filter(
        ((F.col("m") - 1) * 100.0 / F.col("tot") > 2) | (F.col("j") == 0)
    )
    ranks = F.array_distinct(F.array(F.floor((F.col("m") - 1) / 2), F.floor(F.col("m") / 2)))
    wanted = (
        kept.withColumn("k", F.explode(ranks))
        .withColumn("k", F.col("k") - F.col("prior"))
        .filter((F.col("k") >= 0) & (F.col("k") < F.col("c")))
        .groupBy(*BLOCK_KEY)
        .agg(F.collect_list(F.struct("j", "k")).alias("wanted"))
    )
    packed = levels.groupBy(*BLOCK_KEY).agg(
        F.sort_array(F.collect_list(F.struct("t", "q"))).alias("tq")
    ).select(*BLOCK_KEY, F.col("tq")[0]["t"].alias("lo"), F.col("tq.q").alias("level"))
    found = (
        packed.join(wanted, BLOCK_KEY)
        .select(*KEY, F.explode(kernels.nth_exceeding("level", "lo", "wanted")).alias("x"))
        .select(*KEY, "x.j", "x.t")
    )
    medians = found.groupBy(*KEY, "j").agg(F.avg(F.col("t") + 1).alias("at"))
    timing = (
        medians.join(stats.select(*KEY, "n"), KEY)
        .groupBy(*KEY)
        .agg(F.median(F.col("at") / (F.col("n") / 2.0) - 1).alias("timing"))
    )
    top = F.when(F.lit(sign) > 0, F.col("vmax") - F.col("mean")).otherwise(F.col("mean") - F.col("vmin"))
    flat = (F.col("n") > 0) & ((F.coalesce(F.col("sd"), F.lit(0.0)) == 0) | (F.try_divide(top, F.col("sd")) < LEVEL))
    return stats.join(timing, KEY, "left").select(
        *KEY, F.when(flat, F.lit(0.0)).otherwise(F.col("timing")).alias(name)
    )


# ---------------------------------------------------------------- histograms
def histogram_modes(points: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """L4 and the mode of L32: centre of the fullest bin of the standardised series.

    5 and 10 equal bins average tied centres; ``histogram_mode`` uses round bin
    edges, closed on the right, and takes the first of tied bins.
    """
    stats = describe(points).filter(F.col("sd") > 0)
    rows = attach(
        split_blocks(points, block_len=block_len), stats.select(*KEY, "n", "mean", "sd", "vmin", "vmax"), block_len
    )
    z = lambda c: (F.col(c) - F.col("mean")) / F.col("sd")
    rows = rows.select(*KEY, z("v").alias("z"), z("vmin").alias("lo"), z("vmax").alias("hi"))

    def equal(bins: int) -> Column:
        step = (F.col("hi") - F.col("lo")) / bins
        i = F.least(F.floor((F.col("z") - F.col("lo")) / step), F.lit(bins - 1))
        return F.struct(F.lit(bins).alias("kind"), (F.col("lo") + step * (i + 0.5)).alias("centre"))

    step = pretty_step(F.col("lo"), F.col("hi"), 10)
    j = F.greatest(F.ceil(F.round(F.col("z") / step, 7)) - 1, F.floor(F.col("lo") / step + 1e-7))
    neat = F.struct(F.lit(0).alias("kind"), ((j + 0.5) * step).alias("centre"))
    cells = (
        rows.select(*KEY, F.explode(F.array(equal(5), equal(10), neat)).alias("x"))
        .groupBy(*KEY, "x.kind", "x.centre")
        .agg(F.count("*").alias("c"))
    )
    w = Window.partitionBy(*KEY, "kind")
    best = cells.withColumn("top", F.max("c").over(w)).filter("c = top")
    pick = lambda kind, f: f(F.when(F.col("kind") == kind, F.col("centre")))
    modes = best.groupBy(*KEY).agg(
        pick(5, F.avg).alias("DN_HistogramMode_5"),
        pick(10, F.avg).alias("DN_HistogramMode_10"),
        pick(0, F.min).alias("histogram_mode"),
    )
    return points.select(*KEY).distinct().join(modes, KEY, "left")


def lag2_information(points: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """Mutual information at lag 2 over 5 even bins (range widened by 0.1 on each side)."""
    stats = describe(points).filter(F.col("sd") > 0)
    rows = attach(
        split_blocks(points, 0, 2, block_len), stats.select(*KEY, "n", "mean", "sd", "vmin", "vmax"), block_len
    )
    z = lambda c: (F.col(c) - F.col("mean")) / F.col("sd")
    step = (z("vmax") - z("vmin") + 0.2) / 5
    code = F.floor((z("v") - z("vmin") + 0.1) / step)
    rows = rows.withColumn("a", code).withColumn("b", F.lead("a", 2).over(in_order())).filter("own AND b IS NOT NULL")
    cells = rows.groupBy(*KEY, "a", "b").agg(F.count("*").alias("c"))
    total = lambda *g: F.sum("c").over(Window.partitionBy(*KEY, *g))
    cells = cells.withColumn("ca", total("a")).withColumn("cb", total("b")).withColumn("m", total())
    p = F.col("c") / F.col("m")
    info = cells.groupBy(*KEY).agg(
        F.sum(p * F.log(F.col("c") * F.col("m") / (F.col("ca") * F.col("cb")))).alias("CO_HistogramAMI_even_2_5")
    )
    return points.select(*KEY).distinct().join(info, KEY, "left")


# ---------------------------------------------------------------------- runs
def _longest_gap(rows: DataFrame, stop: Column, one_block: bool) -> DataFrame:
    """Largest distance between successive stops, the first measured from t = 0."""
    marked = nearest(rows, F.when(stop, F.col("t")), "_prev", "_next", False, one_block)
    gap = F.when(stop, F.col("t") - F.coalesce(F.col("_prev"), F.lit(0)))
    return marked.groupBy(*KEY).agg(F.max(gap).cast("double").alias("gap"))


def long_stretches(points: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None) -> DataFrame:
    """Longest stretch above the mean and longest stretch of decreases.

    The last point is left out and the stretch is measured between stops, as in
    the published feature set.
    """
    points = within(points, longest)
    stats = describe(points)
    rows = attach(split_blocks(points, 0, 1, block_len), stats.select(*KEY, "n", "mean"), block_len)
    rows = rows.withColumn("next", F.lead("v").over(in_order())).filter("own").filter("t < n - 1").drop("own")
    last = F.col("t") == F.col("n") - 2
    one_block = longest_series(points, longest) <= block_len
    high = _longest_gap(rows, (F.col("v") <= F.col("mean")) | last, one_block)
    down = _longest_gap(rows, (F.col("next") >= F.col("v")) | last, one_block)
    return high.withColumnRenamed("gap", "SB_BinaryStats_mean_longstretch1").join(
        down.withColumnRenamed("gap", "SB_BinaryStats_diff_longstretch0"), KEY
    )


def flat_spots(points: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """Longest run inside one tenth of the range.  NULL for a constant series
    becomes its length."""
    stats = describe(points)
    rows = attach(split_blocks(points, 1, 0, block_len), stats.select(*KEY, "n", "vmin", "vmax"), block_len)
    step = (F.col("vmax") - F.col("vmin")) / 10
    # right-closed tenths, the minimum in the first
    tenth = F.greatest(F.ceil(F.try_divide(F.col("v") - F.col("vmin"), step)), F.lit(1))
    rows = rows.withColumn("g", F.coalesce(tenth, F.lit(1))).withColumn("pg", F.lag("g").over(in_order())).filter("own")
    start = F.col("pg").isNull() | (F.col("pg") != F.col("g"))
    starts = rows.withColumn("s", F.when(start, F.col("t")))
    run_start = F.last("s", ignorenulls=True).over(in_order().rowsBetween(Window.unboundedPreceding, 0))
    inside = starts.withColumn("s", run_start)
    ends = inside.groupBy(*BLOCK_KEY).agg(F.max("s").alias("_ls"))
    carry = ends.select(*BLOCK_KEY, F.max("_ls").over(earlier_blocks()).alias("_before"))
    length = F.col("t") - F.coalesce(F.col("s"), F.col("_before")) + 1
    return inside.join(carry, BLOCK_KEY).groupBy(*KEY).agg(F.max(length).alias("flat_spots"))
