"""The remaining library features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import kernels
from ..layout import BLOCK_KEY, BLOCK_LEN, KEY, attach, earlier_blocks, in_order, longest_series, running_sum, split_blocks, to_blocks
from .autocorr import beside, difference, first_nonpositive, lag_rows, lag_sums, lagged_correlations
from .fourier import long_power
from .order import describe, quantiles
from .repair import nearest
from .smoother import long_smooth


def standardised(points: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """Points of the non-constant series, centred and divided by the sample std."""
    stats = describe(points).filter(F.col("sd") > 0).select(*KEY, "n", "mean", "sd")
    rows = attach(split_blocks(points, block_len=block_len), stats, block_len)
    return rows.select(*KEY, "t", ((F.col("v") - F.col("mean")) / F.col("sd")).alias("v"))


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


# --------------------------------------------------------- tiles and shifts
def tile_features(points: DataFrame, width: int = 10, block_len: int = BLOCK_LEN) -> DataFrame:
    """Variance of the tile variances and of the tile means; 0 below two tiles."""
    z = standardised(points, block_len)
    tiles = (
        z.groupBy(*KEY, F.floor(F.col("t") / width).alias("tile"))
        .agg(F.count("*").alias("m"), F.var_samp("v").alias("var"), F.avg("v").alias("mean"))
        .filter(F.col("m") == width)
        .groupBy(*KEY)
        .agg(F.var_samp("var").alias("lumpiness"), F.var_samp("mean").alias("stability"))
    )
    return (
        points.select(*KEY)
        .distinct()
        .join(tiles, KEY, "left")
        .select(*KEY, *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("lumpiness", "stability")])
    )


def shift_features(points: DataFrame, width: int = 10, block_len: int = BLOCK_LEN) -> DataFrame:
    """Largest change of the rolling mean and variance between adjacent windows."""
    z = split_blocks(standardised(points, block_len), 0, 2 * width, block_len)
    frame = in_order().rowsBetween(0, width - 1)
    full = F.count("v").over(frame) == width
    rows = z.withColumn("m", F.when(full, F.avg("v").over(frame))).withColumn(
        "s", F.when(full, F.var_samp("v").over(frame))
    )
    rows = rows.withColumn("dm", F.abs(F.lead("m", width).over(in_order()) - F.col("m")))
    rows = rows.withColumn("ds", F.abs(F.lead("s", width).over(in_order()) - F.col("s"))).filter("own")

    def top(c: str) -> Column:
        return F.max(F.when(F.col(c).isNotNull(), F.struct(F.round(c, 9).alias("d"), (-F.col("t")).alias("t"), c)))

    best = rows.groupBy(*KEY).agg(top("dm").alias("a"), top("ds").alias("b"))
    return (
        points.select(*KEY)
        .distinct()
        .join(best, KEY, "left")
        .select(
            *KEY,
            F.coalesce("a.dm", F.lit(0.0)).alias("max_level_shift"),
            (width - F.col("a.t")).cast("double").alias("time_level_shift"),
            F.coalesce("b.ds", F.lit(0.0)).alias("max_var_shift"),
            (width - F.col("b.t")).cast("double").alias("time_var_shift"),
        )
    )


def density_shift(points: DataFrame, width: int = 10, block_len: int = BLOCK_LEN, longest: int | None = None) -> DataFrame:
    """Largest change of the density divergence between neighbouring windows."""
    z = standardised(points, block_len)
    stats = describe(z)
    q = quantiles(z, {"q1": 0.25, "q3": 0.75}, block_len=block_len, longest=longest_series(points, longest))
    spread = F.least(F.col("sd"), (F.col("q3") - F.col("q1")) / 1.34)
    bw = F.when(spread > 0, spread).otherwise(F.col("sd")) * 0.9 * F.pow("n", F.lit(-0.2))
    setup = stats.join(q, KEY).select(*KEY, "n", "vmin", "vmax", bw.alias("bw")).filter(F.col("n") > 2 * width)
    blocks = attach(to_blocks(z, width - 1, width + 1, block_len), setup, block_len)
    start = F.col("block") * block_len
    parts = blocks.select(
        *KEY,
        kernels.density_shift(
            "values", "lo", start, F.least(start + block_len, F.col("n")), "n", "vmin", "vmax", "bw", F.lit(width)
        ).alias("x"),
    )
    best = parts.filter("x.value IS NOT NULL").groupBy(*KEY).agg(F.max(F.struct("x.value", (-F.col("x.at")).alias("at"))).alias("b"))
    return (
        points.select(*KEY)
        .distinct()
        .join(best, KEY, "left")
        .select(*KEY, F.col("b.value").alias("max_kl_shift"), (-F.col("b.at")).cast("double").alias("time_kl_shift"))
    )


# -------------------------------------------------------------- regressions
def lag_gram(points: DataFrame, lags: int, block_len: int = BLOCK_LEN) -> DataFrame:
    """Flat cross products of [1, v(t-1), .., v(t-lags), v(t)] over the rows with a full history."""
    rows = split_blocks(points, lags, 0, block_len)
    cols = [F.lag("v", k).over(in_order()) for k in range(1, lags + 1)]
    rows = rows.select(*KEY, "own", F.col("v").alias("y"), *[c.alias(f"x{i + 1}") for i, c in enumerate(cols)])
    rows = rows.filter(F.col("own") & F.col(f"x{lags}").isNotNull())
    names = [F.lit(1.0), *[F.col(f"x{i}") for i in range(1, lags + 1)], F.col("y")]
    k = len(names)
    sums = [F.sum(names[i] * names[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]
    agg = rows.groupBy(*KEY).agg(F.count("*").alias("m"), *sums)
    cells = [F.col(f"g{min(i, j)}_{max(i, j)}") for i in range(k) for j in range(k)]
    return agg.select(*KEY, "m", F.array(*cells).alias("gram"))


def arch_statistic(points: DataFrame, lags: int = 12, block_len: int = BLOCK_LEN) -> DataFrame:
    """R^2 of the squared standardised series on its own 12 lags; NULL when too short."""
    z = standardised(points, block_len)
    squares = z.withColumn("v", F.col("v") * F.col("v"))
    fit = lag_gram(squares, lags, block_len).withColumn(
        "ssr", kernels.nested_residuals("gram", F.lit(lags + 2))
    )
    # residuals on the constant alone are the total square sum
    r2 = 1 - F.try_divide(F.get("ssr", F.lit(lags)), F.get("ssr", F.lit(0)))
    return points.select(*KEY).distinct().join(
        fit.filter(F.col("m") > 1).select(*KEY, r2.alias("arch_stat")), KEY, "left"
    )


def nonlinearity(points: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """Likelihood-ratio test for quadratic and cubic lag-1 terms, times 10 / n."""
    z = split_blocks(standardised(points, block_len), 1, 0, block_len)
    rows = z.withColumn("x", F.lag("v").over(in_order())).filter("own AND x IS NOT NULL")
    power = [F.lit(1.0)]
    for _ in range(6):
        power.append(power[-1] * F.col("x"))
    agg = rows.groupBy(*KEY).agg(
        F.count("*").alias("m"),
        *[F.sum(power[p]).alias(f"x{p}") for p in range(7)],
        *[F.sum(power[p] * F.col("v")).alias(f"y{p}") for p in range(4)],
        F.sum(F.col("v") * F.col("v")).alias("yy"),
    )
    cells = []
    for i in range(5):
        for j in range(5):
            cells.append(F.col("yy") if i == j == 4 else F.col(f"y{min(i, j)}") if max(i, j) == 4 else F.col(f"x{i + j}"))
    fit = agg.withColumn("ssr", kernels.nested_residuals(F.array(*cells), F.lit(5)))
    stat = F.col("m") * F.log(F.try_divide(F.get("ssr", F.lit(1)), F.get("ssr", F.lit(3))))
    return points.select(*KEY).distinct().join(
        fit.select(*KEY, (stat * 10 / (F.col("m") + 1)).alias("nonlinearity")), KEY, "left"
    )


def heterogeneity(points: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None) -> DataFrame:
    """ARCH effects left after an autoregression: ``arch_acf`` and ``arch_r2``."""
    z = standardised(points, block_len)
    sums = lag_sums(z, block_len, longest_series(points, longest))
    fit = sums.filter(F.col("n") > 1).select(
        *KEY, "n", kernels.yule_walker(F.slice("s", 1, 512), "n").alias("coefs")
    )
    order = F.size("coefs")
    blocks = attach(to_blocks(z, before=512, block_len=block_len), fit, block_len)
    start = F.greatest(F.col("block") * block_len - order, F.lit(0)) - F.col("lo")
    own = F.slice("values", (start + 1).cast("int"), F.size("values"))
    rest = blocks.select(
        *KEY,
        (F.greatest(F.col("block") * block_len, order) - order).alias("lo"),
        F.posexplode(kernels.whiten(own, "coefs", F.lit(0.0))).alias("i", "v"),
    ).select(*KEY, (F.col("lo") + F.col("i")).alias("t"), "v")
    squares = rest.withColumn("v", F.col("v") * F.col("v"))
    acf = lagged_correlations(squares, 12, block_len).select(
        *KEY, F.aggregate("ac", F.lit(0.0), lambda s, x: s + x * x).alias("arch_acf")
    )
    r2 = arch_statistic(rest, 12, block_len).withColumnRenamed("arch_stat", "arch_r2")
    return points.select(*KEY).distinct().join(acf, KEY, "left").join(r2, KEY, "left")


# ----------------------------------------------------------------- spectrum
def spectral_entropy(spectra: DataFrame, bins: DataFrame | None = None, block_len: int = BLOCK_LEN) -> DataFrame:
    """Entropy of the normalised two-sided power, 0.001 of it spread evenly.

    ``spectra`` has the amplitudes of one-block series as arrays, ``bins`` those of longer ones as rows.
    """
    power = F.transform(F.slice("amps", 2, F.greatest(F.size("amps") - 1, F.lit(1))), lambda a: a * a)
    rows = spectra.filter(F.size("amps") >= 3).withColumn("p", power).withColumn("total", _total(F.col("p")))
    sides = F.size("p") * 2
    share = lambda x, total, sides: x / (total * 2) * 0.999 + F.lit(0.001) / sides
    part = lambda x, total, sides: share(x, total, sides) * F.log(share(x, total, sides)) * 2
    h = F.aggregate("p", F.lit(0.0), lambda s, x: s - part(x, F.col("total"), sides))
    level = lambda h, sides: F.least(F.lit(1.0), h / F.log(sides.cast("double"))).alias("entropy")
    out = spectra.select(*KEY).join(rows.filter(F.col("total") > 0).select(*KEY, level(h, sides)), KEY, "left")
    if bins is None:
        return out
    p = bins.filter("t >= 1").select(*KEY, "n", "t", (F.col("amp") * F.col("amp")).alias("p"))
    totals = p.groupBy(*KEY, "n").agg(F.sum("p").alias("total"), F.count("*").alias("m"))
    full = attach(split_blocks(p.drop("n"), block_len=block_len), totals.filter("total > 0 AND m >= 2"), block_len)
    far = full.groupBy(*KEY).agg(F.first("m").alias("m"), (-F.sum(part(F.col("p"), F.col("total"), F.col("m") * 2))).alias("h"))
    far = totals.select(*KEY).join(far.select(*KEY, level(F.col("h"), F.col("m") * 2)), KEY, "left")
    return out.unionByName(far)


def log_periodogram(spectra: DataFrame, bins: DataFrame | None = None) -> DataFrame:
    """L27 (``hurst``): 0.5 + slope of the log power on -2 log(2 sin(w/2)), lowest sqrt(n) bins."""
    m = F.floor(F.sqrt("n")).cast("int")
    rows = spectra.select(*KEY, "n", F.posexplode(F.slice("amps", 2, m)).alias("i", "a")).select(*KEY, "n", (F.col("i") + 1).cast("bigint").alias("k"), "a")
    keys = spectra.select(*KEY)
    if bins is not None:
        rows = rows.unionByName(bins.filter((F.col("t") >= 1) & (F.col("t") <= m)).select(*KEY, "n", F.col("t").alias("k"), F.col("amp").alias("a")))
        keys = keys.unionByName(bins.filter("t = 0").select(*KEY))
    w = F.lit(2.0) * F.pi() * F.col("k") / F.col("n")
    x = F.log(F.sin(w / 2) * 2) * -2
    fit = rows.filter("a > 0").groupBy(*KEY).agg((F.regr_slope(F.log(F.col("a") * F.col("a")), x) + 0.5).alias("hurst"))
    return keys.join(fit, KEY, "left")


def welch_features(points: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None) -> DataFrame:
    """Power in the lowest fifth and the median frequency of the padded spectrum."""
    z = standardised(points, block_len)
    stats = describe(z).select(*KEY, "n", "mean")
    blocks = attach(to_blocks(z, block_len=block_len), stats.filter(F.col("n") <= block_len), block_len)
    short = blocks.select(*KEY, "n", kernels.padded_power("values", "mean").alias("power"))
    last = F.size("power") - 1
    weight = lambda p, n, i, last: p / n / (F.lit(2.0) * F.pi()) * F.when((i > 0) & (i < last), 2.0).otherwise(1.0)
    scale = F.transform("power", lambda p, i: weight(p, F.col("n"), i, last))
    rows = short.withColumn("last", last).withColumn("sw", scale).withColumn("total", _total(F.col("sw")))
    dw = F.pi() / F.col("last")
    fifth = _total(F.slice("sw", F.lit(1), F.floor(F.size("sw") / 5).cast("int"))) * dw
    found = F.aggregate(
        "sw",
        F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("k")),
        lambda a, x: F.struct((a["sum"] + x).alias("sum"), (a["k"] + (a["sum"] + x <= F.col("total") * 0.5).cast("int")).alias("k")),
    )
    names = "SP_Summaries_welch_rect_area_5_1", "SP_Summaries_welch_rect_centroid"
    out = rows.select(*KEY, fifth.alias(names[0]), (found["k"] * dw).alias(names[1]))
    if longest_series(points, longest) > block_len:
        # the bins of a long series are rows: sums over them, and the running power for the median
        bins = long_power(z, stats.filter(F.col("n") > block_len).select(*KEY, "n"), block_len)
        bins = bins.select(*KEY, "t", F.col("half").alias("last"), weight(F.col("power"), F.col("n"), F.col("t"), F.col("half")).alias("sw"))
        low = F.sum(F.when(F.col("t") < F.floor((F.col("last") + 1) / 5), F.col("sw")))
        sums = bins.groupBy(*KEY, "last").agg(F.sum("sw").alias("total"), F.coalesce(low, F.lit(0.0)).alias("low"))
        scanned = running_sum(bins.drop("last"), "sw", "power", block_len)
        known = sums.select(*KEY, "total", (F.col("last") + 1).alias("n"))
        below = attach(split_blocks(scanned, block_len=block_len), known, block_len).filter(F.col("power") <= F.col("total") * 0.5)
        far = sums.join(below.groupBy(*KEY).agg(F.count("*").alias("k")), KEY, "left")
        out = out.unionByName(far.select(*KEY, (F.col("low") * dw).alias(names[0]), (F.coalesce("k", F.lit(0)) * dw).alias(names[1])))
    return points.select(*KEY).distinct().join(out, KEY, "left")


# ------------------------------------------------- autocorrelation followers
def residual_tau_ratio(
    points: DataFrame, sums: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None
) -> DataFrame:
    """First zero crossing of the differences over that of the series."""
    steps = difference(points, block_len)
    longest = longest_series(points, longest)
    a = first_nonpositive(steps, lag_sums(steps, block_len, longest), block_len, longest).select(*KEY, F.col("tau").alias("a"))
    b = first_nonpositive(points, sums, block_len, longest).filter(F.col("sd") > 0).select(*KEY, F.col("tau").alias("b"))
    both = b.join(a, KEY, "left").select(*KEY, F.try_divide("a", "b").alias("FC_LocalSimple_mean1_tauresrat"))
    return points.select(*KEY).distinct().join(both, KEY, "left")


def periodicity(points: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None) -> DataFrame:
    """First autocorrelation peak that rises 0.01 above the trough before it.

    The trend removed first is the least-squares cubic spline with one knot at
    mid-series; its normal equations are plain sums.
    """
    z = standardised(points, block_len)
    sizes = z.groupBy(*KEY).agg(F.count("*").alias("n"))
    rows = attach(split_blocks(z, block_len=block_len), sizes, block_len)
    scale = F.greatest((F.col("n") - 1) / 2.0, F.lit(1.0))
    x = F.col("t") / scale - 1
    knot = (F.floor(F.col("n") / 2) - 1) / scale - 1
    rows = rows.withColumn("x", x).withColumn("u", F.greatest(F.col("x") - knot, F.lit(0.0)))
    basis = [F.lit(1.0), F.col("x"), F.pow("x", F.lit(2.0)), F.pow("x", F.lit(3.0)), F.pow("u", F.lit(3.0))]
    names = [*basis, F.col("v")]
    sums = [F.sum(names[i] * names[j]).alias(f"g{i}_{j}") for i in range(6) for j in range(i, 6)]
    cells = [F.col(f"g{min(i, j)}_{max(i, j)}") for i in range(6) for j in range(6)]
    fit = rows.groupBy(*KEY).agg(F.count("*").alias("n"), *sums)
    fit = fit.select(*KEY, "n", kernels.solve_gram(F.array(*cells), F.lit(6)).alias("b"))
    rest = attach(rows.drop("n", "own"), fit, block_len)
    trend = sum((F.get("b", F.lit(i)) * c for i, c in enumerate(basis)), F.lit(0.0))
    rest = rest.select(*KEY, "t", (F.col("v") - trend).alias("v"))
    longest = longest_series(points, longest)
    top = F.ceil(F.col("n") / 3).cast("int")
    s = lag_sums(rest, block_len, longest)
    name = "PD_PeriodicityWang_th0_01"
    out = _first_peak(s.filter(F.col("n") <= block_len), top).select(*KEY, F.col("out").alias(name))
    if longest > block_len:
        far = _first_peak_of_rows(rest, s.filter(F.col("n") > block_len).select(*KEY), top, block_len)
        out = out.unionByName(far.select(*KEY, F.col("out").alias(name)))
    return points.select(*KEY).distinct().join(out, KEY, "left")


def _first_peak(sums: DataFrame, top: Column) -> DataFrame:
    """``out``: the first qualifying peak among lags 1..top of lag product arrays, 0 if there is none."""
    ac = sums.select(*KEY, F.transform(F.slice("s", 2, top), lambda x, i: x / (F.col("n") - i - 1)).alias("ac"))
    marked = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.size("ac") - 2, F.lit(1))),
        F.struct(F.lit(None).cast("double").alias("low"), F.lit(None).cast("int").alias("out")),
        lambda a, i: F.when(a["out"].isNotNull(), a)
        .when(
            (F.get("ac", i) < F.get("ac", i - 1)) & (F.get("ac", i) < F.get("ac", i + 1)),
            F.struct(F.get("ac", i).alias("low"), a["out"].alias("out")),
        )
        .when(
            (F.get("ac", i) > F.get("ac", i - 1))
            & (F.get("ac", i) > F.get("ac", i + 1))
            & (F.get("ac", i) - a["low"] >= 0.01)
            & (F.get("ac", i) >= 0),
            F.struct(a["low"].alias("low"), i.alias("out")),
        )
        .otherwise(a),
    )
    return ac.select(*KEY, F.coalesce(marked["out"], F.lit(0)).cast("double").alias("out"))


def _first_peak_of_rows(points: DataFrame, keys: DataFrame, top: Column, block_len: int) -> DataFrame:
    """The same from lag rows; the trough before a lag is carried over the blocks of lags."""
    lags = lag_rows(points, describe(points).join(keys, KEY, "left_semi"), block_len).filter((F.col("t") >= 1) & (F.col("t") <= top))
    ac = lags.select(*KEY, "t", (F.col("s") / (F.col("n") - F.col("t"))).alias("ac"))
    x, a, b = F.col("ac"), F.col("before"), F.col("after")
    rows = nearest(beside(ac, "ac", block_len), F.when((x < a) & (x < b), x), "trough", "_next", inclusive=False)
    peak = (x > a) & (x > b) & (x - F.col("trough") >= 0.01) & (x >= 0)
    first = rows.groupBy(*KEY).agg(F.min(F.when(peak, F.col("t") - 1)).alias("first"))
    return first.select(*KEY, F.coalesce("first", F.lit(0)).cast("double").alias("out"))


def embedding_misfit(points: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None) -> DataFrame:
    """Mean gap between the histogram of successive distances in the (t, t + tau)
    plane and the exponential density with the same mean."""
    z = standardised(points, block_len)
    longest = longest_series(points, longest)
    tau = first_nonpositive(z, lag_sums(z, block_len, longest), block_len, longest).select(
        *KEY, "n", F.least(F.col("tau"), F.floor(F.col("n") / 10)).alias("tau")
    )
    steps = attach(split_blocks(difference(z, block_len), block_len=block_len), tau, block_len)
    own = F.array("t", F.col("t") - F.col("tau"))
    square = steps.select(*KEY, "n", "tau", F.explode(own).alias("i"), (F.col("v") * F.col("v")).alias("q"))
    dist = (
        square.filter((F.col("i") >= 0) & (F.col("i") < F.col("n") - F.col("tau") - 1))
        .groupBy(*KEY, F.col("i").alias("t"))
        .agg(F.sqrt(F.sum("q")).alias("v"))
    )
    stats = describe(dist)
    bins = F.ceil((F.col("vmax") - F.col("vmin")) / (F.lit(3.5) * F.col("sd") / F.pow("n", F.lit(1.0 / 3.0))))
    shape = stats.select(
        *KEY, "n", F.col("mean").alias("l"), "vmin", "vmax", F.when(F.col("sd") >= 0.001, bins).otherwise(F.lit(0)).alias("bins")
    )
    rows = attach(split_blocks(dist, block_len=block_len), shape.filter("bins > 0"), block_len)
    step = (F.col("vmax") - F.col("vmin")) / F.col("bins")
    slot = F.least(F.floor((F.col("v") - F.col("vmin")) / step), F.col("bins") - 1)
    counts = rows.groupBy(*KEY, slot.alias("bin")).agg(F.count("*").alias("c"))
    grid = shape.filter("bins > 0").withColumn("bin", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bins") - 1)))
    centre = F.col("vmin") + step * (F.col("bin") + 0.5)
    gap = F.abs(F.coalesce(F.col("c"), F.lit(0)) / F.col("n") - F.exp(-centre / F.col("l")) / F.col("l"))
    out = grid.join(counts, [*KEY, "bin"], "left").groupBy(*KEY).agg(F.avg(gap).alias("x"))
    name = "CO_Embed2_Dist_tau_d_expfit_meandiff"
    filled = shape.join(out, KEY, "left").select(*KEY, F.coalesce("x", F.lit(0.0)).alias(name))
    return points.select(*KEY).distinct().join(filled, KEY, "left")


# ------------------------------------------------------- scales, fits, folds
def fluctuation(points: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None) -> DataFrame:
    """Share of window lengths in the first of two scaling regimes.

    One-block series are scored in their row.  Of longer ones a block scores the
    windows inside it and hands on moments of those that reach over its ends.
    """
    names = ("SC_FluctAnal_2_rsrangefit_50_1_logi_prop_r1", "SC_FluctAnal_2_dfa_50_1_2_logi_prop_r1")
    blocks = to_blocks(points, block_len=block_len)
    whole = (F.col("block") == 0) & (F.size("values") < block_len)
    short = blocks.filter(whole).select(*KEY, kernels.fluctuation_breaks("values").alias("x"))
    out = short.select(*KEY, F.col("x.rs").alias(names[0]), F.col("x.dfa").alias(names[1]))
    longest = longest_series(points, longest)
    if longest < block_len:
        return out
    rest = blocks.filter(~whole).select(*KEY, "lo", F.posexplode("values").alias("i", "v"))
    rest = rest.select(*KEY, (F.col("lo") + F.col("i")).alias("t"), "v")
    z = standardised(rest, block_len).filter("v is not null")
    length = z.groupBy(*KEY).agg(F.count("*").alias("full"))
    half = z.filter("t % 2 = 0").select(*KEY, F.floor(F.col("t") / 2).alias("t"), "v")
    a = _windowed_break(z, length.withColumn("n", F.col("full")), True, block_len).withColumnRenamed("share", names[0])
    b = _windowed_break(half, length.withColumn("n", F.floor(F.col("full") / 2)), False, block_len).withColumnRenamed("share", names[1])
    keys = rest.select(*KEY).distinct()
    return out.unionByName(keys.join(a, KEY, "left").join(b, KEY, "left").select(*KEY, *names))


def _windowed_break(z: DataFrame, sizes: DataFrame, spread: bool, block_len: int) -> DataFrame:
    """Break share of long series; ``sizes`` has the rows ``n`` and the ``full`` length that gives the scales.

    A block has at most two windows of each scale that reach over its ends.  Their lines are
    fitted from sums over the blocks, and each block then measures its part of the residuals.
    """
    blocks = to_blocks(z, block_len=block_len)
    ends = blocks.select(*BLOCK_KEY, F.aggregate("values", F.lit(0.0), lambda a, x: a + x).alias("e"))
    base = ends.select(*BLOCK_KEY, F.coalesce(F.sum("e").over(earlier_blocks()), F.lit(0.0)).alias("base"))
    walks = attach(blocks, sizes, block_len).join(base, BLOCK_KEY)
    parts = walks.select(*KEY, F.inline(kernels.window_parts("values", "lo", "base", "n", "full", F.lit(spread))))
    inside = parts.filter("w is null").select(*KEY, "tau", "k", "q")
    u2 = F.col("tau") * (F.col("tau") * F.col("tau") - 1) / 12
    fit = parts.filter("w is not null").groupBy(*KEY, "tau", "w").agg((F.sum("s") / F.col("tau")).alias("level"), (F.sum("c") / u2).alias("slope"))
    first = F.floor(F.col("w") * F.col("tau") / block_len)
    last = F.floor(((F.col("w") + 1) * F.col("tau") - 1) / block_len)
    lines = fit.withColumn("block", F.explode(F.sequence(first, last)))
    lines = lines.groupBy(*BLOCK_KEY).agg(F.collect_list(F.struct("tau", "w", "level", "slope")).alias("lines"))
    met = blocks.join(base, BLOCK_KEY).join(lines, BLOCK_KEY)
    met = met.select(*KEY, F.inline(kernels.window_rests("values", "lo", "base", "lines.tau", "lines.w", "lines.level", "lines.slope")))
    measure = F.pow(F.max("high") - F.min("low"), F.lit(2.0)) if spread else F.sum("ss") / F.col("tau")
    over = met.groupBy(*KEY, "tau", "w").agg(measure.alias("q")).select(*KEY, "tau", F.lit(1).cast("bigint").alias("k"), "q")
    per = inside.unionByName(over).groupBy(*KEY, "tau").agg(F.sqrt(F.sum("q") / F.sum("k")).alias("f"))
    packed = per.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("tau", "f"))).alias("x"))
    return packed.select(*KEY, kernels.break_of_scales("x.tau", "x.f").alias("share"))


def walker_crossing(points: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """Share of steps where a walker with gain 0.1 crosses the series.

    The walker forgets by 0.9 per step, so 512 earlier values fix it to the last bit.
    """
    z = standardised(points, block_len)
    sizes = z.groupBy(*KEY).agg(F.count("*").alias("n"))
    blocks = attach(to_blocks(z, before=512, block_len=block_len), sizes, block_len)
    start = F.greatest(F.col("block") * block_len, F.lit(1))
    zero = F.struct(F.lit(0.0).alias("w"), F.lit(None).cast("double").alias("x"), F.col("lo").alias("t"), F.lit(0).cast("bigint").alias("c"))

    def step(a: Column, x: Column) -> Column:
        w = F.when(a["x"].isNull(), a["w"]).otherwise(a["w"] + (a["x"] - a["w"]) * 0.1)
        cross = (a["t"] >= start) & ((a["w"] - a["x"]) * (w - x) < 0)
        return F.struct(w.alias("w"), x.alias("x"), (a["t"] + 1).alias("t"), (a["c"] + F.coalesce(cross, F.lit(False)).cast("bigint")).alias("c"))

    parts = blocks.select(*KEY, "n", F.aggregate("values", zero, step)["c"].alias("c"))
    out = parts.groupBy(*KEY).agg(F.try_divide(F.sum("c"), F.max("n") - 1).alias("walker_propcross"))
    return points.select(*KEY).distinct().join(out, KEY, "left")


def holt_parameters(points: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """L26 (re-aimed): level and slope gains with the least squared one-step error on a grid.

    The state starts at the second value with the first difference as slope.  A
    block changes the state linearly, so blocks give small matrices that are
    chained in block order, one row of the grid at a time.
    """
    z = standardised(points, block_len)
    sizes = z.groupBy(*KEY).agg(F.count("*").alias("n")).filter(F.col("n") >= 3)
    blocks = attach(to_blocks(z, block_len=block_len), sizes, block_len)
    skip = F.when(F.col("block") == 0, 2).otherwise(0)
    maps = blocks.select(
        *BLOCK_KEY,
        F.when(F.col("block") == 0, F.slice("values", 1, 2)).alias("head"),
        F.posexplode(kernels.holt_maps("values", skip)).alias("g", "m"),
    )
    chain = maps.groupBy(*KEY, "g").agg(
        F.sort_array(F.collect_list(F.struct("block", "m"))).alias("ms"), F.first("head", ignorenulls=True).alias("head")
    )
    first, second = F.get("head", F.lit(0)), F.get("head", F.lit(1))
    zero = F.struct(second.alias("l"), (second - first).alias("b"), F.lit(0.0).alias("sse"))

    def step(a: Column, x: Column) -> Column:
        m = lambda i: F.get(x["m"], F.lit(i))
        h = [a["l"], a["b"], F.lit(1.0)]
        q = F.lit(0.0)
        for i in range(3):
            for j in range(3):
                q = q + m(6 + 3 * i + j) * h[i] * h[j]
        return F.struct(
            (m(0) * h[0] + m(1) * h[1] + m(2)).alias("l"), (m(3) * h[0] + m(4) * h[1] + m(5)).alias("b"), (a["sse"] + q).alias("sse")
        )

    scored = chain.select(*KEY, "g", F.aggregate("ms", zero, step)["sse"].alias("sse"))
    best = scored.groupBy(*KEY).agg(F.min(F.struct("sse", "g")).alias("b"))
    alphas = F.array(*[F.lit(float(a)) for a, _ in kernels.HOLT_GRID])
    betas = F.array(*[F.lit(float(b)) for _, b in kernels.HOLT_GRID])
    out = best.select(*KEY, F.get(alphas, F.col("b.g")).alias("alpha"), F.get(betas, F.col("b.g")).alias("beta"))
    return points.select(*KEY).distinct().join(out, KEY, "left")


BOX_COX_GRID = [round(-1 + 0.1 * i, 1) for i in range(31)]  # fixed values: -1, -0.9, .., 2


def box_cox(points: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """L36 (re-aimed): lambda on a grid with the least variation of sd / mean^(1 - lambda)
    over pairs of neighbours (Guerrero 1993); negative lambdas need positive values."""
    sizes = points.groupBy(*KEY).agg(F.count("*").alias("n"), F.min("v").alias("vmin"))
    rows = attach(split_blocks(points, block_len=block_len), sizes, block_len)
    odd = F.col("n") % 2
    pair = F.floor((F.col("t") - odd) / 2)
    pairs = (
        rows.filter(F.col("t") >= odd)
        .groupBy(*KEY, pair.alias("pair"))
        .agg(F.avg("v").alias("m"), F.stddev_samp("v").alias("s"))
        .filter("m > 0")
    )
    ratio = {i: F.col("s") * F.pow("m", F.lit(lam - 1)) for i, lam in enumerate(BOX_COX_GRID)}
    agg = pairs.groupBy(*KEY).agg(*[F.try_divide(F.stddev_samp(r), F.avg(r)).alias(f"c{i}") for i, r in ratio.items()])
    agg = agg.join(sizes.select(*KEY, "vmin"), KEY)
    cells = [
        F.when((F.col("vmin") > 0) | F.lit(lam >= 0), F.struct(F.round(F.col(f"c{i}"), 12).alias("cv"), F.lit(lam).alias("lam")))
        for i, lam in enumerate(BOX_COX_GRID)
    ]
    known = F.filter(F.array_compact(F.array(*cells)), lambda x: x["cv"].isNotNull())
    out = agg.select(*KEY, F.array_min(known)["lam"].alias("lambdas"))
    return points.select(*KEY).distinct().join(out, KEY, "left")


def trend_features(points: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None) -> DataFrame:
    """Strengths of a smooth trend at frequency 1 and of what it leaves.

    The smoother picks its span per point from fractions of the series length, so
    it runs where the whole series is one row; longer series use the smoother's
    block-wise form in ``long_smooth``.
    """
    z = standardised(points, block_len)
    blocks = to_blocks(z, block_len=block_len)
    whole = (F.col("block") == 0) & (F.size("values") < block_len)
    fitted = blocks.filter(whole).select(
        *KEY, F.posexplode(F.arrays_zip("values", kernels.smooth_trend("values").alias("f"))).alias("t", "x")
    ).select(*KEY, F.col("t").cast("bigint").alias("t"), F.col("x.values").alias("v"), F.col("x.f").alias("trend"))
    longest = longest_series(points, longest)
    if longest < block_len:
        return strength_features(points, fitted, block_len)
    rest = blocks.filter(~whole).select(*KEY, "lo", F.posexplode("values").alias("i", "v"))
    rest = rest.select(*KEY, (F.col("lo") + F.col("i")).alias("t"), "v")
    rows = fitted.unionByName(long_smooth(rest, block_len))
    return strength_features(points, rows, block_len)


def strength_features(points: DataFrame, rows: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """trend, spike, linearity, curvature and e_acf of rows (KEY, t, v, trend)."""
    rows = rows.withColumn("e", F.col("v") - F.col("trend"))
    sizes = rows.groupBy(*KEY).agg(
        F.count("*").alias("n"), F.var_samp("e").alias("vare"), F.var_samp("v").alias("varx"), F.avg("e").alias("me")
    )
    placed = attach(split_blocks(rows, block_len=block_len), sizes, block_len)
    n, d = F.col("n"), F.pow(F.col("e") - F.col("me"), F.lit(2.0))
    loo = F.try_divide(F.col("vare") * (n - 1) - d, n - 2)
    # orthogonal polynomials of degree 1 and 2 on 0..n-1, unit length
    c = F.col("t") - (n - 1) / 2.0
    s1 = F.sqrt(n.cast("double") * (n * n - 1) / 12.0)
    q = c * c - (n * n - 1) / 12.0
    s2 = F.sqrt(n.cast("double") * (n * n - 1) * (n * n - 4) / 180.0)
    agg = placed.groupBy(*KEY).agg(
        F.var_samp(loo).alias("spike"),
        F.sum(F.try_divide(c * F.col("trend"), s1)).alias("linearity"),
        F.sum(F.try_divide(q * F.col("trend"), s2)).alias("curvature"),
    )
    acf = lagged_correlations(rows.select(*KEY, "t", F.col("e").alias("v")), 10, block_len).select(
        *KEY,
        F.get("ac", F.lit(0)).alias("e_acf1"),
        F.aggregate("ac", F.lit(0.0), lambda s, x: s + x * x).alias("e_acf10"),
    )
    trend = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.try_divide("vare", "varx")))
    out = sizes.select(*KEY, trend.alias("trend")).join(agg, KEY).join(acf, KEY, "left")
    return points.select(*KEY).distinct().join(out, KEY, "left").select(
        *KEY,
        F.lit(0.0).alias("nperiods"),
        F.lit(1.0).alias("seasonal_period"),
        "trend", "spike", "linearity", "curvature", "e_acf1", "e_acf10",
    )
