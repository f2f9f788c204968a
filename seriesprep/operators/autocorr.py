"""Lag products and what follows from them (L5, L6, L13, L20, L21, L31, tau of L1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from ..layout import (
    BLOCK_KEY,
    BLOCK_LEN,
    KEY,
    attach,
    in_order,
    longest_series,
    merge_block_arrays,
    split_blocks,
    to_blocks,
    within,
)
from .fourier import split_transform
from .order import describe


# A series longer than a block keeps so many lags in its row; what asks for more reads them as rows.
ROW_LAGS = 4096


def lag_sums(points: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None) -> DataFrame:
    """``n``, ``sd`` and ``s``: s[k] = sum over t of (v[t]-mean)(v[t+k]-mean).

    All lags k < n of a series that fits one block, the first ROW_LAGS of a longer one.
    """
    points = within(points, longest)
    stats = describe(points)
    several = longest_series(points, longest) > block_len
    most = min(ROW_LAGS, block_len)
    blocks = attach(
        to_blocks(points, after=most if several else 0, block_len=block_len), stats.select(*KEY, "n", "mean"), block_len
    )
    count = F.when(F.col("n") <= block_len, F.col("n")).otherwise(F.lit(most))
    own = F.slice("values", 1, block_len)
    parts = blocks.select(
        *BLOCK_KEY, "n", kernels.lag_products(own, "values", "mean", F.lit(0), count).alias("s")
    )
    parts = merge_block_arrays(parts, "s", block_len) if several else parts.drop("block")
    return parts.join(stats.select(*KEY, "sd"), KEY)


def lag_rows(points: DataFrame, wanted: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """``(KEY, n, t, s)``: the lag product ``s`` of every lag t < n, one row each, for the series in ``wanted``
    (KEY, n, mean).

    The products are the transform of the squared modulus of the series' own transform, padded to twice
    its length; both are spread over many rows, so no series is ever one array.
    """
    rows = attach(split_blocks(points, block_len=block_len), wanted.select(*KEY, "n", "mean"), block_len)
    padded = rows.withColumn("e", F.ceil(F.log2(F.col("n") * 2)).cast("int"))
    cell = [*KEY, "n", "e", "t"]
    spectrum = split_transform(padded.select(*cell, (F.col("v") - F.col("mean")).alias("re"), F.lit(0.0).alias("im")))
    power = F.col("re") * F.col("re") + F.col("im") * F.col("im")
    back = split_transform(spectrum.select(*cell, power.alias("re"), F.lit(0.0).alias("im")))
    # the power is real and even, so its forward transform is the inverse one but for the scale
    return back.filter("t < n").select(*KEY, "n", "t", (F.col("re") / F.pow(F.lit(2.0), F.col("e"))).alias("s"))


def beside(rows: DataFrame, column: str, block_len: int = BLOCK_LEN) -> DataFrame:
    """Add ``before`` and ``after``: ``column`` of the neighbouring t, whatever block it lies in."""
    w = in_order()
    spread = split_blocks(rows, before=1, after=1, block_len=block_len)
    near = spread.withColumn("before", F.lag(column).over(w)).withColumn("after", F.lead(column).over(w))
    return near.filter("own").drop("own")


def first_index(s: Column, test) -> Column:
    """0-based index of the first element that passes, NULL if none does."""
    pos = F.array_position(F.transform(s, lambda x, i: F.coalesce(test(x, i), F.lit(False))), True)
    return F.when(pos > 0, pos - 1)


def first_nonpositive(
    points: DataFrame, sums: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None
) -> DataFrame:
    """tau: first lag whose autocorrelation is <= 0, the length if there is none.

    Series that don't have it among the lags of their row take the least of their lag rows.
    """
    points = within(points, longest)
    found = sums.select(*KEY, "n", "sd", F.size("s").alias("m"), first_index(F.col("s"), lambda x, _: x <= 0).alias("tau"))
    if longest_series(points, longest) <= block_len:
        return found.drop("m").withColumn("tau", F.coalesce("tau", F.col("n")))
    open_ = found.filter(F.col("tau").isNull() & (F.col("m") < F.col("n"))).select(*KEY)
    hits = lag_rows(points, describe(points).join(open_, KEY, "left_semi"), block_len).filter("s <= 0")
    hits = hits.groupBy(*KEY).agg(F.min("t").alias("hit"))
    return found.join(hits, KEY, "left").select(*KEY, "n", "sd", F.coalesce("tau", "hit", "n").alias("tau"))


def _acf_columns(ok: Column, cross: Column, low: Column, zero: Column) -> list[Column]:
    n = F.col("n")
    return [
        F.when(ok, F.coalesce(cross, n.cast("double"))).alias("CO_f1ecac"),
        F.when(ok, F.coalesce(low, n)).cast("double").alias("CO_FirstMin_ac"),
        F.when(ok, F.coalesce(low, n - 1)).cast("double").alias("firstmin_ac"),
        F.when(ok, F.coalesce(zero, F.lit(0))).cast("double").alias("firstzero_ac"),
    ]


def acf_features(
    points: DataFrame, sums: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None
) -> DataFrame:
    """L5, L6, L31 from the lag products of each series; constant series give NULL.

    Series longer than a block whose row of lags ends too early are read as lag rows.
    """
    ac = F.when(F.col("sd") > 0, F.transform("s", lambda x: x / F.get("s", F.lit(0))))
    rows = sums.select(*KEY, "n", ac.alias("ac"))
    bound = F.exp(F.lit(-1.0))
    fall = first_index(F.slice("ac", 1, F.greatest(F.col("n") - 1, F.lit(1)).cast("int")), lambda x, i: (i > 0) & (x < bound))
    a, b = F.get("ac", (fall - 1).cast("int")), F.get("ac", fall.cast("int"))
    low = first_index(
        F.col("ac"), lambda x, i: (i > 0) & (x < F.get("ac", i - 1)) & (x < F.get("ac", i + 1))
    )
    zero = first_index(F.col("ac"), lambda x, i: x < 0)  # below zero is below 1/e too
    columns = _acf_columns(F.col("ac").isNotNull(), fall - 1 + (bound - a) / (b - a), low, zero)
    if longest_series(points, longest) <= block_len:
        return rows.select(*KEY, *columns)
    ended = F.coalesce((F.size("ac") < F.col("n")) & (low.isNull() | zero.isNull()), F.lit(False))
    rows = rows.withColumn("ended", ended)
    rest = describe(points).join(rows.filter("ended").select(*KEY), KEY, "left_semi")
    lags = lag_rows(points, rest, block_len)
    first = lags.filter("t = 0").select(*KEY, "n", F.col("s").alias("s0"))
    scaled = attach(split_blocks(lags.select(*KEY, "t", "s"), block_len=block_len), first, block_len).drop("block", "own")
    near = beside(scaled.withColumn("ac", F.col("s") / F.col("s0")), "ac", block_len)
    x, past, i = F.col("ac"), F.col("before"), F.col("t")
    falls = F.when((i > 0) & (i <= F.col("n") - 2) & (x < bound), F.struct("t", "before", "ac"))
    found = near.groupBy(*KEY).agg(
        F.first("n").alias("n"),
        F.min(falls).alias("fall"),
        F.min(F.when((i > 0) & (x < past) & (x < F.col("after")), i)).alias("low"),
        F.min(F.when(x < 0, i)).alias("zero"),
    )
    a, b = F.col("fall.before"), F.col("fall.ac")
    far = _acf_columns(F.lit(True), F.col("fall.t") - 1 + (bound - a) / (b - a), F.col("low"), F.col("zero"))
    return rows.filter("NOT ended").select(*KEY, *columns).unionByName(found.select(*KEY, *far))


def difference(points: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """First difference as points again, t shifted down by one."""
    rows = split_blocks(points, before=1, block_len=block_len)
    return (
        rows.withColumn("v", F.col("v") - F.lag("v").over(in_order()))
        .filter("own AND t > 0")
        .select(*KEY, (F.col("t") - 1).alias("t"), "v")
    )


def lagged_correlations(points: DataFrame, lags: int, block_len: int = BLOCK_LEN) -> DataFrame:
    """``ac``: autocorrelations 1..lags (full-sample mean and variance), natively by lag columns."""
    stats = describe(points)
    rows = attach(split_blocks(points, lags, 0, block_len), stats.select(*KEY, "n", "mean", "sd"), block_len)
    w = in_order()
    d = F.col("v") - F.col("mean")
    rows = rows.withColumn("d", d).select("*", *[F.lag("d", k).over(w).alias(f"d{k}") for k in range(1, lags + 1)])
    sums = rows.filter("own").groupBy(*KEY).agg(
        F.first("n").alias("n"),
        F.sum(F.col("d") * F.col("d")).alias("s0"),
        *[F.coalesce(F.sum(F.col("d") * F.col(f"d{k}")), F.lit(0.0)).alias(f"s{k}") for k in range(1, lags + 1)],
    )
    return sums.select(
        *KEY, "n", F.array(*[F.try_divide(F.col(f"s{k}"), F.col("s0")) for k in range(1, lags + 1)]).alias("ac")
    )


def _squares(c: str, k: int) -> Column:
    return F.aggregate(F.slice(c, 1, k), F.lit(0.0), lambda s, x: s + x * x)


def _partial(ac: Column, order: int) -> Column:
    """Partial autocorrelations 1..order by the Durbin-Levinson recursion."""
    one = F.struct(F.array(F.get(ac, F.lit(0))).alias("phi"), F.array(F.get(ac, F.lit(0))).alias("out"))

    def step(acc: Column, k: Column) -> Column:
        phi = acc["phi"]
        back = F.reverse(phi)
        past = F.slice(ac, 1, k - 1)
        dot = lambda a: F.aggregate(F.zip_with(a, past, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        last = F.try_divide(F.get(ac, k - 1) - dot(back), F.lit(1.0) - dot(phi))
        fresh = F.concat(F.zip_with(phi, back, lambda x, y: x - last * y), F.array(last))
        return F.struct(fresh.alias("phi"), F.concat(acc["out"], F.array(last)).alias("out"))

    return F.aggregate(F.sequence(F.lit(2), F.lit(order)), one, step, lambda acc: acc["out"])


def acf_pacf(points: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """Squared (partial) autocorrelations, raw and differenced once and twice."""
    once = difference(points, block_len)
    twice = difference(once, block_len)
    out = None
    for frame, acf, pacf in (
        (points, "x", "x"),
        (once, "diff1", "diff1x"),
        (twice, "diff2", "diff2x"),
    ):
        rows = lagged_correlations(frame, 10, block_len).withColumn("pac", _partial(F.col("ac"), 5))
        part = rows.select(
            *KEY,
            F.get("ac", F.lit(0)).alias(f"{acf}_acf1"),
            _squares("ac", 10).alias(f"{acf}_acf10"),
            _squares("pac", 5).alias(f"{pacf}_pacf5"),
        )
        out = part if out is None else out.join(part, KEY, "left")
    return out


def gaussian_information(points: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """First minimum over lags 1..40 of the Gaussian mutual information."""
    top = 40
    stats = describe(points)
    rows = attach(split_blocks(points, top, 0, block_len), stats.select(*KEY, "n", "mean", "sd"), block_len)
    w = in_order()
    rows = rows.withColumn("d", F.col("v") - F.col("mean"))
    rows = rows.select(*KEY, "own", "n", "t", "d", *[F.lag("d", k).over(w).alias(f"d{k}") for k in range(1, top + 1)])
    rows = rows.filter("own")

    # the pairs at lag k leave out the first k and the last k values: keep those few
    def edge(near: Column, place: Column) -> Column:
        return F.sort_array(F.collect_list(F.when(near, F.struct(place.alias("i"), "d"))))["d"]

    d = F.col("d")
    agg = rows.groupBy(*KEY).agg(
        F.first("n").alias("n"),
        F.sum("d").alias("s"),
        F.sum(d * d).alias("q"),
        edge(F.col("t") < top, F.col("t")).alias("head"),
        edge(F.col("t") >= F.col("n") - top, F.col("n") - F.col("t")).alias("tail"),
        *[F.sum(d * F.col(f"d{k}")).alias(f"p{k}") for k in range(1, top + 1)],
    )

    products = F.array(*[F.coalesce(f"p{k}", F.lit(0.0)) for k in range(1, top + 1)])
    agg = agg.select(*KEY, "n", "s", "q", "head", "tail", products.alias("p"))

    def information(k: Column) -> Column:
        m = F.col("n") - k
        cut = lambda side: F.slice(side, F.lit(1), k)
        gone = lambda side: F.aggregate(cut(side), F.lit(0.0), lambda s, x: s + x)
        gone2 = lambda side: F.aggregate(cut(side), F.lit(0.0), lambda s, x: s + x * x)
        sa, sb = F.col("s") - gone("head"), F.col("s") - gone("tail")
        va = F.col("q") - gone2("head") - F.try_divide(sa * sa, m)
        vb = F.col("q") - gone2("tail") - F.try_divide(sb * sb, m)
        cov = F.get("p", k - 1) - F.try_divide(sa * sb, m)
        return F.when(m > 1, -0.5 * F.log(1 - F.try_divide(cov * cov, va * vb)))

    limit = F.least(F.lit(top), F.ceil(F.col("n") / 2)).cast("int")
    ami = F.transform(F.sequence(F.lit(1), F.col("limit")), information)
    rs = agg.withColumn("limit", limit).withColumn("ami", ami)
    low = first_index(
        F.col("ami"), lambda x, i: (i > 0) & (x < F.get("ami", i - 1)) & (x < F.get("ami", i + 1))
    )
    return rs.select(
        *KEY,
        F.when(F.get("ami", F.lit(0)).isNotNull(), F.coalesce(low, F.col("limit")))
        .cast("double")
        .alias("IN_AutoMutualInfoStats_40_gaussian_fmmi"),
    )
