"""Column functions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Standard periods and the range of detected periods each absorbs.
STANDARD_PERIODS = [
    (3, 5, 4),
    (6, 8, 7),
    (10, 14, 12),
    (21, 27, 24),
    (44, 49, 48),
    (50, 54, 52),
    (86, 106, 96),
    (134, 154, 144),
    (158, 178, 168),
    (286, 386, 336),
    (652, 692, 672),
    (700, 740, 720),
    (908, 1108, 1008),
    (1240, 1640, 1440),
    (8266, 9266, 8766),
    (9580, 10580, 10080),
    (19600, 23600, 21600),
    (41200, 45200, 43200),
]

# Periods tested for every series.
DEFAULT_PERIODS = [4, 7, 12, 24, 48, 52, 96, 144, 168, 336, 672, 1008, 1440]


def adjust_period(p: Column) -> Column:
    """MATH1/J6: snap a detected period to the standard period whose range holds it."""
    first, *rest = STANDARD_PERIODS
    out = F.when(p.between(first[0], first[1]), F.lit(first[2]))
    for lo, hi, std in rest:
        out = out.when(p.between(lo, hi), F.lit(std))
    return out.otherwise(p).cast("bigint")


def bin_period(n: Column, k: Column) -> Column:
    """MATH4: period of spectral bin k, rounded half to even."""
    return F.bround(n.cast("double") / k).cast("bigint")


def period_limit(n: Column) -> Column:
    """a period is tested when strictly below this."""
    return F.greatest(F.floor(n / 3), F.lit(12))


def normal_density(x: Column, mu: Column, sigma: Column) -> Column:
    """MATH5."""
    z = (x - mu) / sigma
    return F.exp(-(z * z) / 2) / (sigma * F.sqrt(F.lit(2.0) * F.pi()))


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function.

    Series around 0 for |z| < 3, continued fraction beyond; both accurate to
    well below 1e-10.
    """
    a = F.abs(z)
    density = F.exp(-a * a / 2) / F.sqrt(F.lit(2.0) * F.pi())
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(60)),
        F.struct(a.alias("term"), a.alias("sum")),
        lambda acc, k: F.struct(
            (acc["term"] * a * a / (k * 2 + 1)).alias("term"),
            (acc["sum"] + acc["term"] * a * a / (k * 2 + 1)).alias("sum"),
        ),
        lambda acc: acc["sum"],
    )
    tail = F.aggregate(F.sequence(F.lit(60), F.lit(1)), a, lambda acc, k: a + k / acc)
    upper = F.when(a < 3, F.lit(0.5) - density * series).otherwise(density / tail)
    return F.when(z < 0, upper).otherwise(F.lit(1.0) - upper)


# Response-surface coefficients of the unit-root t statistic with
# constant, one variable (MacKinnon 1994, 2010).
ADF_SMALL = [2.1659, 1.4412, 0.038269]
ADF_LARGE = [1.7339, 0.93202, -0.12745, -0.010368]
ADF_SWITCH, ADF_MIN, ADF_MAX = -1.61, -18.83, 2.74


def adf_pvalue(stat: Column) -> Column:
    """p-value of the unit-root statistic from the response surface."""

    def poly(coefs):
        out = F.lit(0.0)
        for c in reversed(coefs):
            out = out * stat + F.lit(c)
        return out

    return (
        F.when(stat > ADF_MAX, F.lit(1.0))
        .when(stat < ADF_MIN, F.lit(0.0))
        .when(stat <= ADF_SWITCH, normal_cdf(poly(ADF_SMALL)))
        .when(stat.isNotNull(), normal_cdf(poly(ADF_LARGE)))
    )


# KPSS critical values (level case) and their p-values.
KPSS_TABLE = [(0.347, 0.10), (0.463, 0.05), (0.574, 0.025), (0.739, 0.01)]


def kpss_pvalue(stat: Column) -> Column:
    """Linear interpolation in the critical-value table, clipped at its ends."""
    out = F.when(stat <= KPSS_TABLE[0][0], F.lit(KPSS_TABLE[0][1]))
    for (x0, p0), (x1, p1) in zip(KPSS_TABLE, KPSS_TABLE[1:]):
        out = out.when(stat <= x1, (stat - x0) * ((p1 - p0) / (x1 - x0)) + p0)
    return out.when(stat.isNotNull(), F.lit(KPSS_TABLE[-1][1]))


def pretty_step(lo: Column, hi: Column, bins: int) -> Column:
    """Step of 1, 2, 5 or 10 times a power of ten nearest to (hi - lo) / bins."""
    cell = (hi - lo) / bins
    base = F.pow(F.lit(10.0), F.floor(F.log10(cell)))
    # The biases 1.5 and 2.75 towards the larger unit.
    two = F.when(base * 2 - cell < (cell - base) * 1.5, base * 2).otherwise(base)
    five = F.when(base * 5 - cell < (cell - two) * 2.75, base * 5).otherwise(two)
    return F.when(base * 10 - cell < (cell - five) * 1.5, base * 10).otherwise(five)
