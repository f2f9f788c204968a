"""Aggregates over the points of a series (AGG1-AGG5, AGG7-AGG9, AGG11, AGG17) and
the library features that look at most three neighbours (L8, L9, L14, L23, L32).

``point_features`` computes any subset in one pass: one shuffle on the block key,
one window, one aggregation with map-side partials.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..layout import BLOCK_LEN, KEY, attach, in_order, split_blocks
from .order import describe, inversions


def _d() -> Column:
    return F.col("v") - F.col("prev")


def _dz() -> Column:
    return F.try_divide(_d(), F.col("sd"))


def _count(test: Column) -> Column:
    return F.sum(F.coalesce(test, F.lit(False)).cast("int"))


def _above(c: str, line: str) -> Column:
    return F.col(c) > F.col(line)


def _turn() -> Column:
    v, p, x = F.col("v"), F.col("prev"), F.col("next")
    return ((v > p) & (v > x)) | ((v < p) & (v < x))


def _mean3_residual() -> Column:
    back = F.col("prev") + F.col("prev2") + F.col("prev3")
    return F.try_divide(F.col("v") - back / 3, F.col("sd"))


# name -> aggregate over rows with v, prev, prev2, prev3, next, n, mean, sd, med
POINT_FEATURES = {
    "skewness": lambda: F.skewness("v"),
    "kurt": lambda: F.kurtosis("v"),
    "rsd": lambda: F.abs(F.try_divide(F.stddev_pop("v"), F.avg("v"))) * 100,
    "std_of_first_derivative": lambda: F.stddev_pop(_d()),
    "turning_points": lambda: _count(_turn()) / F.count("*"),
    "series_in_series": lambda: (_count(_above("v", "med") != _above("prev", "med")) + 1) / F.count("*"),
    "length": lambda: F.count("*"),
    "mean": lambda: F.avg("v"),
    "var": lambda: F.var_samp("v"),
    "CO_trev_1_num": lambda: F.avg(F.pow(_dz(), 3.0)),
    "MD_hrv_classic_pnn40": lambda: F.try_divide(
        F.when(F.max("sd") > 0, _count(F.abs(_dz()) * 1000 > 40)), F.count("*") - 1
    ),
    "FC_LocalSimple_mean3_stderr": lambda: F.stddev_samp(_mean3_residual()),
    "crossing_points": lambda: _count(_above("v", "med") != _above("prev", "med")),
    "trev_num": lambda: F.avg(F.pow(_dz(), 3.0)),
    "std1st_der": lambda: F.stddev_samp(_dz()),
}
_NEEDS_MEDIAN = {"series_in_series", "crossing_points"}

# the bundle of simple features, in report order (inversions joins separately)
BUNDLE = ["skewness", "kurt", "rsd", "std_of_first_derivative", "inversions", "turning_points", "series_in_series"]


def point_features(
    points: DataFrame, names: list[str], block_len: int = BLOCK_LEN, longest: int | None = None
) -> DataFrame:
    """Selected POINT_FEATURES, one row per series."""
    w = in_order()
    stats = describe(points, median=bool(_NEEDS_MEDIAN & set(names)), block_len=block_len, longest=longest)
    if "med" not in stats.columns:
        stats = stats.withColumn("med", F.lit(None).cast("double"))
    rows = attach(
        split_blocks(points, 3, 1, block_len), stats.select(*KEY, "n", "sd", "med"), block_len
    )
    for k, name in ((1, "prev"), (2, "prev2"), (3, "prev3")):
        rows = rows.withColumn(name, F.lag("v", k).over(w))
    rows = rows.withColumn("next", F.lead("v").over(w)).filter("own")
    return rows.groupBy(*KEY).agg(*[POINT_FEATURES[k]().alias(k) for k in names])


def other_features(points: DataFrame, block_len: int = BLOCK_LEN, longest: int | None = None) -> DataFrame:
    """AGG8: the seven simple features of one series."""
    simple = point_features(points, [b for b in BUNDLE if b != "inversions"], block_len, longest)
    return simple.join(inversions(points, block_len, longest).drop("pairs"), KEY, "left").select(*KEY, *BUNDLE)


def mean_rows(report: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    """AGG9: average of every numeric column over the channels of a series set."""
    numeric = [f.name for f in report.schema if f.dataType.typeName() in ("double", "float", "integer", "long")]
    keep = [c for c in numeric if c not in skip]
    return report.groupBy("series_id").agg(*[F.avg(F.when(~F.isnan(c), F.col(c))).alias(c) for c in keep])
