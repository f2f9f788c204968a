"""Similarity between the channels of one series set (AGG10, W8, J4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import kernels

# The feature columns the score compares, in report order.
COMPARED = [
    "DN_HistogramMode_5",
    "DN_HistogramMode_10",
    "CO_f1ecac",
    "CO_FirstMin_ac",
    "CO_HistogramAMI_even_2_5",
    "CO_trev_1_num",
    "MD_hrv_classic_pnn40",
    "SB_BinaryStats_mean_longstretch1",
    "SB_TransitionMatrix_3ac_sumdiagcov",
    "PD_PeriodicityWang_th0_01",
    "CO_Embed2_Dist_tau_d_expfit_meandiff",
    "IN_AutoMutualInfoStats_40_gaussian_fmmi",
    "FC_LocalSimple_mean1_tauresrat",
    "DN_OutlierInclude_p_001_mdrmd",
    "DN_OutlierInclude_n_001_mdrmd",
    "SP_Summaries_welch_rect_area_5_1",
    "SB_BinaryStats_diff_longstretch0",
    "SB_MotifThree_quantile_hh",
    "SC_FluctAnal_2_rsrangefit_50_1_logi_prop_r1",
    "SC_FluctAnal_2_dfa_50_1_2_logi_prop_r1",
    "SP_Summaries_welch_rect_centroid",
    "FC_LocalSimple_mean3_stderr",
]

TILE = 512
SHARES = 1024  # of the channels of one set


def attach_to_channels(features: DataFrame, sets: DataFrame, shares: int = SHARES) -> DataFrame:
    """``features`` with the columns of ``sets`` (one row per ``series_id``), joined share by share of a set.

    A set's row is first given to each of its shares of channels, so a set with most channels spreads over tasks:
    no task meets more than ``shares`` rows of it in the first join, nor more than a share in the second.  A set without a
    row in ``sets`` is left out; names of columns must differ.
    """
    named = features.withColumn("_share", F.pmod(F.xxhash64("channel"), F.lit(shares)).cast("int"))
    given = named.select("series_id", "_share").distinct().join(sets, "series_id")
    return named.join(given, ["series_id", "_share"]).drop("_share")


def _set_bounds(features: DataFrame, columns: list[str]) -> DataFrame:
    """One row per set: its number of channels and the bounds of every column."""
    return features.groupBy("series_id").agg(
        F.count("*").alias("size"),
        *[f(c).alias(f"{n}_{i}") for i, c in enumerate(columns) for f, n in ((F.min, "lo"), (F.max, "hi"))],
    )


def scale_features(features: DataFrame, columns: list[str]) -> DataFrame:
    """Min-max scaling of every column over the channels; a zero range becomes 0."""
    return _scaled(features, columns).drop("size")


def _scaled(features: DataFrame, columns: list[str]) -> DataFrame:
    """The scaled columns beside the size of the set."""

    def scaled(i: int, c: str) -> Column:
        lo, hi = F.col(f"lo_{i}"), F.col(f"hi_{i}")
        return F.when(hi == lo, F.when(F.col(c).isNotNull(), F.lit(0.0))).otherwise((F.col(c) - lo) / (hi - lo))

    both = attach_to_channels(features.select("series_id", "channel", *columns), _set_bounds(features, columns))
    return both.select("series_id", "channel", "size", *[scaled(i, c).alias(c) for i, c in enumerate(columns)])


def correlation_score(features: DataFrame, columns: list[str] | None = None, tile: int = TILE) -> DataFrame:
    """AGG10: 2 (mean + 1 / (var + 2)) / 3 over |Pearson| of all channel pairs.

    Each channel is a centred unit vector, so a Pearson coefficient is a dot
    product.  Channels are packed into tiles and every pair of tiles is one
    matrix product; no row per channel pair exists.  One channel gives NULL, and
    so does a channel with a missing feature or no variation.
    """
    columns = columns or COMPARED
    scaled = _scaled(features, columns)
    values = F.array(*[F.col(c) for c in columns])
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    mean = total(F.col("x")) / len(columns)
    rows = scaled.select("series_id", "channel", "size", values.alias("x")).select(
        "series_id", "channel", "size", F.transform("x", lambda v: v - mean).alias("x")
    )
    norm = F.sqrt(total(F.transform("x", lambda v: v * v)))
    rows = rows.withColumn("norm", norm)
    unit = rows.select(
        "series_id",
        "channel",
        "size",
        F.when(F.col("norm") > 0, F.transform("x", lambda v: v / F.col("norm"))).alias("u"),
    )
    tiles = F.floor((F.col("size") + tile - 1) / tile)
    packed = (
        unit.withColumn("tiles", tiles)
        .withColumn("tile", F.pmod(F.xxhash64("channel"), F.col("tiles")))
        .groupBy("series_id", "tiles", "tile")
        .agg(F.collect_list("u").alias("u"), F.count("*").alias("c"))
    )
    known = unit.groupBy("series_id").agg(F.count("u").alias("known"), F.count("*").alias("size"))
    # tile i meets every tile j >= i: both sides are addressed by the pair (i, j)
    left = packed.select("series_id", "tile", F.col("u").alias("a"), F.explode(F.sequence("tile", F.col("tiles") - 1)).alias("other"))
    right = packed.select(
        "series_id", F.col("tile").alias("other"), F.col("u").alias("b"), F.explode(F.sequence(F.lit(0).cast("bigint"), "tile")).alias("tile")
    )
    sums = (
        left.join(right, ["series_id", "tile", "other"])
        .filter((F.size("a") > 0) & (F.size("b") > 0))
        .select("series_id", kernels.tile_similarity("a", "b", F.col("tile") == F.col("other")).alias("s"))
        .groupBy("series_id")
        .agg(F.sum("s.total").alias("total"), F.sum("s.square").alias("square"), F.sum("s.pairs").alias("pairs"))
    )
    mean = F.try_divide("total", "pairs")
    var = F.greatest(F.try_divide("square", "pairs") - mean * mean, F.lit(0.0))
    usable = (F.col("size") > 1) & (F.col("known") == F.col("size"))
    score = (mean + F.lit(1.0) / (var + 2)) * 2 / 3
    return known.join(sums, "series_id", "left").select(
        "series_id", F.when(usable, score).alias("correlation")
    )
