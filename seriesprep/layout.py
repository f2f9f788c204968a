"""The two table layouts every operator works on, and how they are partitioned.

points   series_id STRING, channel STRING, t BIGINT, v DOUBLE
         one row per observation, t = 0..n-1 inside a series, NULL = missing
blocks   series_id, channel, block BIGINT, lo BIGINT, values ARRAY<DOUBLE>
         bounded slices of a series; values[0] is the observation at t = lo

A series is never a unit of partitioning.  The unit is (series_id, channel,
block) with at most BLOCK_LEN owned observations, so one series holding a large
share of all rows is spread over as many tasks as it has blocks.  Steps that
look at neighbouring observations copy a halo of a few rows into the adjacent
block; steps that need something from all earlier blocks scan one summary row
per block.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

KEY = ["series_id", "channel"]
BLOCK_KEY = [*KEY, "block"]

# A multiple of lcm(30, 336) so that both default divergence windows tile a
# block exactly.
BLOCK_LEN = 100_800


def clean_value(c: Column) -> Column:
    """NaN becomes NULL: the one spelling of a missing value."""
    c = c.cast("double")
    return F.when(~F.isnan(c), c)


def split_blocks(
    points: DataFrame, before: int | Column = 0, after: int | Column = 0, block_len: int = BLOCK_LEN
) -> DataFrame:
    """Add ``block`` and ``own``; copy rows within ``before``/``after`` of a block edge.

    A row belongs to exactly one block (``own``); the other copies are the halo
    of the neighbouring blocks.
    """
    home = F.floor(F.col("t") / block_len)
    if isinstance(before, int) and isinstance(after, int) and before + after == 0:
        if "block" in points.columns:  # already placed: keep the column its partitioning refers to
            return points.withColumn("own", F.lit(True))
        return points.withColumn("block", home).withColumn("own", F.lit(True))
    first = F.greatest(F.floor((F.col("t") - after) / block_len), F.lit(0))
    last = F.floor((F.col("t") + before) / block_len)
    return points.withColumn("block", F.explode(F.sequence(first, last))).withColumn(
        "own", F.col("block") == home
    )


def attach(blocked: DataFrame, per_series: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """Join per-series columns (with the length ``n``) to rows that carry a block.

    The per-series side is repeated once per block, so the join key includes the
    block and a very long series does not end up in one join partition.
    """
    spread = per_series.withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / block_len)))
    )
    return blocked.join(spread, BLOCK_KEY)


def in_order() -> Window:
    """Window over the rows of one block in time order."""
    return Window.partitionBy(*BLOCK_KEY).orderBy("t")


def earlier_blocks() -> Window:
    """Window over the summary rows of all blocks before the current one."""
    return Window.partitionBy(*KEY).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)


def later_blocks() -> Window:
    """Window over the summary rows of all blocks after the current one."""
    return Window.partitionBy(*KEY).orderBy("block").rowsBetween(1, Window.unboundedFollowing)


def running_sum(rows: DataFrame, column: str, out: str, block_len: int = BLOCK_LEN) -> DataFrame:
    """Add ``out``: the sum of ``column`` over all rows of the series up to this t.

    A scan inside each block, and one over a summary row per block.
    """
    scanned = split_blocks(rows, block_len=block_len).drop("own").withColumn("_in", F.sum(column).over(in_order()))
    ends = scanned.groupBy(*BLOCK_KEY).agg(F.max_by("_in", "t").alias("_end"))
    base = ends.select(*BLOCK_KEY, F.coalesce(F.sum("_end").over(earlier_blocks()), F.lit(0.0)).alias("_base"))
    return scanned.join(base, BLOCK_KEY).withColumn(out, F.col("_in") + F.col("_base")).drop("_in", "_base", "block")


def to_blocks(
    points: DataFrame, before: int | Column = 0, after: int | Column = 0, block_len: int = BLOCK_LEN
) -> DataFrame:
    """Points to blocks: one shuffle on (series, channel, block), bounded groups."""
    rows = split_blocks(points, before, after, block_len)
    packed = rows.groupBy(*BLOCK_KEY).agg(
        F.sort_array(F.collect_list(F.struct("t", "v"))).alias("tv"),
        F.max("own").alias("owned"),
    )
    return packed.filter("owned").select(
        *BLOCK_KEY, F.col("tv")[0]["t"].alias("lo"), F.col("tv.v").alias("values")
    )


def arrays_to_points(arrays: DataFrame) -> DataFrame:
    """SRC1: one row per sample (``series_id, values[, channel]``) to points."""
    channel = F.col("channel") if "channel" in arrays.columns else F.lit("0")
    return arrays.select(
        F.col("series_id").cast("string").alias("series_id"),
        channel.cast("string").alias("channel"),
        F.posexplode("values").alias("t", "v"),
    ).select(*KEY, F.col("t").cast("bigint").alias("t"), clean_value(F.col("v")).alias("v"))


def arrays_to_blocks(
    arrays: DataFrame, before: int = 0, after: int = 0, block_len: int = BLOCK_LEN
) -> DataFrame:
    """Whole-sample arrays to blocks by slicing in place: no shuffle at all."""
    channel = F.col("channel") if "channel" in arrays.columns else F.lit("0")
    size = F.size("values")
    lo = F.greatest(F.col("block") * block_len - before, F.lit(0))
    return (
        arrays.filter(size > 0)
        .select(
            F.col("series_id").cast("string").alias("series_id"),
            channel.cast("string").alias("channel"),
            F.explode(F.sequence(F.lit(0), F.floor((size - 1) / block_len))).alias("block"),
            F.transform("values", clean_value).alias("whole"),
        )
        .select(
            *BLOCK_KEY,
            lo.cast("bigint").alias("lo"),
            F.slice(
                "whole",
                (lo + 1).cast("int"),
                ((F.col("block") + 1) * block_len + after - lo).cast("int"),
            ).alias("values"),
        )
    )


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder the session names."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``, which all machines must see.

    Only a session of one machine (a ``local`` master) that does not set it gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _LOCAL.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="seriesprep-")
        _LOCAL[context.applicationId] = folder
    return folder.rstrip("/")


_LOCAL: dict[str, str] = {}


def longest_series(points: DataFrame, known: int | None = None) -> int:
    """Upper bound on the series length: ``known`` if given, else one scan of one column.

    Operators take it as ``longest``.  When every series fits one block they leave
    out the steps that connect blocks; the result is the same either way.  ``within``
    makes a bound that is too small an error.
    """
    if known is not None:
        return known
    last = points.agg(F.max("t")).first()[0]
    return 0 if last is None else last + 1


def within(points: DataFrame, longest: int | None) -> DataFrame:
    """The same points; the job fails if one lies at or beyond a length the caller gave as bound."""
    if longest is None:
        return points
    beyond = F.raise_error(F.concat(F.lit(f"a series is longer than longest={longest}: t = "), F.col("t").cast("string")))
    return points.withColumn("t", F.when(F.col("t") < longest, F.col("t")).otherwise(beyond.cast("bigint")))


def merge_block_arrays(parts: DataFrame, column: str, block_len: int = BLOCK_LEN) -> DataFrame:
    """Element-wise sum of one array per block into one array per series.

    ``parts`` has KEY, ``n``, ``block`` and the array.  Rows of series with a
    single block pass through untouched; the arrays of longer series are summed
    element by element with map-side partials and reassembled.
    """
    keep = [*KEY, "n"]
    whole = parts.filter(F.col("n") <= block_len).select(*keep, column)
    cells = (
        parts.filter(F.col("n") > block_len)
        .select(*keep, F.posexplode(column).alias("pos", "x"))
        .groupBy(*keep, "pos")
        .agg(F.sum("x").alias("x"))
    )
    summed = (
        cells.groupBy(*keep)
        .agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("px"))
        .select(*keep, F.col("px.x").alias(column))
    )
    return whole.unionByName(summed)
