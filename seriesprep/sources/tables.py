"""Readers and row-level preparation of points (SRC1, SRC3-SRC10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..layout import BLOCK_KEY, BLOCK_LEN, KEY, clean_value, earlier_blocks, in_order, split_blocks

_TEXT = StringType()
DATED = StructType([StructField("date", _TEXT), StructField("data", DoubleType()), StructField("cols", _TEXT)])
UNDATED = StructType([StructField("data", DoubleType()), StructField("cols", _TEXT)])


def read_arrays(spark: SparkSession, path: str, id_column: str, value_column: str) -> DataFrame:
    """Parquet samples in array form: only the two columns are read."""
    return spark.read.parquet(path).select(
        F.col(id_column).cast("string").alias("series_id"), F.col(value_column).alias("values")
    )


def length_range(arrays: DataFrame) -> DataFrame:
    """SRC3: shortest and longest sample."""
    n = F.size("values").cast("bigint")
    return arrays.agg(F.min(n).alias("min_length"), F.max(n).alias("max_length"))


def read_long_csv(spark: SparkSession, path: str, dated: bool | None = None) -> DataFrame:
    """SRC4 and SRC8: a CSV file, or the CSV files of a directory (not its subdirectories).

    Four layouts: with or without a leading ``date`` column, one or many channels
    stacked in ``cols``.  The layout follows the header of each file unless given.  One file is
    one series named after it; t is the position inside the channel in file order.
    """
    if dated is None:
        plain, with_date = csv_layouts(spark, path)
        both = [_long_csv(spark, files, kind) for files, kind in ((plain, UNDATED), (with_date, DATED)) if files]
        if not both:
            return _long_csv(spark, path, UNDATED).limit(0)
        return both[0] if len(both) == 1 else both[0].unionByName(both[1])
    return _long_csv(spark, path, DATED if dated else UNDATED)


CSV_FILES = "*.[cC][sS][vV]"


def csv_layouts(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """The files without and with a leading ``date`` column, by the first line of each.

    The driver gets one path per file, as it does whenever Spark lists a folder.
    """
    lines = spark.read.option("pathGlobFilter", CSV_FILES).text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("line"), "value")
    first = lines.filter("part = 0").groupBy("file").agg(F.min_by("value", "line").alias("head"))
    leading = F.trim(F.regexp_replace(F.split("head", ",")[0], '["\ufeff]', ""))
    found = first.select("file", (leading == "date").alias("dated")).orderBy("file").collect()
    return [r["file"] for r in found if not r["dated"]], [r["file"] for r in found if r["dated"]]


def _long_csv(spark: SparkSession, files: str | list[str], kind: StructType) -> DataFrame:
    raw = spark.read.schema(kind).option("header", True).option("enforceSchema", True).option("pathGlobFilter", CSV_FILES).csv(files)
    name = F.regexp_replace("_metadata.file_name", r"\.[cC][sS][vV]$", "")
    rows = raw.select(
        name.alias("series_id"),
        F.coalesce("cols", F.lit("0")).alias("channel"),
        F.col("_metadata.file_block_start").alias("part"),
        F.monotonically_increasing_id().alias("line"),
        clean_value(F.col("data")).alias("v"),
    )
    return position_in_channel(rows, "part", "line")


def position_in_channel(rows: DataFrame, part: str, *line: str) -> DataFrame:
    """t from the order (part, line): counted inside a file part, offset by the earlier parts."""
    key = [*KEY, part]
    before = Window.partitionBy(*KEY).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*key)
        .agg(F.count("*").alias("_c"))
        .select(*key, F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_base"))
    )
    inside = F.row_number().over(Window.partitionBy(*key).orderBy(*line)) - 1
    return (
        rows.withColumn("_i", inside)
        .join(offsets, key)
        .select(*KEY, (F.col("_base") + F.col("_i")).cast("bigint").alias("t"), "v")
    )


def points_from_rows(
    rows: DataFrame, series: Column, time: Column, value: Column, channel: Column | None = None
) -> DataFrame:
    """User rows with any orderable time (timestamp or number): t is the rank in time.

    Whole numbers and timestamps keep their full precision; equal times are ordered by value.
    """
    channel = F.lit("0") if channel is None else channel
    kind = rows.select(time.alias("x")).schema["x"].dataType.typeName()
    if kind == "timestamp_ntz":
        time = time.cast("timestamp")
    if kind.startswith("timestamp"):
        time = F.unix_micros(time)
    whole = kind.startswith("timestamp") or kind in ("byte", "short", "integer", "long")
    time = time.cast("bigint") if whole else time
    base = rows.select(
        series.cast("string").alias("series_id"),
        channel.cast("string").alias("channel"),
        (time if whole else time.cast("double")).alias("at"),
        clean_value(value).alias("v"),
    )
    return ranked_by_time(base)


def ranked_by_time(rows: DataFrame) -> DataFrame:
    """Positions from the time order; every series is cut into time buckets first."""
    span = rows.groupBy(*KEY).agg(F.min("at").alias("_lo"), F.max("at").alias("_hi"), F.count("*").alias("n"))
    parts = F.ceil(F.col("n") / BLOCK_LEN).cast("bigint")
    wide = rows.withColumn("salt", F.pmod(F.xxhash64("at"), F.lit(16)))
    lookup = span.withColumn("parts", parts).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
    share = F.try_divide(F.col("at") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    part = F.least(F.coalesce(F.floor(share * F.col("parts")), F.lit(0)), F.col("parts") - 1)
    placed = wide.join(lookup, [*KEY, "salt"]).withColumn("part", part)
    return position_in_channel(placed, "part", "at", "v")


def channel_lengths(points: DataFrame) -> DataFrame:
    """SRC5: length per channel and whether all channels of the series agree."""
    rows = points.groupBy(*KEY).agg(F.count("*").alias("n"))
    range_ = rows.groupBy("series_id").agg((F.min("n") == F.max("n")).alias("equal_lengths"))
    return rows.join(range_, "series_id")


def drop_labels(points: DataFrame) -> DataFrame:
    """SRC6: remove the ground-truth channel."""
    return points.filter(F.col("channel") != "label")


def cap_rows(points: DataFrame, nrows: int | None) -> DataFrame:
    """SRC7: the first ``nrows`` observations of every series."""
    return points if nrows is None else points.filter(F.col("t") < nrows)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """SRC9: a stored feature report."""
    return spark.read.parquet(path)


def drop_missing(points: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """SRC10: remove missing observations and close up the positions."""
    rows = split_blocks(points.filter(F.col("v").isNotNull()), block_len=block_len)
    offsets = (
        rows.groupBy(*BLOCK_KEY)
        .agg(F.count("*").alias("_c"))
        .select(*BLOCK_KEY, F.coalesce(F.sum("_c").over(earlier_blocks()), F.lit(0)).alias("_base"))
    )
    return (
        rows.withColumn("_i", F.row_number().over(in_order()) - 1)
        .join(offsets, BLOCK_KEY)
        .select(*KEY, (F.col("_base") + F.col("_i")).cast("bigint").alias("t"), "v")
    )
