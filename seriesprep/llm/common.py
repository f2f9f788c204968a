"""Helpers shared by the corpus operators: staging, bounded broadcasts, registry."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesprep.layout import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# A word as the contracts define it: a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
# The same white space as a set for Python's split.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"

# A hand-made broadcast is allowed up to this many rows of a few numbers each.
BROADCAST_ROWS = 400_000

BATCH_BYTES = 4_000_000


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, its oracle."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a job that is run in here go when it ends; else they stay until the driver happens to collect garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with shuffles_freed(df.sparkSession):
        df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Remove the files of a staged table that nothing reads any more."""
    spark = df.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file)
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Mark a staged table for broadcast if it is provably small, else leave the join to Spark."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def marked(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Add ``found``: is the number ``column`` among the single column of ``ids``?  A null is not.

    64 neighbouring numbers are one row of the side that may be broadcast, so the rows stay where they are
    as long as the numbers lie close, like ids, places and keys do.
    """
    n = ids.columns[0]
    words = ids.filter(F.col(n).isNotNull()).groupBy(F.shiftright(n, 6).alias("_word"))
    words = stage(words.agg(F.expr(f"bit_or(shiftleft(1L, CAST(`{n}` & 63 AS INT)))").alias("_bits")), "marks")
    beside = rows.withColumn("_word", F.shiftright(column, 6)).join(small(words), "_word", "left")
    bit = F.expr(f"shiftright(_bits, CAST(`{column}` & 63 AS INT)) & 1 = 1")
    return beside.withColumn("found", F.coalesce(bit, F.lit(False))).drop("_word", "_bits")


def light_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of this session hold BATCH_BYTES at most: Spark's 64 MB are held once by the JVM and once by Python, per task."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def give_back() -> None:
    """At the end of a task: return freed memory to the machine, as the worker serves later tasks and stages too."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def crc_remainder(column: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id written as text, modulo the number of folds."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(folds))
