"""One arrangement of the points that every step of a plan reads.

Series of at most one block are stored hash-partitioned by (series, channel) in a bucketed table.  Every
operator groups, orders and joins by keys that contain these, so it runs on that table without moving
points again; a partition is bounded, as no such series is longer than a block.  Longer series stay points of
their own, which the block-wise operators spread over (series, channel, block).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .layout import BLOCK_LEN, KEY, attach, shared_folder, split_blocks, within

BUCKET_POINTS = 1_000_000
MOST_BUCKETS = 100_000  # Spark's own limit


@dataclass(frozen=True)
class Part:
    """Points of some series; ``placed`` says that they lie by series, ``longest`` bounds their length."""

    points: DataFrame
    longest: int
    placed: bool


def buckets_for(spark: SparkSession, points: int) -> int:
    """Buckets of about BUCKET_POINTS; small inputs still use all cores."""
    by_size = -(-points // BUCKET_POINTS)
    spread = min(spark.sparkContext.defaultParallelism, -(-points // 2_000))
    return max(1, min(max(by_size, spread), MOST_BUCKETS))


def stored(points: DataFrame, buckets: int, keys: list[str], folder: str) -> DataFrame:
    """Write points bucketed by ``keys``, one file per bucket, and read them back in that partitioning.

    The catalog entry is needed only until the table is resolved; the files stay in the shared folder.
    """
    spark = points.sparkSession
    name = f"seriesprep_points_{uuid.uuid4().hex}"
    writer = points.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys, "t")
    writer.option("path", f"{folder}/{name}").saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def arrange(points: DataFrame, longest: int | None = None, block_len: int = BLOCK_LEN) -> list[Part]:
    """Store the complete series for a plan: one shuffle of the points, two more where some series are long.

    Series of at most ``block_len`` points and longer ones are parts of their own.  Series with missing
    observations are left out, see ``report.rejects``.
    """
    spark = points.sparkSession
    points = within(points.select(*KEY, "t", "v"), longest)
    facts = points.agg(F.count(F.lit(1)).alias("n"), F.max("t").alias("last"), F.count("v").alias("present")).first()
    found = 0 if facts["last"] is None else facts["last"] + 1
    buckets = buckets_for(spark, facts["n"])
    folder = shared_folder(spark)
    if found <= block_len:
        short = stored(points, buckets, KEY, folder)
        return [Part(_complete(short) if facts["present"] < facts["n"] else short, found, True)]
    sizes = points.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("present"))
    # joined per block: the series are still of any length here
    sized = attach(split_blocks(points, block_len=block_len), sizes, block_len).filter("present = n")
    path = f"{folder}/sized-{uuid.uuid4().hex}"
    sized.select(*KEY, "t", "v", (F.col("n") > block_len).alias("long")).write.partitionBy("long").parquet(path)
    staged = spark.read.schema("series_id string, channel string, t bigint, v double, long boolean").parquet(path)
    short = stored(staged.filter("NOT long").drop("long"), buckets, KEY, folder)
    return [Part(short, block_len, True), Part(staged.filter("long").drop("long"), found, False)]


@contextmanager
def co_located(spark: SparkSession) -> Iterator[None]:
    """While this lasts, a join by (series, channel, block) leaves a side that lies by (series, channel) in place.

    Without it Spark moves both sides as soon as the other one has to move.
    """
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def _complete(short: DataFrame) -> DataFrame:
    """The series without a missing point; grouped and joined where they lie."""
    whole = short.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("present")).filter("present = n")
    return short.join(whole.select(*KEY), KEY, "left_semi")
