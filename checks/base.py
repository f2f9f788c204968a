"""Series built from the given tables, once for Spark and once as SQL, and the
registry of checked queries."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesprep.layout import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Modules that register queries, in the order of the operator inventory.
MODULES = ["repair_checks", "stats_checks", "spectrum_checks", "divergence_checks", "decompose_checks", "autocorr_checks", "symbolic_checks", "library_checks", "source_checks", "pipeline_checks"]


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, its oracle."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder the session names, for written tables."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles, drop the sign of zero, widen integers: comparable rows."""
    cols = []
    for f in df.schema:
        kind = f.dataType.typeName()
        c = F.col(f"`{f.name}`")
        if kind == "double":
            c = F.round(c, digits) + F.lit(0.0)
        elif kind in ("integer", "short", "byte"):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ------------------------------------------------------------------ fixtures
WEEKS, HOURS, DAYS = 357, 720, 2405
GRID_POINTS = 500_000  # of the zero grid, per task


def spread(ids: DataFrame, length: int) -> DataFrame:
    """The same ids over as many tasks as their grid of ``length`` points each needs; a small file is one task else."""
    return ids.repartition(max(1, -(-ids.count() * length // GRID_POINTS)))


def _filled(rows: DataFrame, ids: DataFrame, length: int) -> DataFrame:
    """Sum of ``v`` per (series_id, t) with zeros for the missing positions."""
    grid = ids.select("series_id", F.explode(F.sequence(F.lit(0), F.lit(length - 1))).alias("t"))
    zeros = grid.select("series_id", F.col("t").cast("bigint").alias("t"), F.lit(0.0).alias("v"))
    return (
        rows.select("series_id", "t", "v")
        .unionByName(zeros)
        .groupBy("series_id", "t")
        .agg(F.round(F.sum("v"), 2).alias("v"))
        .select("series_id", F.lit("0").alias("channel"), "t", "v")
    )


def weekly(spark, sf_dir) -> DataFrame:
    """Revenue per supplier and week."""
    ids = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("series_id"))
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-02").cast("date"))
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("series_id"),
        F.floor(day / 7).alias("t"),
        F.col("l_extendedprice").alias("v"),
    )
    return _filled(rows, spread(ids, WEEKS), WEEKS)


def hourly(spark, sf_dir) -> DataFrame:
    """Sum of event values per event type and hour."""
    events = table(spark, sf_dir, "events")
    ids = events.select(F.col("event_type").alias("series_id")).distinct()
    hour = F.expr("timestampdiff(HOUR, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)")
    rows = events.select(F.col("event_type").alias("series_id"), hour.alias("t"), F.col("value").alias("v"))
    return _filled(rows, ids, HOURS)


def daily(spark, sf_dir) -> DataFrame:
    """Order value per priority and day."""
    orders = table(spark, sf_dir, "orders")
    ids = orders.select(F.col("o_orderpriority").alias("series_id")).distinct()
    day = F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")).cast("bigint")
    rows = orders.select(
        F.col("o_orderpriority").alias("series_id"), day.alias("t"), F.col("o_totalprice").alias("v")
    )
    return _filled(rows, ids, DAYS)


def vectors(spark, sf_dir) -> DataFrame:
    """Embeddings as samples in array form."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("series_id"), F.col("embedding").alias("values")
    )


def channels(spark, sf_dir) -> DataFrame:
    """Weekly revenue grouped by nation: one channel per supplier."""
    nation = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("channel"),
        F.col("s_nationkey").cast("string").alias("nation"),
    )
    points = weekly(spark, sf_dir).select(F.col("series_id").alias("channel"), "t", "v")
    return points.join(nation, "channel").select(F.col("nation").alias("series_id"), "channel", "t", "v")


WEEKLY = """weekly AS (
  SELECT CAST(k AS VARCHAR) AS series_id, '0' AS channel, t, round(sum(x), 2) AS v FROM (
    SELECT s_suppkey AS k, t, 0.0::DOUBLE AS x FROM supplier, range(357) r(t)
    UNION ALL
    SELECT l_suppkey, date_diff('day', DATE '1995-01-02', CAST(l_shipdate AS DATE)) // 7, l_extendedprice FROM lineitem
  ) GROUP BY k, t)"""
HOURLY = """hourly AS (
  SELECT k AS series_id, '0' AS channel, t, round(sum(x), 2) AS v FROM (
    SELECT DISTINCT event_type AS k, t, 0.0::DOUBLE AS x FROM events, range(720) r(t)
    UNION ALL
    SELECT event_type, date_diff('hour', TIMESTAMP '2024-01-01', ts), value FROM events
  ) GROUP BY k, t)"""
DAILY = """daily AS (
  SELECT k AS series_id, '0' AS channel, t, round(sum(x), 2) AS v FROM (
    SELECT DISTINCT o_orderpriority AS k, t, 0.0::DOUBLE AS x FROM orders, range(2405) r(t)
    UNION ALL
    SELECT o_orderpriority, date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)), o_totalprice FROM orders
  ) GROUP BY k, t)"""
VECTORS = """vectors AS (
  SELECT CAST(vec_id AS VARCHAR) AS series_id, '0' AS channel, i - 1 AS t, CAST(embedding[i] AS DOUBLE) AS v
  FROM embeddings, range(1, 65) r(i))"""
CHANNELS = WEEKLY + """, channels AS (
  SELECT CAST(s_nationkey AS VARCHAR) AS series_id, w.series_id AS channel, t, v
  FROM weekly w JOIN supplier ON CAST(s_suppkey AS VARCHAR) = w.series_id)"""


def sql(ctes: list[str], body: str, doubles=(), others=(), digits: int = 6, key=("series_id", "channel")) -> str:
    """WITH ctes, the body, and the rounding that ``rounded`` does on the Spark side."""
    cols = [*key, *others, *[f"round({c}, {digits}) + 0.0 AS {c}" for c in doubles]]
    head = "WITH " + ",\n".join(ctes) if ctes else ""
    return f"{head}\nSELECT {', '.join(cols)} FROM (\n{body}\n) q"


STATS = """stats AS (
  SELECT series_id, channel, count(*) AS n, avg(v) AS mean, stddev_samp(v) AS sd, stddev_pop(v) AS sd_pop,
         min(v) AS vmin, max(v) AS vmax, median(v) AS med
  FROM pts GROUP BY ALL)"""


def pts(fixture: str) -> str:
    return f"pts AS (SELECT * FROM {fixture})"


def regression(name, columns, rows):
    """Residuals of y on a constant and the columns, one column at a time (Gram-Schmidt): ``{name}_fit`` with ``step``.

    A column without any variance, or fully explained by those before it, takes nothing away.
    """
    keys = "series_id, channel, t"
    whole = "OVER (PARTITION BY series_id, channel)"
    complete = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    centred = ", ".join(f"{c} - avg({c}) {whole} AS {c}" for c in ["y", *columns])
    ctes = [f"{name}_0 AS MATERIALIZED (SELECT {keys}, {centred} FROM ({rows}) WHERE {complete})"]
    for i, q in enumerate(columns):
        left = ", ".join(f"{c} - coalesce({q} * (sum({c} * {q}) {whole}) / nullif(sum({q} * {q}) {whole}, 0), 0) AS {c}" for c in ["y", *columns[i + 1 :]])
        ctes.append(f"{name}_{i + 1} AS MATERIALIZED (SELECT {keys}, {left} FROM {name}_{i})")
    steps = " UNION ALL ".join(f"SELECT series_id, channel, y, {i} AS step FROM {name}_{i}" for i in range(len(columns) + 1))
    return [*ctes, f"{name}_fit AS ({steps})"]
