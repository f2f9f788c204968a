"""Sources and row preparation (SRC1-SRC10)."""

from pyspark.sql import functions as F

from seriesprep.layout import KEY, arrays_to_blocks, arrays_to_points
from seriesprep.sources import tables

from . import base
from .base import CHANNELS, DAILY, VECTORS, WEEKLY, pts, query, rounded, scratch_dir, sql, table


@query("src1_tensor_to_points", sql([VECTORS], "FROM vectors", ["v"], ["t"]))
def src1(spark, d):
    return rounded(arrays_to_points(base.vectors(spark, d)))


@query("src1_tensor_to_blocks", sql([VECTORS], "SELECT *, t // 16 AS block FROM vectors", ["v"], ["t", "block"]))
def src1_blocks(spark, d):
    rows = arrays_to_blocks(base.vectors(spark, d), block_len=16)
    rows = rows.select(*KEY, "block", "lo", F.posexplode("values").alias("i", "v"))
    return rounded(rows.select(*KEY, "block", (F.col("lo") + F.col("i")).alias("t"), "v"))


@query(
    "src2_npy_tensor",
    """SELECT i - 1 AS t, count(*) AS n, round(sum(CAST(embedding[i] AS DOUBLE)), 4) + 0.0 AS v FROM embeddings, range(1, 65) r(i) GROUP BY ALL""",
)
def src2(spark, d):
    from seriesprep.sources.npy import NpyTensorSource, write_tensor_parts

    path = scratch_dir(spark, "tensor")
    write_tensor_parts(base.vectors(spark, d), path)
    spark.dataSource.register(NpyTensorSource)
    points = arrays_to_points(spark.read.format("npy_tensor").load(path))
    return rounded(points.groupBy("t").agg(F.count("*").alias("n"), F.sum("v").alias("v")), 4)


# The first value of a sample stands for its number, which the store does not keep.
@query("src2_npy_any_store", "SELECT round(CAST(embedding[1] AS DOUBLE), 6) + 0.0 AS head, i - 1 AS t, round(CAST(embedding[i] AS DOUBLE), 6) + 0.0 AS v FROM embeddings, range(1, 65) r(i)")
def src2_any_store(spark, d):
    from seriesprep.sources.npy import read_tensor, write_tensor_parts

    path = scratch_dir(spark, "tensor")
    write_tensor_parts(base.vectors(spark, d), path)
    rows = read_tensor(spark, path, whole_bytes=1 << 20)
    return rounded(rows.select(F.get("values", F.lit(0)).alias("head"), F.posexplode("values").alias("t", "v")))


@query("src3_length_range", "SELECT min(len(embedding)) AS min_length, max(len(embedding)) AS max_length FROM embeddings")
def src3(spark, d):
    return tables.length_range(base.vectors(spark, d))


def _write_csv(frame, path):
    """One CSV directory per layout check; every series is one file."""
    frame.write.option("header", True).csv(path)


@query("src4_dated_csv", sql([DAILY], "SELECT series_id AS channel, t, v FROM daily", ["v"], ["t"], 2, key=("channel",)))
def src4(spark, d):
    path = scratch_dir(spark, "dated")
    rows = base.daily(spark, d).repartition(5, "series_id").sortWithinPartitions("series_id", "t")
    _write_csv(rows.select(F.col("t").alias("date"), F.col("v").alias("data"), F.col("series_id").alias("cols")), path)
    points = tables.read_long_csv(spark, path)
    return rounded(points.select("channel", "t", "v"), 2)


@query("src4_undated_csv_positions", sql([DAILY], "SELECT series_id AS channel, t, v FROM daily", ["v"], ["t"], 2, key=("channel",)))
def src4_undated(spark, d):
    path = scratch_dir(spark, "undated")
    rows = base.daily(spark, d).repartition(5, "series_id").sortWithinPartitions("series_id", "t")
    _write_csv(rows.select(F.col("v").alias("data"), F.col("series_id").alias("cols")), path)
    return rounded(tables.read_long_csv(spark, path).select("channel", "t", "v"), 2)


@query("src5_channel_lengths", sql([CHANNELS], "SELECT *, min(n) OVER (PARTITION BY series_id) = max(n) OVER (PARTITION BY series_id) AS equal_lengths FROM (SELECT series_id, channel, count(*) AS n FROM channels GROUP BY ALL)", [], ["n", "equal_lengths"]))
def src5(spark, d):
    return tables.channel_lengths(base.channels(spark, d))


@query("src6_drop_labels", sql([CHANNELS], "SELECT series_id, channel, count(*) AS n FROM channels WHERE CAST(channel AS INT) % 7 <> 3 GROUP BY ALL", [], ["n"]))
def src6(spark, d):
    marked = base.channels(spark, d).withColumn("channel", F.when(F.col("channel").cast("int") % 7 == 3, "label").otherwise(F.col("channel")))
    return tables.drop_labels(marked).groupBy(*KEY).agg(F.count("*").alias("n"))


@query("src7_cap_rows", sql([WEEKLY], "SELECT * FROM weekly WHERE t < 120", ["v"], ["t"]))
def src7(spark, d):
    return rounded(tables.cap_rows(base.weekly(spark, d), 120))


@query(
    "src8_directory_scan",
    sql([DAILY], "SELECT series_id AS channel, v FROM daily", ["v"], (), 2, key=("channel",)),
)
def src8(spark, d):
    path = scratch_dir(spark, "directory")
    rows = base.daily(spark, d).repartition(5, "series_id")
    _write_csv(rows.select(F.col("t").alias("date"), F.col("v").alias("data"), F.col("series_id").alias("cols")), path)
    points = tables.read_long_csv(spark, path)
    return rounded(points.select("channel", "v"), 2)


@query("src9_stored_report", sql([WEEKLY], "SELECT series_id, channel, avg(v) AS mean, var_samp(v) AS var FROM weekly GROUP BY ALL", ["mean", "var"], (), 2))
def src9(spark, d):
    from seriesprep.operators import stats

    path = scratch_dir(spark, "report")
    stats.point_features(base.weekly(spark, d), ["mean", "var"]).write.parquet(path)
    return rounded(tables.read_report(spark, path), 2)


@query("src10_drop_missing", sql([WEEKLY], "SELECT series_id, channel, row_number() OVER (PARTITION BY series_id, channel ORDER BY t) - 1 AS t, v FROM weekly WHERE v <> 0", ["v"], ["t"]))
def src10(spark, d):
    holes = base.weekly(spark, d).withColumn("v", F.when(F.col("v") != 0, F.col("v")))
    return rounded(tables.drop_missing(holes))


@query(
    "timestamps_to_positions",
    """SELECT CAST(user_id AS VARCHAR) AS series_id, row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 AS t, round(value, 4) + 0.0 AS v FROM events""",
)
def timestamps(spark, d):
    events = table(spark, d, "events")
    points = tables.points_from_rows(events, F.col("user_id"), F.col("ts"), F.col("value"))
    return rounded(points.select("series_id", "t", "v"), 4)
