"""Set-level columns at the channels of hot sets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesprep.operators import channels


def hot(spark, n=4000):
    """One set holds 99% of the channels."""
    rng = np.random.default_rng(5)
    rows = [("hot", str(i), *map(float, rng.normal(size=3))) for i in range(n)]
    rows += [(f"s{i % 5}", str(i), *map(float, rng.normal(size=3))) for i in range(n // 100)]
    rows += [("one", None, 1.0, 2.0, None)]
    return spark.createDataFrame(rows, "series_id string, channel string, a double, b double, c double").repartition(6)


def test_scaled_features_of_a_hot_set(spark):
    frame = hot(spark)
    got = channels.scale_features(frame, ["a", "b", "c"]).toPandas()
    want = frame.toPandas()
    for c in "abc":
        by = want.groupby("series_id")[c]
        lo, hi = by.transform("min"), by.transform("max")
        want[c] = ((want[c] - lo) / (hi - lo)).where(hi != lo, 0.0).where(want[c].notna())
    order = ["series_id", "channel"]
    got, want = (x.sort_values(order, na_position="last").reset_index(drop=True) for x in (got, want))
    assert got.columns.tolist() == [*order, "a", "b", "c"]
    assert got[order].equals(want[order]) and np.allclose(got[["a", "b", "c"]], want[["a", "b", "c"]], equal_nan=True)


@pytest.mark.parametrize("shares", [1, 7, channels.SHARES])
def test_any_number_of_shares_gives_the_same_rows(spark, shares):
    frame = hot(spark, 700)
    sets = frame.groupBy("series_id").agg(F.count("*").alias("size")).filter("series_id <> 's3'")
    got = channels.attach_to_channels(frame, sets, shares)
    want = frame.join(sets, "series_id")
    assert got.columns == [*frame.columns, "size"]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))


def test_the_join_of_channels_spreads_a_hot_set(spark):
    frame = hot(spark)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as on tables too large to broadcast
    try:
        plan = channels.scale_features(frame, ["a"])._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 2 and sum("_share" in line for line in joins) == 1
    per_task = frame.groupBy("series_id", F.pmod(F.xxhash64("channel"), F.lit(channels.SHARES))).count().agg(F.max("count")).first()[0]
    assert per_task <= 20  # of 4000
