"""One arrangement of the points for a whole plan: same rows, and no further shuffle of the points."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesprep import arrange
from seriesprep.layout import KEY
from seriesprep.operators import autocorr, spectrum
from seriesprep.plans import features, pipeline, report

# Groups that take no shuffle at all once the points lie by series.
IN_PLACE = (
    "pointwise inversions modes acf_points lag2_information stretches gaussian_information motif fluctuation shifts "
    "acf_pacf entropy flat_spots tiles walker box_cox"
).split()


def series(spark, lengths, gap=()):
    rng = np.random.default_rng(3)
    rows = []
    for i, n in enumerate(lengths):
        v = np.sin(np.arange(n) * 2 * np.pi / 12) + 0.3 * rng.standard_normal(n) + 5
        rows += [(f"s{i % 4}", f"c{i}", t, None if i in gap and t == 3 else float(x)) for t, x in enumerate(v)]
    return spark.createDataFrame(rows, "series_id string, channel string, t bigint, v double").repartition(5)


def table(df):
    rows = df.orderBy(*KEY).collect()
    return [r[:2] for r in rows], np.array([[np.nan if x is None else float(x) for x in r[2:]] for r in rows])


def moves(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange (?:hash|range|RoundRobin)", plan))


def test_parts_hold_the_complete_series_once(spark):
    points = series(spark, [60, 130, 61, 40, 250], gap=(2,)).withColumn("extra", F.lit(1))
    short, long = arrange.arrange(points, block_len=100)
    assert (short.placed, short.longest, long.placed, long.longest) == (True, 100, False, 250)
    count = lambda p: {(r["channel"], r["n"]) for r in p.points.groupBy("channel").agg(F.count("*").alias("n")).collect()}
    assert count(short) == {("c0", 60), ("c3", 40)} and count(long) == {("c1", 130), ("c4", 250)}
    (only,) = arrange.arrange(points)
    assert count(only) == {("c0", 60), ("c1", 130), ("c3", 40), ("c4", 250)}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("seriesprep_points")]
    (none,) = arrange.arrange(points.limit(0))
    assert none.points.count() == 0 and none.longest == 0
    with pytest.raises(Exception, match="longer than longest"):
        arrange.arrange(points, longest=100)


def test_the_profile_moves_the_points_once(spark):
    points = series(spark, [80, 90, 70])
    (part,) = arrange.arrange(points)
    shared = {"sums": autocorr.lag_sums, "spectra": spectrum.spectrum, "bins": spectrum.long_bins}
    found = {}
    with arrange.co_located(spark):
        for name, (_, build) in features.GROUPS.items():
            found[name] = moves(build(part.points, lambda s: shared[s](part.points, longest=part.longest), part.longest))
        found["core"] = moves(report.core_report(part.points, longest=part.longest, placed=True))
    assert {g: found[g] for g in [*IN_PLACE, "core"]} == dict.fromkeys([*IN_PLACE, "core"], 0)
    # What is left follows Python steps, whose rows Spark no longer knows to be in place.
    assert sum(found.values()) < 50


def test_profile_of_short_and_long_series_equals_the_groups_on_raw_points(spark, monkeypatch):
    points = series(spark, [60, 130, 61, 40], gap=(2,))
    wanted = ["tiles", "shifts", "inversions", "acf_points", "flat_spots"]
    whole = pipeline.profile(points, wanted)
    split = arrange.arrange
    monkeypatch.setattr(pipeline, "arrange", lambda p, longest=None: split(p, longest, block_len=100))
    parts = pipeline.profile(points, wanted)
    assert parts.columns == whole.columns
    keys, rows = table(whole.drop("stability"))
    other_keys, others = table(parts.drop("stability"))
    assert keys == other_keys and len(keys) == 3
    np.testing.assert_allclose(rows, others, rtol=1e-9, atol=1e-12)
    complete = points.filter("channel <> 'c2'")
    for group in wanted:
        columns, build = features.GROUPS[group]
        raw = build(complete, lambda _: autocorr.lag_sums(complete), 130)
        assert table(raw.select(*KEY, *columns))[0] == keys
        np.testing.assert_allclose(table(whole.select(*KEY, *columns))[1], table(raw.select(*KEY, *columns))[1], rtol=1e-9, atol=1e-12)


def test_settings_are_restored(spark):
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name, None)
    with pytest.raises(KeyError), arrange.co_located(spark):
        assert spark.conf.get(name) == "false"
        raise KeyError
    assert spark.conf.get(name, None) == before
