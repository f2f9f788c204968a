"""The groups scored on one row per series: one pass over the points, and the block-wise operators' columns."""

import re

import numpy as np
from helpers import assert_same, points, some_series
from pyspark.sql import functions as F

from seriesprep import arrange
from seriesprep.layout import KEY
from seriesprep.operators import whole
from seriesprep.plans import features


def odd_series():
    rng = np.random.default_rng(5)
    made = {k: v[:130] for k, v in some_series().items()}
    made |= {f"n{n}": np.round(rng.normal(1, 2, n), 2) for n in (1, 2, 3, 5, 11, 14, 21)}
    return made | {"flat": [0.1] * 37, "zero": [0.0] * 40, "steps": np.round(rng.random(60) * 2), "line": np.arange(50.0)}


def test_the_one_row_groups_share_one_pass_and_agree(spark):
    rows = points(spark, odd_series())
    again = rows.filter("series_id IN ('noise', 'zeros')").withColumn("series_id", F.concat("series_id", F.lit("-twice")))
    (part,) = arrange.arrange(rows.unionByName(again).unionByName(again))
    groups = sorted(whole.COVERED)
    with arrange.co_located(spark):
        got = features.computed(part.points, groups, part.longest, part.placed)
        assert len(got) == 1
        plan = got[0]._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall("FileScan", plan)) == 1 and not re.search("Exchange|Join", plan)
        expected = part.points.select(*KEY).distinct()
        for columns in features.computed(part.points, groups, part.longest):
            expected = expected.join(columns, KEY, "left")
        assert_same(expected.select(*got[0].columns), got[0])
        assert dict(expected.dtypes) == dict(got[0].dtypes)


def test_longer_series_keep_the_block_wise_forms(spark):
    rows = points(spark, {"a": np.arange(30.0) % 7})
    assert len(features.computed(rows, ["arch", "modes"], 200_000, True)) == 2
    assert len(features.computed(rows, ["arch", "modes"], 30, False)) == 2
    assert len(features.computed(rows, ["arch", "modes", "inversions"], 30, True)) == 2
