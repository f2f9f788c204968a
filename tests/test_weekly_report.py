"""The queries on the weekly short report make their points once and read them where they lie."""

import datetime

import numpy as np
import pytest

from checks import base, pipeline_checks
from seriesprep.layout import KEY

QUERIES = ["rep2_rep3_rep4_short_report", "f1_quality_screen", "j2_j3_snk3_cleaned_survivors", "f7_reject_reasons"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Suppliers with few and many items, one without any, one that comes twice."""
    d, rng = str(tmp_path_factory.mktemp("weekly")), np.random.default_rng(5)
    spark.createDataFrame([(k,) for k in (1, 2, 3, 4, 5, 5)], "s_suppkey bigint").write.parquet(f"{d}/supplier.parquet")
    day = datetime.date(1995, 1, 2)
    rows = [(k, day + datetime.timedelta(days=int(rng.integers(0, 357 * 7))), float(np.round(rng.gamma(2, 900), 2))) for k, n in ((1, 900), (2, 900), (3, 40), (5, 400)) for _ in range(n)]
    spark.createDataFrame(rows, "l_suppkey bigint, l_shipdate date, l_extendedprice double").repartition(3).write.parquet(f"{d}/lineitem.parquet")
    return d


@pytest.mark.parametrize("name", QUERIES)
def test_points_are_made_once(spark, tables, monkeypatch, name):
    seen, real = [], pipeline_checks.sql_report
    monkeypatch.setattr(pipeline_checks, "sql_report", lambda points, d=None: seen.append(points) or real(points, d))
    rows = base.QUERIES[name](spark, tables)
    assert rows.count() > 0
    (points,) = seen
    plan = points.groupBy(*KEY, "t").max("v")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "/lineitem.parquet" not in plan
    assert "/lineitem.parquet" not in rows._jdf.queryExecution().executedPlan().toString()


def test_same_report_wherever_the_points_lie(spark, tables):
    rows = lambda points: [tuple(r) for r in base.rounded(pipeline_checks.sql_report(points)).orderBy(*KEY).collect()]
    placed = rows(pipeline_checks.placed_weekly(spark, tables))
    assert placed == rows(base.weekly(spark, tables)) and [r[0] for r in placed] == ["1", "2", "3", "4", "5"]
