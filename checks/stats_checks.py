"""Aggregates (AGG1-AGG9, AGG11, AGG12, AGG17, W7, J5) and small library features."""

from pyspark.sql import functions as F

from seriesprep.layout import KEY
from seriesprep.operators import order, stats

from . import base
from .base import CHANNELS, HOURLY, STATS, WEEKLY, pts, query, rounded, sql

LAGS = """lags AS (
  SELECT p.*, n, mean, sd, med, lag(v) OVER w AS prev, lag(v, 2) OVER w AS prev2, lag(v, 3) OVER w AS prev3, lead(v) OVER w AS next
  FROM pts p JOIN stats USING (series_id, channel) WINDOW w AS (PARTITION BY series_id, channel ORDER BY t))"""
MOMENT = """(SELECT p.series_id, p.channel, avg(pow(v - mean, 2)) AS m2, avg(pow(v - mean, 3)) AS m3, avg(pow(v - mean, 4)) AS m4
  FROM pts p JOIN stats USING (series_id, channel) GROUP BY ALL)"""
SIMPLE = {
    "std_of_first_derivative": "stddev_pop(v - prev)",
    "turning_points": "sum(CASE WHEN v > prev AND v > next OR v < prev AND v < next THEN 1 ELSE 0 END) / count(*)",
    "series_in_series": "(1 + sum(CASE WHEN (v > med) <> (prev > med) THEN 1 ELSE 0 END)) / count(*)",
    "rsd": "abs(stddev_pop(v) / avg(v)) * 100",
    "CO_trev_1_num": "avg(pow((v - prev) / sd, 3))",
    "MD_hrv_classic_pnn40": "sum(CASE WHEN abs((v - prev) / sd) * 1000 > 40 THEN 1 ELSE 0 END) / (count(*) - 1)",
    "FC_LocalSimple_mean3_stderr": "stddev_samp((v - (prev + prev2 + prev3) / 3) / sd)",
    "trev_num": "avg(pow((v - prev) / sd, 3))",
    "std1st_der": "stddev_samp((v - prev) / sd)",
    "mean": "avg(v)",
    "var": "var_samp(v)",
}
BASIS = [WEEKLY, pts("weekly"), STATS, LAGS]


def _aggregate(names):
    cols = ", ".join(f"{SIMPLE[c]} AS {c}" for c in names)
    return f"SELECT series_id, channel, {cols} FROM lags GROUP BY ALL"


def _point(name, names, digits=6):
    @query(name, sql(BASIS, _aggregate(names), names, digits=digits))
    def run(spark, d):
        return rounded(stats.point_features(base.weekly(spark, d), list(names), longest=base.WEEKS), digits)


@query("agg1_skewness", sql([WEEKLY, pts("weekly"), STATS], f"SELECT series_id, channel, m3 / pow(m2, 1.5) AS skewness FROM {MOMENT}", ["skewness"]))
def agg1(spark, d):
    return rounded(stats.point_features(base.weekly(spark, d), ["skewness"]))


@query("agg2_kurtosis", sql([WEEKLY, pts("weekly"), STATS], f"SELECT series_id, channel, m4 / (m2 * m2) - 3 AS kurt FROM {MOMENT}", ["kurt"]))
def agg2(spark, d):
    return rounded(stats.point_features(base.weekly(spark, d), ["kurt"]))


_point("agg3_relative_std", ["rsd"])
_point("agg4_std_of_difference", ["std_of_first_derivative"], 4)
_point("agg5_turning_points", ["turning_points"])
_point("agg7_runs_about_median", ["series_in_series"])
_point("agg17_mean_var", ["mean", "var"], 2)
_point("l8_trev", ["CO_trev_1_num"])
_point("l9_pnn40", ["MD_hrv_classic_pnn40"])
_point("l14_local_mean3_stderr", ["FC_LocalSimple_mean3_stderr"])
_point("l32_difference_moments", ["trev_num", "std1st_der"])

INV = """SELECT a.series_id, a.channel, count(*) FILTER (a.v > b.v) / any_value(n) AS inversions, count(*) FILTER (a.v > b.v) AS pairs
  FROM pts a JOIN pts b ON a.series_id = b.series_id AND a.channel = b.channel AND a.t < b.t
  JOIN stats s ON s.series_id = a.series_id AND s.channel = a.channel GROUP BY ALL"""


@query("agg6_j5_inversions", sql([WEEKLY, pts("weekly"), STATS], INV, ["inversions"], ["pairs"]))
def agg6(spark, d):
    return rounded(order.inversions(base.weekly(spark, d), longest=base.WEEKS))


@query(
    "agg8_simple_bundle",
    sql(
        BASIS,
        f"SELECT * FROM ({_aggregate(['rsd', 'std_of_first_derivative', 'turning_points', 'series_in_series'])}) "
        f"JOIN (SELECT series_id, channel, m3 / pow(m2, 1.5) AS skewness, m4 / (m2 * m2) - 3 AS kurt FROM {MOMENT}) USING (series_id, channel) "
        f"JOIN ({INV}) USING (series_id, channel)",
        stats.BUNDLE,
        digits=4,
    ),
)
def agg8(spark, d):
    return rounded(stats.other_features(base.weekly(spark, d), longest=base.WEEKS), 4)


@query("agg11_length", sql([HOURLY, pts("hourly"), STATS], "SELECT series_id, channel, n AS length FROM stats", [], ["length"]))
def agg11(spark, d):
    return stats.point_features(base.hourly(spark, d), ["length"])


@query("agg12_median_std", sql([WEEKLY, pts("weekly"), STATS], "FROM stats", ["med", "sd", "sd_pop"], ["n"], 4))
def agg12(spark, d):
    return rounded(order.describe(base.weekly(spark, d), median=True).select(*KEY, "n", "med", "sd", "sd_pop"), 4)


@query("l23_crossing_points", sql(BASIS, "SELECT series_id, channel, CAST(sum(CASE WHEN (v > med) <> (prev > med) THEN 1 ELSE 0 END) AS BIGINT) AS crossing_points FROM lags GROUP BY ALL", [], ["crossing_points"]))
def l23(spark, d):
    return stats.point_features(base.weekly(spark, d), ["crossing_points"])


@query(
    "agg9_mean_rows",
    sql(
        [CHANNELS, pts("channels"), STATS, LAGS],
        f"SELECT series_id, avg(rsd) AS rsd, avg(turning_points) AS turning_points, avg(std1st_der) AS std1st_der FROM ({_aggregate(['rsd', 'turning_points', 'std1st_der'])}) GROUP BY ALL",
        ["rsd", "turning_points", "std1st_der"],
        key=("series_id",),
    ),
)
def agg9(spark, d):
    rows = stats.point_features(base.channels(spark, d), ["rsd", "turning_points", "std1st_der"])
    return rounded(stats.mean_rows(rows))
