"""Repair (W1-W6, J7) and zero detection."""

from pyspark.sql import functions as F

from seriesprep.operators import repair, screen

from . import base
from .base import STATS, VECTORS, WEEKLY, pts, query, rounded, sql

ROLL = """roll AS (
  SELECT *, CASE WHEN count(v) OVER f = 3 THEN avg(v) OVER f END AS roll_mean,
         CASE WHEN count(v) OVER f = 3 THEN
           sqrt((pow(lag(v) OVER w - avg(v) OVER f, 2) + pow(v - avg(v) OVER f, 2) + pow(lead(v) OVER w - avg(v) OVER f, 2)) / 2)
         END AS roll_std
  FROM pts
  WINDOW w AS (PARTITION BY series_id, channel ORDER BY t),
         f AS (PARTITION BY series_id, channel ORDER BY t ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING))"""
FILLED = """filled AS (
  SELECT series_id, channel, t, v, n, sd, med,
    coalesce(first_value(roll_mean IGNORE NULLS) OVER a, last_value(roll_mean IGNORE NULLS) OVER b) AS roll_mean,
    coalesce(first_value(roll_std IGNORE NULLS) OVER a, last_value(roll_std IGNORE NULLS) OVER b) AS s0
  FROM roll JOIN stats USING (series_id, channel)
  WINDOW a AS (PARTITION BY series_id, channel ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
         b AS (PARTITION BY series_id, channel ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""
FLAGS = """flags AS (
  SELECT *, CASE WHEN s0 = 0 THEN sd ELSE s0 END AS roll_std,
    coalesce(abs(v - roll_mean) > 7 * (CASE WHEN s0 = 0 THEN sd ELSE s0 END), false) AS local_outlier,
    coalesce(v < 0.2 * med, false) AS low_outlier
  FROM filled)"""
REPAIRED = """repaired AS (
  SELECT series_id, channel, t, v, bad AS is_outlier,
    CASE WHEN NOT bad THEN v
         WHEN l IS NOT NULL AND r IS NOT NULL THEN (r.v - l.v) / (r.t - l.t) * (t - l.t) + l.v
         WHEN l IS NOT NULL THEN l.v WHEN r IS NOT NULL THEN r.v ELSE v END AS repaired
  FROM (SELECT *, last_value(a IGNORE NULLS) OVER (PARTITION BY series_id, channel ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
                  first_value(a IGNORE NULLS) OVER (PARTITION BY series_id, channel ORDER BY t ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r
        FROM (SELECT *, local_outlier OR low_outlier AS bad,
                CASE WHEN NOT (local_outlier OR low_outlier) THEN struct_pack(t := t, v := v) END AS a FROM flags)))"""
FIX = [WEEKLY, pts("weekly"), STATS]


@query("w1_rolling", sql([WEEKLY, pts("weekly"), ROLL], "FROM roll", ["roll_mean", "roll_std"], ["t"], 4))
def w1(spark, d):
    rows = repair.rolling(base.weekly(spark, d))
    return rounded(rows.select("series_id", "channel", "t", "roll_mean", "roll_std"), 4)


@query("w2_w3_filled_rolling", sql([*FIX, ROLL, FILLED, FLAGS], "FROM flags", ["roll_mean", "roll_std"], ["t"], 4))
def w2(spark, d):
    rows = repair.filled_rolling(base.weekly(spark, d), longest=base.WEEKS)
    return rounded(rows.select("series_id", "channel", "t", "roll_mean", "roll_std"), 4)


@query("w4_w5_outlier_flags", sql([*FIX, ROLL, FILLED, FLAGS], "FROM flags", [], ["t", "local_outlier", "low_outlier"]))
def w4(spark, d):
    rows = repair.flag_outliers(base.weekly(spark, d), longest=base.WEEKS)
    return rows.select("series_id", "channel", "t", "local_outlier", "low_outlier")


@query("w6_repair", sql([*FIX, ROLL, FILLED, FLAGS, REPAIRED], "FROM repaired", ["repaired"], ["t", "is_outlier"], 4))
def w6(spark, d):
    rows = repair.repair(base.weekly(spark, d), longest=base.WEEKS)
    return rounded(rows.select("series_id", "channel", "t", "is_outlier", "repaired"), 4)


@query(
    "w6_repair_vectors",
    sql([VECTORS, pts("vectors"), STATS, ROLL, FILLED, FLAGS, REPAIRED], "FROM repaired", ["repaired"], ["t", "is_outlier"]),
)
def w6_vectors(spark, d):
    from seriesprep.layout import arrays_to_points

    rows = repair.repair(arrays_to_points(base.vectors(spark, d)))
    return rounded(rows.select("series_id", "channel", "t", "is_outlier", "repaired"))


ZERO = """zeros AS (
  SELECT *, zero_ratio > 0.9 OR zero_streak > 50 OR (head_mean < 0.005 AND head_std < 1) AS zero_or_constant,
    zero_ratio > 0.9 AS mostly_zero, zero_streak > 50 AS leading_zeros, head_mean < 0.005 AND head_std < 1 AS nearly_constant
  FROM (SELECT series_id, channel, avg(CASE WHEN t < 100 THEN (v = 0)::INT END) AS zero_ratio,
    coalesce(min(CASE WHEN v <> 0 THEN t END), count(*)) AS zero_streak,
    avg(CASE WHEN t < 100 THEN v END) AS head_mean, stddev_pop(CASE WHEN t < 100 THEN v END) AS head_std
    FROM pts GROUP BY ALL))"""


@query("f3_zero_ratio", sql([WEEKLY, pts("weekly"), ZERO], "FROM zeros", ["zero_ratio"], ["mostly_zero"]))
def f3(spark, d):
    return rounded(screen.zero_profile(base.weekly(spark, d)).select("series_id", "channel", "zero_ratio", "mostly_zero"))


@query("f4_leading_zeros", sql([WEEKLY, pts("weekly"), ZERO], "FROM zeros", [], ["zero_streak", "leading_zeros"]))
def f4(spark, d):
    return rounded(screen.zero_profile(base.weekly(spark, d)).select("series_id", "channel", "zero_streak", "leading_zeros"))


@query("f5_nearly_constant", sql([VECTORS, pts("vectors"), ZERO], "FROM zeros", ["head_mean", "head_std"], ["nearly_constant"]))
def f5(spark, d):
    from seriesprep.layout import arrays_to_points

    rows = screen.zero_profile(arrays_to_points(base.vectors(spark, d)))
    return rounded(rows.select("series_id", "channel", "head_mean", "head_std", "nearly_constant"))


@query("f2_zero_or_constant", sql([WEEKLY, pts("weekly"), ZERO], "FROM zeros", [], ["zero_or_constant"]))
def f2(spark, d):
    return screen.zero_flags(base.weekly(spark, d)).select("series_id", "channel", "zero_or_constant")
