"""Windowed divergence from the normal curve (AGG13-AGG16, MATH5, MATH6, W9)."""

from pyspark.sql import functions as F

from seriesprep.functions.scalars import normal_density
from seriesprep.layout import KEY
from seriesprep.operators import divergence, order

from . import base
from .base import CHANNELS, HOURLY, STATS, WEEKLY, pts, query, rounded, sql


def index(k):
    """Histogram bin with the same edge corrections on both sides."""
    raw = f"least(CAST(trunc((v - lo) / width * {k}) AS BIGINT), {k} - 1)"
    return f"""(SELECT j + CASE WHEN v >= (j + 1) * (width / {k}) + lo AND j <> {k} - 1 THEN 1 ELSE 0 END
      FROM (SELECT i - CASE WHEN v < i * (width / {k}) + lo THEN 1 ELSE 0 END AS j FROM (SELECT {raw} AS i)))"""


def jsd_ctes(w: int) -> list[str]:
    return [
        f"""win{w} AS (SELECT series_id, channel, t // {w} AS wid, v FROM pts JOIN stats USING (series_id, channel) WHERE t // {w} < n // {w})""",
        f"""shape{w} AS (SELECT series_id, channel, wid, min(v) AS lo, max(v) - min(v) AS width, avg(v) AS mu, stddev_pop(v) AS sg FROM win{w} GROUP BY ALL)""",
        f"""cells{w} AS (
  SELECT series_id, channel, wid, k, j + CASE WHEN v >= (j + 1) * (width / k) + lo AND j <> k - 1 THEN 1 ELSE 0 END AS b, count(*) AS c
  FROM (SELECT *, i - CASE WHEN v < i * (width / k) + lo THEN 1 ELSE 0 END AS j
        FROM (SELECT *, least(CAST(trunc((v - lo) / width * k) AS BIGINT), k - 1) AS i
              FROM win{w} JOIN shape{w} USING (series_id, channel, wid), range(1, 102) r(k) WHERE width > 0)) GROUP BY ALL)""",
        f"""best{w} AS (
  SELECT series_id, channel, wid, CAST(ceil(width / (width / k)) AS BIGINT) AS bins, width / ceil(width / (width / k)) AS h, lo, mu, sg FROM (
    SELECT *, row_number() OVER (PARTITION BY series_id, channel, wid ORDER BY risk, k) AS pos FROM (
      SELECT series_id, channel, wid, k, any_value(lo) AS lo, any_value(width) AS width, any_value(mu) AS mu, any_value(sg) AS sg,
        (2 - ({w} + 1) * CAST(sum(c * c) AS DOUBLE) / ({w} * {w})) / (any_value(width) / k) AS risk
      FROM cells{w} JOIN shape{w} USING (series_id, channel, wid) WHERE k <= 100 GROUP BY series_id, channel, wid, k)) WHERE pos = 1)""",
        f"""bins{w} AS (
  SELECT b.*, r.j, coalesce(c.c, 0) AS c, coalesce(c.c, 0) / ({w} * h) AS p,
    exp(-pow((lo + (j + 0.5) * h - mu) / sg, 2) / 2) / (sg * sqrt(2 * pi())) AS q
  FROM best{w} b JOIN range(101) r(j) ON r.j < b.bins
  LEFT JOIN cells{w} c ON c.series_id = b.series_id AND c.channel = b.channel AND c.wid = b.wid AND c.k = b.bins AND c.b = r.j)""",
        f"""jsd{w} AS (
  SELECT s.series_id, s.channel, s.wid, coalesce(x.jsd, 0) AS jsd FROM shape{w} s LEFT JOIN (
    SELECT series_id, channel, wid, (sum(CASE WHEN p > 0 THEN p / sp * ln((p / sp) / (((p + q) / 2) / sm)) ELSE 0 END)
      + sum(CASE WHEN q > 0 THEN q / sq * ln((q / sq) / (((p + q) / 2) / sm)) ELSE 0 END)) / 2 AS jsd
    FROM (SELECT *, sum(p) OVER g AS sp, sum(q) OVER g AS sq, sum((p + q) / 2) OVER g AS sm FROM bins{w}
          WINDOW g AS (PARTITION BY series_id, channel, wid)) GROUP BY ALL) x USING (series_id, channel, wid))""",
    ]


BASIS = [WEEKLY, pts("weekly"), STATS]


@query("agg13_agg14_w9_window_jsd", sql([*BASIS, *jsd_ctes(30)], "SELECT *, wid AS window_id FROM jsd30", ["jsd"], ["window_id"]))
def agg14(spark, d):
    return rounded(divergence.window_divergence(base.weekly(spark, d), 30))


@query(
    "agg14_long_window_jsd",
    sql([HOURLY, pts("hourly"), STATS, *jsd_ctes(336)], "SELECT *, wid AS window_id FROM jsd336", ["jsd"], ["window_id"]),
)
def agg14_long(spark, d):
    return rounded(divergence.window_divergence(base.hourly(spark, d), 336))


BOTH = """SELECT series_id, channel, short_term_jsd, long_term_jsd
  FROM (SELECT series_id, channel, avg(jsd) AS short_term_jsd FROM jsd30 GROUP BY ALL)
  LEFT JOIN (SELECT series_id, channel, avg(jsd) AS long_term_jsd FROM jsd336 GROUP BY ALL) USING (series_id, channel)"""


@query(
    "agg16_short_long_jsd",
    sql([*BASIS, *jsd_ctes(30), *jsd_ctes(336)], BOTH, ["short_term_jsd", "long_term_jsd"]),
)
def agg16(spark, d):
    return rounded(divergence.series_divergence(base.weekly(spark, d)))


@query(
    "agg15_channel_jsd",
    sql(
        [CHANNELS, pts("channels"), STATS, *jsd_ctes(30)],
        "SELECT series_id, channel, avg(jsd) AS short_term_jsd FROM jsd30 GROUP BY ALL",
        ["short_term_jsd"],
    ),
)
def agg15(spark, d):
    rows = divergence.series_divergence(base.channels(spark, d))
    return rounded(rows.select(*KEY, "short_term_jsd"))


@query(
    "math5_normal_density",
    sql(BASIS, "SELECT series_id, channel, t, exp(-pow((v - mean) / sd_pop, 2) / 2) / (sd_pop * sqrt(2 * pi())) * sd_pop AS density FROM pts JOIN stats USING (series_id, channel)", ["density"], ["t"]),
)
def math5(spark, d):
    points = base.weekly(spark, d)
    rows = points.join(order.describe(points), KEY)
    dens = normal_density(F.col("v"), F.col("mean"), F.col("sd_pop")) * F.col("sd_pop")
    return rounded(rows.select(*KEY, "t", dens.alias("density")))


@query(
    "math6_js_divergence",
    """WITH a AS (SELECT l_suppkey AS k, l_linenumber AS j, CAST(sum(l_quantity) AS DOUBLE) AS p, CAST(count(*) AS DOUBLE) AS q FROM lineitem GROUP BY ALL),
b AS (SELECT *, sum(p) OVER g AS sp, sum(q) OVER g AS sq, sum((p + q) / 2) OVER g AS sm FROM a WINDOW g AS (PARTITION BY k))
SELECT CAST(k AS VARCHAR) AS id, round((sum(CASE WHEN p > 0 THEN p / sp * ln((p / sp) / ((p + q) / 2 / sm)) ELSE 0 END)
  + sum(CASE WHEN q > 0 THEN q / sq * ln((q / sq) / ((p + q) / 2 / sm)) ELSE 0 END)) / 2, 9) + 0.0 AS jsd FROM b GROUP BY k""",
)
def math6(spark, d):
    rows = (
        base.table(spark, d, "lineitem")
        .groupBy(F.col("l_suppkey").cast("string").alias("id"), "l_linenumber")
        .agg(F.sum("l_quantity").alias("p"), F.count("*").cast("double").alias("q"))
    )
    return rounded(divergence.js_divergence(rows, ["id"], "p", "q"), 9)
