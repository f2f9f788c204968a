"""Strengths and period ranking (MATH7-9, MATH13, TOP2, TOP3)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from seriesprep.layout import KEY
from seriesprep.operators import decompose, spectrum

from . import base
from .base import DAILY, HOURLY, WEEKLY, pts, query, rounded, sql

PERIODS = [4, 7, 12, 24, 48, 52]


def classical(points, periods=PERIODS):
    """Moving-average trend and phase means: components that SQL can build too."""
    rows = points.withColumn("period", F.explode(F.array(*[F.lit(p).cast("bigint") for p in periods])))
    by_time = Window.partitionBy(*KEY, "period").orderBy("t").rowsBetween(-6, 6)
    by_phase = Window.partitionBy(*KEY, "period", F.col("t") % F.col("period"))
    rows = rows.withColumn("trend", F.avg("v").over(by_time))
    rows = rows.withColumn("seasonal", F.avg(F.col("v") - F.col("trend")).over(by_phase))
    return rows.withColumn("resid", F.col("v") - F.col("trend") - F.col("seasonal"))


CLASSICAL = """parts AS (
  SELECT *, v - trend - seasonal AS resid FROM (
    SELECT *, avg(v - trend) OVER (PARTITION BY series_id, channel, period, t % period) AS seasonal FROM (
      SELECT *, avg(v) OVER (PARTITION BY series_id, channel, period ORDER BY t ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) AS trend
      FROM pts, (SELECT unnest([4, 7, 12, 24, 48, 52]) AS period))))"""
STRENGTHS = """strengths AS (
  SELECT series_id, channel, period,
    CASE WHEN d = 0 THEN 0 ELSE greatest(0, 1 - r / d) END AS seasonal_strength,
    CASE WHEN s = 0 THEN 0 ELSE greatest(0, 1 - r / s) END AS trend_strength
  FROM (SELECT series_id, channel, period, var_samp(resid) AS r, var_samp(v - trend) AS d, var_samp(v - seasonal) AS s FROM parts GROUP BY ALL))"""
RANKED = """top AS (
  SELECT series_id, channel, """ + ", ".join(
    f"max(CASE WHEN pos = {i} THEN period END) AS period_value{i}, max(CASE WHEN pos = {i} THEN seasonal_strength END) AS seasonal_strength{i}, "
    f"max(CASE WHEN pos = {i} THEN trend_strength END) AS trend_strength{i}"
    for i in (1, 2, 3)
) + """ FROM (SELECT *, row_number() OVER (PARTITION BY series_id, channel ORDER BY seasonal_strength DESC, period) AS pos FROM strengths) GROUP BY ALL)"""
BASIS = [HOURLY, pts("hourly"), CLASSICAL, STRENGTHS]


def _strengths(points, periods=PERIODS):
    parts = classical(points, periods)
    keyed = parts.withColumn("channel", F.concat_ws("|", "channel", "period"))
    rows = decompose.component_strengths(keyed)
    split = F.split("channel", r"\|")
    return rows.withColumn("period", split[1].cast("bigint")).withColumn("channel", split[0])


@query("math8_math9_strengths", sql(BASIS, "FROM strengths", ["seasonal_strength", "trend_strength"], ["period"]))
def math8(spark, d):
    return rounded(_strengths(base.hourly(spark, d)))


TRIPLES = [f"{x}{i}" for i in (1, 2, 3) for x in ("seasonal_strength", "trend_strength")]


@query(
    "top2_math13_best_periods",
    sql(
        [*BASIS, RANKED],
        "SELECT *, seasonal_strength1 >= 0.9 AS if_season, trend_strength1 >= 0.85 AS if_trend FROM top",
        TRIPLES,
        ["period_value1", "period_value2", "period_value3", "if_season", "if_trend"],
    ),
)
def top2(spark, d):
    return rounded(decompose.best_periods(_strengths(base.hourly(spark, d))))


@query(
    "top3_padding",
    sql(
        [HOURLY, pts("hourly"), CLASSICAL, STRENGTHS],
        "SELECT series_id, channel, max(seasonal_strength) AS seasonal_strength1, CAST(0 AS BIGINT) AS period_value2, (-1)::DOUBLE AS seasonal_strength2, (-1)::DOUBLE AS trend_strength2, "
        "CAST(0 AS BIGINT) AS period_value3, (-1)::DOUBLE AS seasonal_strength3, (-1)::DOUBLE AS trend_strength3 FROM strengths WHERE period = 7 GROUP BY ALL",
        ["seasonal_strength1", "seasonal_strength2", "trend_strength2", "seasonal_strength3", "trend_strength3"],
        ["period_value2", "period_value3"],
    ),
)
def top3(spark, d):
    rows = decompose.best_periods(_strengths(base.hourly(spark, d), [7]))
    return rounded(rows.drop("period_value1", "trend_strength1", "if_season", "if_trend"))


def line_weights(name, q, n, first, last, span):
    """Weights of a local line of width q at positions first..last of n points, as rows (pos, j, w)."""
    return f"""{name} AS MATERIALIZED (SELECT pos, j, CASE WHEN sqrt(spread) > 0.001 * {span} THEN w * ((pos - centre) / spread * (j - centre) + 1) ELSE w END AS w FROM (
  SELECT *, sum(w * (j - centre) * (j - centre)) OVER (PARTITION BY pos) AS spread FROM (
    SELECT *, sum(w * j) OVER (PARTITION BY pos) AS centre FROM (
      SELECT pos, j, u / sum(u) OVER (PARTITION BY pos) AS w FROM (
        SELECT pos, j, CASE WHEN d <= 0.001 * h THEN 1.0::DOUBLE WHEN d <= 0.999 * h THEN pow(1 - pow(d / h, 3), 3) ELSE 0 END AS u FROM (
          SELECT pos, l + i AS j, CAST(abs(l + i - pos) AS DOUBLE) AS d, CAST(greatest(pos - l, l + {q} - 1 - pos) AS DOUBLE) AS h
          FROM (SELECT pos, greatest(0, least(pos - ({q} - 1) // 2, {n} - {q})) AS l FROM range({first}, {last} + 1) r(pos)), range({q}) s(i)))))))"""


def seasonal_passes(p, n, wide, low, passes=5):
    """The smoothing passes as joins with weights; p must divide n."""
    keys = "series_id, channel"
    ctes = [
        line_weights("around_cycle", 7, n // p, -1, n // p, n // p - 1),
        line_weights("around_low", low, n, 0, n - 1, n - 1),
        line_weights("around_trend", wide, n, 0, n - 1, n - 1),
        f"trend_0 AS (SELECT {keys}, t, 0.0::DOUBLE AS x FROM pts)",
    ]
    for k in range(1, passes + 1):
        ctes += [
            f"""cycle_{k} AS MATERIALIZED (SELECT {keys}, pos * {p} + phase AS t, sum(w * y) AS c FROM (
  SELECT {keys}, t // {p} AS j, t % {p} AS phase, v - x AS y FROM pts JOIN trend_{k - 1} USING ({keys}, t)) JOIN around_cycle USING (j) GROUP BY {keys}, pos, phase)""",
            f"""low_{k} AS MATERIALIZED (SELECT {keys}, t + {p} AS j, avg(b) OVER (PARTITION BY {keys} ORDER BY t ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS y FROM (
  SELECT *, avg(a) OVER (PARTITION BY {keys} ORDER BY t ROWS BETWEEN CURRENT ROW AND {p - 1} FOLLOWING) AS b FROM (
    SELECT *, avg(c) OVER (PARTITION BY {keys} ORDER BY t ROWS BETWEEN CURRENT ROW AND {p - 1} FOLLOWING) AS a FROM cycle_{k})))""",
            f"""seasonal_{k} AS MATERIALIZED (SELECT {keys}, t, c - x AS s FROM cycle_{k} JOIN (
  SELECT {keys}, pos AS t, sum(w * y) AS x FROM low_{k} JOIN around_low USING (j) GROUP BY {keys}, pos) USING ({keys}, t))""",
            f"""trend_{k} AS MATERIALIZED (SELECT {keys}, pos AS t, sum(w * (v - s)) AS x FROM (
  SELECT {keys}, t AS j, v, s FROM pts JOIN seasonal_{k} USING ({keys}, t)) JOIN around_trend USING (j) GROUP BY {keys}, pos)""",
        ]
    return ctes


# At period 24 the trend is 47 points wide and the low pass 25.
@query(
    "math7_decomposition",
    sql(
        [HOURLY, pts("hourly"), *seasonal_passes(24, base.HOURS, 47, 25)],
        "SELECT series_id, channel, t, v, s AS seasonal, x AS trend, v - s - x AS resid FROM pts JOIN seasonal_5 USING (series_id, channel, t) JOIN trend_5 USING (series_id, channel, t)",
        ["v", "seasonal", "trend", "resid"],
        ["t"],
    ),
)
def math7(spark, d):
    return rounded(decompose.components(base.hourly(spark, d), 24))


@query(
    "math8_math9_strengths_of_a_period",
    sql(
        [HOURLY, pts("hourly"), *seasonal_passes(24, base.HOURS, 47, 25)],
        """SELECT series_id, channel, CAST(24 AS BIGINT) AS period, CASE WHEN var_pop(v - x) = 0 THEN 0 ELSE greatest(0, 1 - var_pop(v - s - x) / var_pop(v - x)) END AS seasonal_strength,
    CASE WHEN var_pop(v - s) = 0 THEN 0 ELSE greatest(0, 1 - var_pop(v - s - x) / var_pop(v - s)) END AS trend_strength
  FROM pts JOIN seasonal_5 USING (series_id, channel, t) JOIN trend_5 USING (series_id, channel, t) GROUP BY series_id, channel""",
        ["seasonal_strength", "trend_strength"],
        ["period"],
    ),
)
def math8(spark, d):
    points = base.hourly(spark, d)
    tested = points.groupBy(*KEY).agg(F.count("*").alias("n"), F.array(F.lit(24).cast("bigint")).alias("periods"))
    return rounded(decompose.strengths(points, tested))


@query(
    "math7_components_add_up",
    sql([DAILY], "FROM daily", ["v"], ["t"], 2),
)
def math7_sum(spark, d):
    rows = decompose.components(base.daily(spark, d), 7)
    return rounded(rows.select(*KEY, "t", (F.col("seasonal") + F.col("trend") + F.col("resid")).alias("v")), 2)


@query("math7_tested_strengths")
def math7_all(spark, d):
    points = base.weekly(spark, d)
    tested = spectrum.tested_periods(spectrum.candidate_periods(spectrum.spectrum(points)))
    return rounded(decompose.best_periods(decompose.strengths(points, tested), tested))
