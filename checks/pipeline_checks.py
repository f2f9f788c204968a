"""Report, screen, pipelines, sinks and channel similarity (REP, F1, F6, F7, J1-J4, AGG10, SNK, P1-P4)."""

from pyspark.sql import functions as F

from seriesprep.arrange import buckets_for, co_located, stored
from seriesprep.layout import KEY, cut_lineage, shared_folder
from seriesprep.operators import autocorr, channels, divergence, screen, stats, symbolic
from seriesprep.params import Params
from seriesprep.plans import pipeline, report

from . import base
from .autocorr_checks import ACF
from .base import CHANNELS, STATS, WEEKLY, pts, query, rounded, scratch_dir, sql
from .decompose_checks import CLASSICAL, STRENGTHS, _strengths
from .divergence_checks import jsd_ctes
from .repair_checks import FILLED, FIX, FLAGS, REPAIRED, ROLL
from .stats_checks import LAGS, SIMPLE
from .symbolic_checks import TAU, terciles, timing

# looser than the defaults, which reject every one of these series
LOOSE = Params(
    seasonality_threshold=0.02, trend_threshold=0.005, shifting_threshold=0.5, transition_threshold=0.09, long_term_jsd_threshold=0.2
)


def placed_weekly(spark, d):
    """The weekly points stored once by series: no step of the report makes or moves them again."""
    n = base.table(spark, d, "supplier").count() * base.WEEKS
    return stored(base.weekly(spark, d), buckets_for(spark, n), KEY, shared_folder(spark))


def sql_report(points, d=None):
    """The eight report columns from operators SQL can repeat; Stationarity stays NULL.

    Points that lie by series are read in place; the result, one row per series, is stored.
    """
    with co_located(points.sparkSession):
        sums = autocorr.lag_sums(points, longest=base.WEEKS)
        best = _strengths(points, [12]).select(*KEY, F.col("seasonal_strength").alias("seasonal_strength1"), F.col("trend_strength").alias("trend_strength1"))
        parts = [symbolic.transition(points, sums), symbolic.outlier_timing(points, 1), divergence.series_divergence(points)]
        for p in parts:
            best = best.join(p, KEY, "left")
        return cut_lineage(report.short_report(best.withColumn("adf_pvalue", F.lit(None).cast("double"))))


REPORT = [
    WEEKLY, pts("weekly"), STATS, ACF, TAU, terciles("thin"), timing(1, "timing"), *jsd_ctes(30), *jsd_ctes(336), CLASSICAL, STRENGTHS,
    """report AS (SELECT s.series_id, s.channel, CAST(NULL AS DOUBLE) AS Correlation, tr.v AS Transition, abs(ti.timing) AS Shifting,
      s.seasonal_strength AS Seasonality, s.trend_strength AS Trend, CAST(NULL AS DOUBLE) AS Stationarity, a.jsd AS Short_term_jsd, b.jsd AS Long_term_jsd
    FROM strengths s
    JOIN (SELECT series_id, channel, sum(v) AS v FROM (SELECT series_id, channel, b, (sum(p * p) - sum(p) * sum(p) / 3) / 2 AS v
      FROM (SELECT series_id, channel, b, c / m AS p FROM words) GROUP BY series_id, channel, b) GROUP BY ALL) tr USING (series_id, channel)
    JOIN timing ti USING (series_id, channel)
    LEFT JOIN (SELECT series_id, channel, avg(jsd) AS jsd FROM jsd30 GROUP BY ALL) a USING (series_id, channel)
    LEFT JOIN (SELECT series_id, channel, avg(jsd) AS jsd FROM jsd336 GROUP BY ALL) b USING (series_id, channel)
    WHERE s.period = 12)""",
]
NAMES = ["Correlation", "Transition", "Shifting", "Seasonality", "Trend", "Stationarity", "Short_term_jsd", "Long_term_jsd"]
TESTS = {
    "trend": "Trend < 0.005",
    "transition": "Transition > 0.09",
    "seasonality": "Seasonality < 0.02",
    "shifting": "abs(Shifting) > 0.5",
    "long_term_jsd": "Long_term_jsd > 0.2",
}
PASSES = " AND ".join(f"NOT coalesce({t}, false)" for t in TESTS.values())


@query("rep2_rep3_rep4_short_report", sql(REPORT, "FROM report", NAMES))
def rep2(spark, d):
    return rounded(sql_report(placed_weekly(spark, d)))


@query("f1_quality_screen", sql(REPORT, f"SELECT *, {PASSES} AS keep FROM report", [], ["keep"]))
def f1(spark, d):
    return sql_report(placed_weekly(spark, d)).select(*KEY, screen.passes_quality(LOOSE).alias("keep"))


@query(
    "f7_reject_reasons",
    sql(
        REPORT,
        "SELECT series_id, channel, r.reason FROM report, (SELECT unnest(['trend', 'transition', 'seasonality', 'shifting', 'long_term_jsd']) AS reason) r WHERE CASE r.reason "
        + " ".join(f"WHEN '{k}' THEN {t}" for k, t in TESTS.items()) + " END",
        [],
        ["reason"],
    ),
)
def f7(spark, d):
    points = placed_weekly(spark, d)
    rows = screen.with_verdict(sql_report(points), screen.zero_flags(points, LOOSE), LOOSE)
    return rows.select(*KEY, F.explode("reasons").alias("reason"))


@query(
    "j2_j3_snk3_cleaned_survivors",
    sql([*REPORT, ROLL, FILLED, FLAGS, REPAIRED], f"SELECT * FROM repaired SEMI JOIN (SELECT * FROM report WHERE {PASSES}) USING (series_id, channel)", ["repaired AS v"], ["t"], 4).replace(
        "round(repaired AS v, 4) + 0.0 AS repaired AS v", "round(repaired, 4) + 0.0 AS v"
    ),
)
def snk3(spark, d):
    from seriesprep.operators.repair import repair

    points = placed_weekly(spark, d)
    verdict = screen.with_verdict(sql_report(points), screen.zero_flags(points, LOOSE), LOOSE)
    path = scratch_dir(spark, "cleaned")
    with co_located(spark):
        kept = repair(pipeline.survivors(points, verdict)).select(*KEY, "t", F.col("repaired").alias("v"))
        pipeline.write_cleaned(kept, path)
    rows = spark.read.parquet(path).select(*KEY, "lo", F.posexplode("values").alias("i", "v"))
    return rounded(rows.select(*KEY, (F.col("lo") + F.col("i")).alias("t"), "v"), 4)


@query(
    "j1_joined_features",
    sql(
        [WEEKLY, pts("weekly"), STATS, LAGS, *jsd_ctes(30)],
        f"SELECT * FROM (SELECT series_id, channel, avg(jsd) AS short_term_jsd FROM jsd30 GROUP BY ALL) LEFT JOIN (SELECT series_id, channel, {SIMPLE['rsd']} AS rsd FROM lags GROUP BY ALL) USING (series_id, channel)",
        ["short_term_jsd", "rsd"],
    ),
)
def j1(spark, d):
    points = base.weekly(spark, d)
    left = divergence.series_divergence(points).select(*KEY, "short_term_jsd")
    return rounded(left.join(stats.point_features(points, ["rsd"]), KEY, "left"))


SCORED = ["skewness", "rsd", "turning_points", "series_in_series", "std1st_der", "MD_hrv_classic_pnn40", "CO_trev_1_num", "mean"]
VECTOR = "SELECT series_id, channel, m3 / pow(m2, 1.5) AS skewness, " + ", ".join(c for c in SCORED if c != "skewness")
FEATURES = f"""feats AS ({VECTOR} FROM (SELECT series_id, channel, {', '.join(f'{SIMPLE[c]} AS {c}' for c in SCORED if c != 'skewness')} FROM lags GROUP BY ALL)
  JOIN (SELECT p.series_id, p.channel, avg(pow(v - mean, 2)) AS m2, avg(pow(v - mean, 3)) AS m3 FROM pts p JOIN stats USING (series_id, channel) GROUP BY ALL) USING (series_id, channel)),
scaled AS (SELECT series_id, channel, {', '.join(f'CASE WHEN max({c}) OVER w = min({c}) OVER w THEN 0 ELSE ({c} - min({c}) OVER w) / (max({c}) OVER w - min({c}) OVER w) END AS {c}' for c in SCORED)}
  FROM feats WINDOW w AS (PARTITION BY series_id)),
long AS (UNPIVOT scaled ON {', '.join(SCORED)} INTO NAME f VALUE x)"""


@query("w8_scaled_features", sql([CHANNELS, pts("channels"), STATS, LAGS, FEATURES], "FROM scaled", SCORED))
def w8(spark, d):
    return rounded(channels.scale_features(stats.point_features(base.channels(spark, d), SCORED), SCORED))


@query(
    "agg10_j4_channel_correlation",
    sql(
        [CHANNELS, pts("channels"), STATS, LAGS, FEATURES],
        """SELECT s.series_id, CASE WHEN n > 1 THEN score END AS correlation FROM (SELECT series_id, count(DISTINCT channel) AS n FROM pts GROUP BY ALL) s LEFT JOIN (
  SELECT series_id, 2 * (avg(c) + 1 / (var_pop(c) + 2)) / 3 AS score FROM (
    SELECT a.series_id, a.channel AS i, b.channel AS j, abs(corr(a.x, b.x)) AS c FROM long a JOIN long b ON a.series_id = b.series_id AND a.channel < b.channel AND a.f = b.f GROUP BY ALL) GROUP BY series_id) x USING (series_id)""",
        ["correlation"],
        key=("series_id",),
    ),
)
def agg10(spark, d):
    rows = stats.point_features(base.channels(spark, d), SCORED)
    return rounded(channels.correlation_score(rows, SCORED))


@query("f6_screen_verdict")
def f6(spark, d):
    points = base.weekly(spark, d)
    table = report.core_report(points)
    return rounded(pipeline.screen(points, table))


@query("p1_clean")
def p1(spark, d):
    loose = Params(seasonality_threshold=0.3, trend_threshold=0.0, shifting_threshold=0.6, transition_threshold=0.2)
    points = pipeline.stage_points(base.weekly(spark, d), scratch_dir(spark, "points"))
    return rounded(pipeline.clean(points, loose), 4)


@query("p2_math14_profile_core")
def p2(spark, d):
    return rounded(pipeline.profile(base.hourly(spark, d), ["pointwise", "inversions"]))


@query("p3_screen_stored_report")
def p3(spark, d):
    path = scratch_dir(spark, "profile")
    points = pipeline.stage_points(base.hourly(spark, d), scratch_dir(spark, "points"))
    pipeline.write_report(pipeline.profile(points, []), path)
    return rounded(pipeline.screen(points, spark.read.parquet(f"{path}/short")))


@query("p4_snk2_group_report")
def p4(spark, d):
    path = scratch_dir(spark, "groups")
    points = pipeline.stage_points(base.channels(spark, d), scratch_dir(spark, "points"))
    pipeline.write_group_report(pipeline.profile_groups(points), path)
    return rounded(spark.read.parquet(f"{path}/mean_short"))


@query("snk1_rep1_rep5_full_report")
def snk1(spark, d):
    path = scratch_dir(spark, "full")
    points = pipeline.stage_points(base.hourly(spark, d), scratch_dir(spark, "points"))
    pipeline.write_report(pipeline.profile(points), path)
    return rounded(spark.read.parquet(f"{path}/all"))


@query("rejected_series", sql([WEEKLY], "SELECT series_id, channel, 'missing observations' AS reason FROM weekly GROUP BY series_id, channel HAVING bool_or(v > 250000)", [], ["reason"]))
def rejected(spark, d):
    holes = base.weekly(spark, d).withColumn("v", F.when(F.col("v") <= 250000, F.col("v")))
    return report.rejects(holes)
