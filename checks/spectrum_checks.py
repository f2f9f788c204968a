"""Spectrum, peaks and candidate periods (MATH1-MATH4, W10, TOP1, SET1, F8-F10, J6)."""

from pyspark.sql import functions as F

from seriesprep.functions.scalars import DEFAULT_PERIODS, STANDARD_PERIODS, adjust_period, bin_period
from seriesprep.layout import KEY
from seriesprep.operators import spectrum

from . import base
from .base import HOURLY, STATS, WEEKLY, pts, query, rounded, sql, table

AMP = """amp AS (
  SELECT series_id, channel, n, k,
    2 * sqrt(pow(sum(v * cos(2 * pi() * ((k * t) % n) / n)), 2) + pow(sum(v * sin(2 * pi() * ((k * t) % n) / n)), 2)) / any_value(n) AS amp
  FROM pts JOIN stats USING (series_id, channel), range(2000) r(k) WHERE k < n // 2 GROUP BY series_id, channel, n, k)"""
SNAP = "CASE " + " ".join(f"WHEN p BETWEEN {a} AND {b} THEN {c}" for a, b, c in STANDARD_PERIODS) + " ELSE p END"
PEAKS = f"""peaks AS (
  SELECT *, {SNAP} AS adjusted FROM (
    SELECT series_id, channel, n, k, amp, row_number() OVER (PARTITION BY series_id, channel ORDER BY amp DESC, k) AS rank,
      CAST(round_even(n / k, 0) AS BIGINT) AS p
    FROM (SELECT *, lag(amp) OVER w AS a, lead(amp) OVER w AS b FROM amp WINDOW w AS (PARTITION BY series_id, channel ORDER BY k))
    WHERE amp > a AND amp > b))"""
TOP = """cand AS (
  SELECT series_id, channel, n, adjusted, row_number() OVER (PARTITION BY series_id, channel ORDER BY min(rank)) AS pos
  FROM peaks WHERE adjusted >= 4 GROUP BY series_id, channel, n, adjusted)"""
TESTED = """tested AS (
  SELECT DISTINCT series_id, channel, p AS period FROM (
    SELECT series_id, channel, n, adjusted AS p FROM cand WHERE pos <= 3
    UNION ALL SELECT series_id, channel, n, unnest([4, 7, 12, 24, 48, 52, 96, 144, 168, 336, 672, 1008, 1440]) FROM stats)
  WHERE p >= 4 AND p < greatest(n // 3, 12))"""
BASIS = [HOURLY, pts("hourly"), STATS, AMP, PEAKS, TOP, TESTED]
BASIS_W = [WEEKLY, pts("weekly"), STATS, AMP, PEAKS, TOP, TESTED]


@query(
    "math1_j6_adjust_period",
    f"SELECT p, {SNAP} AS adjusted, n FROM (SELECT CAST(floor(o_totalprice / 10) AS BIGINT) AS p, count(*) AS n FROM orders GROUP BY 1) q",
)
def math1(spark, d):
    orders = table(spark, d, "orders").groupBy(F.floor(F.col("o_totalprice") / 10).alias("p")).agg(F.count("*").alias("n"))
    return orders.select("p", adjust_period(F.col("p")).alias("adjusted"), "n")


@query("math2_spectrum", sql(BASIS[:4], "FROM amp", ["amp"], ["k"]))
def math2(spark, d):
    rows = spectrum.spectrum(base.hourly(spark, d), longest=base.HOURS)
    return rounded(rows.select(*KEY, F.posexplode("amps").alias("k", "amp")))


@query("math3_w10_spectral_peaks", sql(BASIS[:5], "FROM peaks", ["amp"], ["k", "rank", "adjusted", "p AS period"]))
def math3(spark, d):
    rows = spectrum.spectral_peaks(spectrum.spectrum(base.hourly(spark, d), longest=base.HOURS))
    return rounded(rows.select(*KEY, "k", "rank", "amp", "period", "adjusted"))


@query(
    "math4_bin_period",
    "SELECT n, k, CAST(round_even(n / k, 0) AS BIGINT) AS period, count(*) AS rows FROM "
    "(SELECT CAST(floor(l_extendedprice) AS BIGINT) % 2000 + 4 AS n, l_linenumber::BIGINT * 2 AS k FROM lineitem) GROUP BY ALL",
)
def math4(spark, d):
    n = F.floor("l_extendedprice") % 2000 + 4
    rows = table(spark, d, "lineitem").select(n.alias("n"), (F.col("l_linenumber").cast("bigint") * 2).alias("k"))
    return rows.groupBy("n", "k").agg(F.count("*").alias("rows")).withColumn("period", bin_period(F.col("n"), F.col("k")))


@query("f8_amplitude_floor", sql(BASIS_W[:5], "SELECT * FROM peaks WHERE amp >= 5000", ["amp"], ["k", "p AS period"], 4))
def f8(spark, d):
    rows = spectrum.spectral_peaks(spectrum.spectrum(base.weekly(spark, d), longest=base.WEEKS), fmin=5000.0)
    return rounded(rows.select(*KEY, "k", "period", "amp"), 4)


@query("top1_f10_detected_periods", sql(BASIS_W[:6], "SELECT * FROM cand WHERE pos <= 3", [], ["adjusted AS period", "pos"]))
def top1(spark, d):
    rows = spectrum.candidate_periods(spectrum.spectrum(base.weekly(spark, d), longest=base.WEEKS))
    rows = rows.select(*KEY, F.posexplode("detected").alias("pos", "period"))
    return rows.select(*KEY, "period", (F.col("pos") + 1).cast("bigint").alias("pos"))


@query("set1_f9_tested_periods", sql(BASIS_W, "FROM tested", [], ["period"]))
def set1(spark, d):
    rows = spectrum.tested_periods(spectrum.candidate_periods(spectrum.spectrum(base.weekly(spark, d), longest=base.WEEKS)))
    return rows.select(*KEY, F.explode("periods").alias("period"))
