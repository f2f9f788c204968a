"""Threshold and symbol features."""

from pyspark.sql import functions as F

from seriesprep.layout import KEY
from seriesprep.operators import autocorr, symbolic

from . import base
from .autocorr_checks import ACF
from .base import HOURLY, STATS, WEEKLY, pts, query, rounded, sql


def terciles(source):
    q = "s[CAST(floor({p}) AS BIGINT) + 1] + ({p} - floor({p})) * (s[CAST(ceil({p}) AS BIGINT) + 1] - s[CAST(floor({p}) AS BIGINT) + 1])"
    a, b = (q.format(p=f"greatest(least(n * ({k}.0::DOUBLE / 3.0) - 0.5, n - 1), 0)") for k in (1, 2))
    return f"""cuts AS (SELECT series_id, channel, {a} AS q1, {b} AS q2 FROM (
      SELECT series_id, channel, count(*) AS n, list_sort(list(v)) AS s FROM {source} GROUP BY ALL)),
coded AS (SELECT series_id, channel, a, lead(a) OVER (PARTITION BY series_id, channel ORDER BY t) AS b FROM (
      SELECT series_id, channel, t, 1 + (v > q1)::INT + (v > q2)::INT AS a FROM {source} JOIN cuts USING (series_id, channel))),
words AS (SELECT *, sum(c) OVER (PARTITION BY series_id, channel) AS m FROM (
      SELECT series_id, channel, a, b, count(*) AS c FROM coded WHERE b IS NOT NULL GROUP BY ALL))"""


TAU = """thin AS (SELECT p.series_id, p.channel, t // tau AS t, v FROM pts p JOIN (
  SELECT series_id, channel, coalesce(min(CASE WHEN ac <= 0 THEN k END), any_value(n)) AS tau FROM acf GROUP BY ALL) USING (series_id, channel) WHERE t % tau = 0)"""


@query(
    "l1_transition",
    sql(
        [WEEKLY, pts("weekly"), STATS, ACF, TAU, terciles("thin")],
        """SELECT series_id, channel, sum(v) AS SB_TransitionMatrix_3ac_sumdiagcov FROM (
  SELECT series_id, channel, b, (sum(p * p) - sum(p) * sum(p) / 3) / 2 AS v FROM (SELECT series_id, channel, b, c / m AS p FROM words) GROUP BY series_id, channel, b) GROUP BY ALL""",
        ["SB_TransitionMatrix_3ac_sumdiagcov"],
    ),
)
def l1(spark, d):
    points = base.weekly(spark, d)
    return rounded(symbolic.transition(points, autocorr.lag_sums(points, longest=base.WEEKS)))


@query(
    "l16_motif_entropy",
    sql([WEEKLY, pts("weekly"), terciles("pts")], "SELECT series_id, channel, -sum(c / m * ln(c / m)) AS SB_MotifThree_quantile_hh FROM words GROUP BY ALL", ["SB_MotifThree_quantile_hh"]),
)
def l16(spark, d):
    return rounded(symbolic.motif_entropy(base.weekly(spark, d), longest=base.WEEKS))


def timing(sign, name):
    return f"""z AS (SELECT series_id, channel, t, n, (v - mean) / sd * {sign} AS z FROM pts JOIN stats USING (series_id, channel)),
med AS (SELECT series_id, channel, j, any_value(n) AS n, count(*) AS m, (median(t) + 1) / (any_value(n) / 2) - 1 AS x
  FROM z, range(2000) r(j) WHERE z >= j * 0.01::DOUBLE GROUP BY series_id, channel, j),
kept AS (SELECT med.* FROM med JOIN (SELECT series_id, channel, m AS tot FROM med WHERE j = 0) USING (series_id, channel) WHERE (m - 1) * 100.0 / tot > 2 OR j = 0),
timing AS (SELECT series_id, channel, median(x) AS {name} FROM kept GROUP BY ALL)"""


for _id, _sign, _letter in (("l2", 1, "p"), ("l3", -1, "n")):
    _name = f"DN_OutlierInclude_{_letter}_001_mdrmd"

    def _run(spark, d, sign=_sign):
        return rounded(symbolic.outlier_timing(base.weekly(spark, d), sign))

    query(f"{_id}_outlier_timing", sql([WEEKLY, pts("weekly"), STATS, timing(_sign, _name)], "FROM timing", [_name]))(_run)


def modes(k):
    return f"""(SELECT series_id, channel, avg(lo + (hi - lo) / {k} * (i + 0.5)) AS DN_HistogramMode_{k} FROM (
  SELECT *, max(c) OVER (PARTITION BY series_id, channel) AS top FROM (
    SELECT series_id, channel, any_value(lo) AS lo, any_value(hi) AS hi, least(floor((z - lo) / ((hi - lo) / {k})), {k} - 1) AS i, count(*) AS c FROM z GROUP BY series_id, channel, i)) WHERE c = top GROUP BY ALL)"""


Z = "z AS (SELECT series_id, channel, t, n, (v - mean) / sd AS z, (vmin - mean) / sd AS lo, (vmax - mean) / sd AS hi FROM pts JOIN stats USING (series_id, channel))"
NEAT = """steps AS (SELECT *, CASE WHEN 10 * base - cell < 1.5 * (cell - five) THEN 10 * base ELSE five END AS step FROM (
  SELECT *, CASE WHEN 5 * base - cell < 2.75 * (cell - two) THEN 5 * base ELSE two END AS five FROM (
    SELECT *, CASE WHEN 2 * base - cell < 1.5 * (cell - base) THEN 2 * base ELSE base END AS two FROM (
      SELECT *, pow(10.0, floor(log10((hi - lo) / 10))) AS base, (hi - lo) / 10 AS cell FROM z)))),
neat AS (SELECT series_id, channel, min((j + 0.5) * step) AS histogram_mode FROM (
  SELECT *, max(c) OVER (PARTITION BY series_id, channel) AS top FROM (
    SELECT series_id, channel, any_value(step) AS step, greatest(ceil(round(z / step, 7)) - 1, floor(lo / step + 1e-7)) AS j, count(*) AS c FROM steps GROUP BY series_id, channel, j)) WHERE c = top GROUP BY ALL)"""


@query("l4_histogram_modes", sql([WEEKLY, pts("weekly"), STATS, Z], f"SELECT * FROM {modes(5)} JOIN {modes(10)} USING (series_id, channel)", ["DN_HistogramMode_5", "DN_HistogramMode_10"]))
def l4(spark, d):
    return rounded(symbolic.histogram_modes(base.weekly(spark, d)).drop("histogram_mode"))


@query("l32_histogram_mode", sql([WEEKLY, pts("weekly"), STATS, Z, NEAT], "FROM neat", ["histogram_mode"]))
def l32(spark, d):
    return rounded(symbolic.histogram_modes(base.weekly(spark, d)).select(*KEY, "histogram_mode"))


@query(
    "l7_lag2_information",
    sql(
        [WEEKLY, pts("weekly"), STATS, Z, """cells AS (SELECT series_id, channel, a, b, count(*) AS c FROM (
  SELECT series_id, channel, floor((z - lo + 0.1) / ((hi - lo + 0.2) / 5)) AS a,
    lead(floor((z - lo + 0.1) / ((hi - lo + 0.2) / 5)), 2) OVER (PARTITION BY series_id, channel ORDER BY t) AS b FROM z) WHERE b IS NOT NULL GROUP BY ALL)"""],
        """SELECT series_id, channel, sum(c / m * ln(c * m / (ca * cb))) AS CO_HistogramAMI_even_2_5 FROM (
  SELECT *, sum(c) OVER (PARTITION BY series_id, channel, a) AS ca, sum(c) OVER (PARTITION BY series_id, channel, b) AS cb, sum(c) OVER (PARTITION BY series_id, channel) AS m FROM cells) GROUP BY ALL""",
        ["CO_HistogramAMI_even_2_5"],
    ),
)
def l7(spark, d):
    return rounded(symbolic.lag2_information(base.weekly(spark, d)))


STOPS = """marks AS (SELECT series_id, channel, t, v, mean, n, lead(v) OVER (PARTITION BY series_id, channel ORDER BY t) AS next FROM pts JOIN stats USING (series_id, channel)),
high AS (SELECT series_id, channel, max(t - p) AS g FROM (SELECT *, coalesce(lag(t) OVER (PARTITION BY series_id, channel ORDER BY t), 0) AS p FROM marks
  WHERE t < n - 1 AND (v <= mean OR t = n - 2)) GROUP BY ALL),
down AS (SELECT series_id, channel, max(t - p) AS h FROM (SELECT *, coalesce(lag(t) OVER (PARTITION BY series_id, channel ORDER BY t), 0) AS p FROM marks
  WHERE t < n - 1 AND (next >= v OR t = n - 2)) GROUP BY ALL)"""


@query(
    "l10_long_stretches",
    sql(
        [WEEKLY, pts("weekly"), STATS, STOPS],
        "SELECT series_id, channel, CAST(g AS DOUBLE) AS SB_BinaryStats_mean_longstretch1, CAST(h AS DOUBLE) AS SB_BinaryStats_diff_longstretch0 FROM high JOIN down USING (series_id, channel)",
        ["SB_BinaryStats_mean_longstretch1", "SB_BinaryStats_diff_longstretch0"],
    ),
)
def l10(spark, d):
    return rounded(symbolic.long_stretches(base.weekly(spark, d), longest=base.WEEKS))


@query(
    "l25_flat_spots",
    sql(
        [HOURLY, pts("hourly"), STATS],
        """SELECT series_id, channel, CAST(max(c) AS BIGINT) AS flat_spots FROM (SELECT series_id, channel, run, count(*) AS c FROM (
  SELECT *, sum(CASE WHEN g = pg THEN 0 ELSE 1 END) OVER (PARTITION BY series_id, channel ORDER BY t) AS run FROM (
    SELECT *, lag(g) OVER (PARTITION BY series_id, channel ORDER BY t) AS pg FROM (
      SELECT series_id, channel, t, greatest(ceil((v - vmin) / ((vmax - vmin) / 10)), 1) AS g FROM pts JOIN stats USING (series_id, channel)))) GROUP BY ALL) GROUP BY ALL""",
        [],
        ["flat_spots"],
    ),
)
def l25(spark, d):
    return rounded(symbolic.flat_spots(base.hourly(spark, d)))
