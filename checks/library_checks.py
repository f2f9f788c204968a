"""The remaining library features."""

from pyspark.sql import functions as F

from seriesprep.operators import autocorr, library, spectrum

from . import base
from .autocorr_checks import ACF
from .base import HOURLY, STATS, WEEKLY, pts, query, regression, rounded, sql
from .spectrum_checks import AMP

Z = "z AS (SELECT series_id, channel, t, n, (v - mean) / sd AS v FROM pts JOIN stats USING (series_id, channel))"
BASIS = [WEEKLY, pts("weekly"), STATS, Z]


@query(
    "l28_tile_features",
    sql(
        BASIS,
        """SELECT series_id, channel, var_samp(s) AS lumpiness, var_samp(m) AS stability FROM (
  SELECT series_id, channel, t // 10 AS w, var_samp(v) AS s, avg(v) AS m FROM z GROUP BY ALL HAVING count(*) = 10) GROUP BY ALL""",
        ["lumpiness", "stability"],
    ),
)
def l28(spark, d):
    return rounded(library.tile_features(base.weekly(spark, d)))


@query(
    "l19_shift_features",
    sql(
        [*BASIS, """roll AS (SELECT series_id, channel, t, CASE WHEN count(v) OVER w = 10 THEN avg(v) OVER w END AS m, CASE WHEN count(v) OVER w = 10 THEN var_samp(v) OVER w END AS s
  FROM z WINDOW w AS (PARTITION BY series_id, channel ORDER BY t ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)),
gap AS (SELECT series_id, channel, t, round(abs(lead(m, 10) OVER w - m), 9) AS dm, round(abs(lead(s, 10) OVER w - s), 9) AS ds FROM roll WINDOW w AS (PARTITION BY series_id, channel ORDER BY t))"""],
        """SELECT * FROM (SELECT series_id, channel, dm AS max_level_shift, CAST(t + 10 AS DOUBLE) AS time_level_shift FROM gap QUALIFY row_number() OVER (PARTITION BY series_id, channel ORDER BY dm DESC NULLS LAST, t) = 1)
  JOIN (SELECT series_id, channel, ds AS max_var_shift, CAST(t + 10 AS DOUBLE) AS time_var_shift FROM gap QUALIFY row_number() OVER (PARTITION BY series_id, channel ORDER BY ds DESC NULLS LAST, t) = 1) USING (series_id, channel)""",
        ["max_level_shift", "time_level_shift", "max_var_shift", "time_var_shift"],
    ),
)
def l19(spark, d):
    return rounded(library.shift_features(base.weekly(spark, d)))


@query(
    "l24_spectral_entropy",
    sql(
        [HOURLY, pts("hourly"), STATS, AMP],
        """SELECT series_id, channel, least(1, -sum(2 * f * ln(f)) / ln(any_value(m))) AS entropy FROM (
  SELECT series_id, channel, m, amp * amp / (2 * s) * 0.999 + 0.001 / m AS f FROM (
    SELECT *, sum(amp * amp) OVER (PARTITION BY series_id, channel) AS s, 2 * count(*) OVER (PARTITION BY series_id, channel) AS m FROM amp WHERE k > 0)) GROUP BY ALL""",
        ["entropy"],
    ),
)
def l24(spark, d):
    return rounded(library.spectral_entropy(spectrum.spectrum(base.hourly(spark, d), longest=base.HOURS)))


@query(
    "l27_log_periodogram",
    sql(
        [HOURLY, pts("hourly"), STATS, AMP],
        """SELECT series_id, channel, 0.5 + regr_slope(ln(amp * amp), -2 * ln(2 * sin(pi() * k / n))) AS hurst FROM amp WHERE k BETWEEN 1 AND floor(sqrt(n)) AND amp > 0 GROUP BY series_id, channel""",
        ["hurst"],
    ),
)
def l27(spark, d):
    return rounded(library.log_periodogram(spectrum.spectrum(base.hourly(spark, d), longest=base.HOURS)))


@query(
    "l36_box_cox",
    sql(
        [WEEKLY, pts("weekly"), STATS],
        """SELECT series_id, channel, arg_min(lam, cv * 1000000 + lam) AS lambdas FROM (
  SELECT series_id, channel, lam, round(stddev_samp(s * pow(m, lam - 1)) / avg(s * pow(m, lam - 1)), 12) AS cv FROM (
    SELECT series_id, channel, (t - n % 2) // 2 AS pair, avg(v) AS m, stddev_samp(v) AS s, any_value(vmin) AS vmin FROM pts JOIN stats USING (series_id, channel)
    WHERE t >= n % 2 GROUP BY ALL HAVING avg(v) > 0), (SELECT round(-1 + 0.1 * i, 1)::DOUBLE AS lam FROM range(31) r(i))
  WHERE vmin > 0 OR lam >= 0 GROUP BY series_id, channel, lam) GROUP BY ALL""",
        ["lambdas"],
    ),
)
def l36(spark, d):
    return rounded(library.box_cox(base.weekly(spark, d)))


DACF = """d1 AS (SELECT series_id, channel, t - 1 AS t, d AS v FROM (SELECT *, v - lag(v) OVER (PARTITION BY series_id, channel ORDER BY t) AS d FROM pts) WHERE d IS NOT NULL),
dacf AS (SELECT a.series_id, a.channel, b.t - a.t AS k, sum((a.v - m) * (b.v - m)) AS ac FROM d1 a JOIN d1 b ON a.series_id = b.series_id AND a.channel = b.channel AND b.t >= a.t
  JOIN (SELECT series_id, channel, avg(v) AS m FROM d1 GROUP BY ALL) s ON s.series_id = a.series_id AND s.channel = a.channel GROUP BY a.series_id, a.channel, b.t - a.t)"""


@query(
    "l14_residual_tau_ratio",
    sql(
        [WEEKLY, pts("weekly"), STATS, ACF, DACF],
        """SELECT series_id, channel, a / b AS FC_LocalSimple_mean1_tauresrat
  FROM (SELECT series_id, channel, coalesce(min(CASE WHEN ac <= 0 THEN k END), max(k) + 1) AS a FROM dacf GROUP BY ALL)
  JOIN (SELECT series_id, channel, coalesce(min(CASE WHEN ac <= 0 THEN k END), max(k) + 1) AS b FROM acf GROUP BY ALL) USING (series_id, channel)""",
        ["FC_LocalSimple_mean1_tauresrat"],
    ),
)
def l14(spark, d):
    points = base.weekly(spark, d)
    return rounded(library.residual_tau_ratio(points, autocorr.lag_sums(points, longest=base.WEEKS)))


EMBED = """tau AS (SELECT series_id, channel, any_value(n) AS n, least(coalesce(min(CASE WHEN ac <= 0 THEN k END), any_value(n)), any_value(n) // 10) AS tau FROM acf GROUP BY series_id, channel),
step AS (SELECT series_id, channel, t, pow(lead(v) OVER (PARTITION BY series_id, channel ORDER BY t) - v, 2) AS q FROM z),
dist AS (SELECT a.series_id, a.channel, sqrt(a.q + b.q) AS d FROM step a JOIN tau USING (series_id, channel)
  JOIN step b ON b.series_id = a.series_id AND b.channel = a.channel AND b.t = a.t + tau WHERE a.t < n - tau - 1),
shape AS (SELECT series_id, channel, count(*) AS m, avg(d) AS l, min(d) AS lo, max(d) AS hi, CAST(ceil((max(d) - min(d)) / (3.5 * stddev_samp(d) / pow(count(*), 1.0 / 3))) AS BIGINT) AS bins FROM dist GROUP BY ALL),
slots AS (SELECT series_id, channel, least(CAST(floor((d - lo) / ((hi - lo) / bins)) AS BIGINT), bins - 1) AS j, count(*) AS c FROM dist JOIN shape USING (series_id, channel) GROUP BY ALL)"""


@query(
    "l12_embedding_misfit",
    sql(
        [*BASIS, ACF, EMBED],
        """SELECT s.series_id, s.channel, avg(abs(coalesce(c, 0) / m - exp(-(lo + (hi - lo) / bins * (r.j + 0.5)) / l) / l)) AS CO_Embed2_Dist_tau_d_expfit_meandiff
  FROM shape s JOIN range(1000) r(j) ON r.j < s.bins LEFT JOIN slots x ON x.series_id = s.series_id AND x.channel = s.channel AND x.j = r.j GROUP BY ALL""",
        ["CO_Embed2_Dist_tau_d_expfit_meandiff"],
    ),
)
def l12(spark, d):
    return rounded(library.embedding_misfit(base.weekly(spark, d)))


def _rows(name, fn, digits=6, oracle=None):
    @query(name, oracle)
    def run(spark, d):
        return rounded(fn(base.weekly(spark, d)), digits)


SERIES = "OVER (PARTITION BY series_id, channel ORDER BY t)"
SQUARES = "SELECT series_id, channel, t, v * v AS y, " + ", ".join(f"lag(v * v, {k}) {SERIES} AS x{k}" for k in range(1, 13)) + " FROM z"
POWERS = f"SELECT *, x1 * x1 AS x2, x1 * x1 * x1 AS x3 FROM (SELECT series_id, channel, t, v AS y, lag(v) {SERIES} AS x1 FROM z)"


SPLINE = """SELECT series_id, channel, t, v AS y, x, x * x AS x2, x * x * x AS x3, pow(greatest(x - (n // 2 - 1) / half + 1, 0), 3) AS u3 FROM (
  SELECT *, greatest((n - 1) / 2, 1) AS half, t / greatest((n - 1) / 2, 1) - 1 AS x FROM z)"""
WANG = [
    *regression("spline", ["x", "x2", "x3", "u3"], SPLINE),
    """wang AS (SELECT a.series_id, a.channel, b.t - a.t AS k, sum(a.y * b.y) / count(*) AS ac FROM spline_4 a JOIN spline_4 b ON a.series_id = b.series_id AND a.channel = b.channel AND b.t > a.t
  JOIN stats s ON s.series_id = a.series_id AND s.channel = a.channel AND b.t - a.t <= ceil(n / 3) GROUP BY a.series_id, a.channel, b.t - a.t)""",
    "beside AS (SELECT *, lag(ac) OVER w AS p, lead(ac) OVER w AS x FROM wang WINDOW w AS (PARTITION BY series_id, channel ORDER BY k))",
    "trough AS (SELECT *, last_value(CASE WHEN ac < p AND ac < x THEN ac END IGNORE NULLS) OVER (PARTITION BY series_id, channel ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low FROM beside)",
]
_rows("l11_periodicity", library.periodicity, oracle=sql([*BASIS, *WANG], """SELECT s.series_id, s.channel, CASE WHEN s.sd > 0 THEN CAST(coalesce(f.k - 1, 0) AS DOUBLE) END AS PD_PeriodicityWang_th0_01 FROM stats s LEFT JOIN (
  SELECT series_id, channel, min(k) AS k FROM trough WHERE ac > p AND ac > x AND ac - low >= 0.01 AND ac >= 0 GROUP BY ALL) f USING (series_id, channel)""", ["PD_PeriodicityWang_th0_01"]))

WELCH = """padded AS (SELECT *, CAST(pow(2, ceil(log2(n))) AS BIGINT) AS size FROM z),
power AS (SELECT series_id, channel, size, k, n,
    (pow(sum(v * cos(2 * pi() * ((k * t) % size) / size)), 2) + pow(sum(v * sin(2 * pi() * ((k * t) % size) / size)), 2))
      / n / (2 * pi()) * CASE WHEN k = 0 OR k = size // 2 THEN 1 ELSE 2 END AS sw
  FROM padded, range(300) r(k) WHERE k <= size // 2 GROUP BY series_id, channel, size, k, n),
summed AS (SELECT *, sum(sw) OVER (PARTITION BY series_id, channel ORDER BY k) AS part, sum(sw) OVER (PARTITION BY series_id, channel) AS total FROM power)"""


@query(
    "l15_welch_features",
    sql(
        [*BASIS, WELCH],
        """SELECT series_id, channel, sum(CASE WHEN k < (size // 2 + 1) // 5 THEN sw ELSE 0 END) * any_value(2 * pi() / size) AS SP_Summaries_welch_rect_area_5_1,
    min(CASE WHEN part > total / 2 THEN k END) * any_value(2 * pi() / size) AS SP_Summaries_welch_rect_centroid FROM summed GROUP BY series_id, channel""",
        ["SP_Summaries_welch_rect_area_5_1", "SP_Summaries_welch_rect_centroid"],
    ),
)
def l15(spark, d):
    return rounded(library.welch_features(base.weekly(spark, d), longest=base.WEEKS))


FLUCTUATION = [
    "taus AS (SELECT DISTINCT n, CAST(floor(exp(ln(5) + i * (ln(n // 2) - ln(5)) / 49) + 0.5) AS BIGINT) AS tau FROM (SELECT DISTINCT n FROM stats), range(50) r(i))",
    """walk AS (SELECT series_id, channel, n, n AS m, 'rs' AS kind, t, sum(v) OVER (PARTITION BY series_id, channel ORDER BY t) AS y FROM z
  UNION ALL
  SELECT series_id, channel, n, n // 2, 'dfa', t // 2, sum(v) OVER (PARTITION BY series_id, channel ORDER BY t) FROM z WHERE t % 2 = 0 AND t < n // 2 * 2)""",
    "win AS (SELECT series_id, channel, kind, tau, t // tau AS w, t % tau AS x, y FROM walk JOIN taus USING (n) WHERE t // tau < m // tau)",
    "line AS (SELECT series_id, channel, kind, tau, w, regr_slope(y, x) AS b, avg(x) AS mx, avg(y) AS my FROM win GROUP BY ALL)",
    """rest AS (SELECT series_id, channel, kind, tau, w, CASE kind WHEN 'rs' THEN pow(max(r) - min(r), 2) ELSE avg(r * r) END AS q FROM (
  SELECT series_id, channel, kind, tau, w, y - my - b * (x - mx) AS r FROM win JOIN line USING (series_id, channel, kind, tau, w)) GROUP BY series_id, channel, kind, tau, w)""",
    """scale AS (SELECT *, row_number() OVER o AS k, count(*) OVER (PARTITION BY series_id, channel, kind) AS m FROM (
  SELECT series_id, channel, kind, ln(tau) AS a, ln(sqrt(avg(q))) AS b FROM rest GROUP BY series_id, channel, kind, tau) WINDOW o AS (PARTITION BY series_id, channel, kind ORDER BY a))""",
    """cost AS (SELECT series_id, channel, kind, m, i,
    sqrt(greatest(regr_syy(b, a) FILTER (k <= i) - pow(regr_sxy(b, a) FILTER (k <= i), 2) / regr_sxx(b, a) FILTER (k <= i), 0))
  + sqrt(greatest(regr_syy(b, a) FILTER (k >= i) - pow(regr_sxy(b, a) FILTER (k >= i), 2) / regr_sxx(b, a) FILTER (k >= i), 0)) AS c
  FROM scale, range(6, 60) r(i) WHERE i <= m - 6 GROUP BY series_id, channel, kind, m, i)""",
    "share AS (SELECT series_id, channel, kind, arg_min(i, c) / any_value(m) AS x FROM cost GROUP BY series_id, channel, kind)",
]
_rows("l17_fluctuation", library.fluctuation, oracle=sql([*BASIS, *FLUCTUATION], """SELECT s.series_id, s.channel,
    CASE WHEN s.sd > 0 THEN coalesce(a.x, 0) END AS SC_FluctAnal_2_rsrangefit_50_1_logi_prop_r1,
    CASE WHEN s.sd > 0 THEN coalesce(b.x, 0) END AS SC_FluctAnal_2_dfa_50_1_2_logi_prop_r1
  FROM stats s LEFT JOIN share a ON (s.series_id, s.channel, 'rs') = (a.series_id, a.channel, a.kind)
  LEFT JOIN share b ON (s.series_id, s.channel, 'dfa') = (b.series_id, b.channel, b.kind)""",
    ["SC_FluctAnal_2_rsrangefit_50_1_logi_prop_r1", "SC_FluctAnal_2_dfa_50_1_2_logi_prop_r1"]))
DENSITY = [
    """setup AS (SELECT series_id, channel, any_value(n) AS n, min(v) AS low, max(v) AS high,
    0.9 * pow(any_value(n), -0.2) * CASE WHEN quantile_cont(v, 0.75) > quantile_cont(v, 0.25) THEN least(stddev_samp(v), (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) / 1.34) ELSE stddev_samp(v) END AS bw
  FROM z GROUP BY series_id, channel HAVING any_value(n) > 20)""",
    """dens AS (SELECT series_id, channel, z.t, i, high - low AS width, s.n, avg(greatest(exp(-pow((low + i * (high - low) / 99 - v) / bw, 2) / 2) / (bw * sqrt(2 * pi())), exp(-722) / sqrt(2 * pi())))
    OVER (PARTITION BY series_id, channel, i ORDER BY z.t ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS m FROM z JOIN setup s USING (series_id, channel), range(100) r(i))""",
    """kl AS (SELECT series_id, channel, t, any_value(n) AS n, CASE WHEN t >= 9 THEN sum(m * (ln(m) - ln(x))) * any_value(width) / 99 ELSE 0 END AS d FROM (
  SELECT *, lead(m, 10) OVER (PARTITION BY series_id, channel, i ORDER BY t) AS x FROM dens) GROUP BY series_id, channel, t)""",
    "step AS (SELECT series_id, channel, t, lead(d) OVER (PARTITION BY series_id, channel ORDER BY t) - d AS gap FROM kl WHERE t <= n - 11)",
]
_rows("l18_density_shift", library.density_shift, oracle=sql([*BASIS, *DENSITY], """SELECT s.series_id, s.channel, f.gap AS max_kl_shift, CAST(f.t + 10 AS DOUBLE) AS time_kl_shift FROM stats s LEFT JOIN (
  SELECT * FROM step WHERE gap IS NOT NULL QUALIFY row_number() OVER (PARTITION BY series_id, channel ORDER BY gap DESC, t) = 1) f USING (series_id, channel)""", ["max_kl_shift", "time_kl_shift"]))
_rows("l22_arch_statistic", library.arch_statistic, oracle=sql([*BASIS, *regression("sq", [f"x{k}" for k in range(1, 13)], SQUARES)], """SELECT s.series_id, s.channel, f.arch_stat FROM stats s LEFT JOIN (
  SELECT series_id, channel, 1 - sum(y * y) FILTER (step = 12) / sum(y * y) FILTER (step = 0) AS arch_stat FROM sq_fit GROUP BY ALL) f USING (series_id, channel)""", ["arch_stat"]))
HOLT = [
    "grid AS (SELECT i / 10 AS alpha, j / 10 AS beta FROM range(1, 11) r(i), range(0, 11) s(j) WHERE j <= i)",
    """holt AS (SELECT a.series_id, a.channel, alpha, beta, a.t, a.v AS l, a.v - b.v AS s, 0.0::DOUBLE AS sse
    FROM z a JOIN z b ON a.series_id = b.series_id AND a.channel = b.channel AND a.t = 1 AND b.t = 0, grid WHERE a.n >= 3
  UNION ALL
  SELECT h.series_id, h.channel, alpha, beta, z.t, l + s + alpha * (v - l - s), s + alpha * beta * (v - l - s), sse + (v - l - s) * (v - l - s)
    FROM holt h JOIN z ON h.series_id = z.series_id AND h.channel = z.channel AND z.t = h.t + 1)""",
]
_rows("l26_holt_parameters", library.holt_parameters, oracle=sql(["RECURSIVE " + WEEKLY, *BASIS[1:], *HOLT], """SELECT s.series_id, s.channel, f.alpha, f.beta FROM stats s LEFT JOIN (
  SELECT series_id, channel, alpha, beta FROM holt JOIN stats USING (series_id, channel) WHERE t = n - 1
  QUALIFY row_number() OVER (PARTITION BY series_id, channel ORDER BY sse, alpha, beta) = 1) f USING (series_id, channel)""", ["alpha", "beta"]))
_rows("l29_nonlinearity", library.nonlinearity, oracle=sql([*BASIS, *regression("nl", ["x1", "x2", "x3"], POWERS)], """SELECT s.series_id, s.channel, f.nonlinearity FROM stats s LEFT JOIN (
  SELECT series_id, channel, m * ln(a / b) * 10 / (m + 1) AS nonlinearity FROM (
    SELECT series_id, channel, count(*) FILTER (step = 0) AS m, sum(y * y) FILTER (step = 1) AS a, sum(y * y) FILTER (step = 3) AS b FROM nl_fit GROUP BY ALL)) f
  USING (series_id, channel)""", ["nonlinearity"]))
_rows("l33_walker_crossing", library.walker_crossing, oracle=sql(BASIS, """SELECT s.series_id, s.channel, f.c / (s.n - 1) AS walker_propcross FROM stats s LEFT JOIN (
  SELECT series_id, channel, CAST(count(*) FILTER ((pw - pv) * (w - v) < 0) AS DOUBLE) AS c FROM (
    SELECT *, lag(w) OVER o AS pw, lag(v) OVER o AS pv FROM (
      SELECT a.series_id, a.channel, a.t, a.v, coalesce(sum(0.1::DOUBLE * pow(0.9::DOUBLE, a.t - 1 - b.t) * b.v), 0) AS w
      FROM z a LEFT JOIN z b ON a.series_id = b.series_id AND a.channel = b.channel AND b.t < a.t GROUP BY ALL)
    WINDOW o AS (PARTITION BY series_id, channel ORDER BY t)) GROUP BY ALL) f USING (series_id, channel)""", ["walker_propcross"]))
_rows("l34_heterogeneity", library.heterogeneity)
_rows("l35_trend_features", library.trend_features)
