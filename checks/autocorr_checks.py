"""Autocorrelation features and unit roots (L5, L6, L13, L14, L20, L21, L30, L31, MATH10-12)."""

from pyspark.sql import functions as F

from seriesprep.functions import scalars
from seriesprep.layout import KEY
from seriesprep.operators import autocorr, unitroot

from . import base
from .base import HOURLY, STATS, WEEKLY, pts, query, regression, rounded, sql

ACF = """acf AS (
  SELECT a.series_id, a.channel, b.t - a.t AS k, any_value(n) AS n, any_value(sd) AS sd, sum((a.v - mean) * (b.v - mean)) AS s,
    sum((a.v - mean) * (b.v - mean)) / (any_value(sd) * any_value(sd) * (any_value(n) - 1)) AS ac
  FROM pts a JOIN pts b ON a.series_id = b.series_id AND a.channel = b.channel AND b.t >= a.t
  JOIN stats s ON s.series_id = a.series_id AND s.channel = a.channel GROUP BY a.series_id, a.channel, b.t - a.t)"""
BASIS = [WEEKLY, pts("weekly"), STATS, ACF]
NEIGHBOURS = "(SELECT *, lag(ac) OVER w AS p, lead(ac) OVER w AS x FROM acf WINDOW w AS (PARTITION BY series_id, channel ORDER BY k))"


@query("l5_first_1e_crossing", sql(BASIS, f"""SELECT s.series_id, s.channel, coalesce(x.v, s.n) AS CO_f1ecac FROM stats s LEFT JOIN (
  SELECT series_id, channel, arg_min(k - 1 + (exp(-1) - p) / (ac - p), k) AS v FROM {NEIGHBOURS} WHERE k > 0 AND k < n - 1 AND ac < exp(-1) GROUP BY ALL) x USING (series_id, channel)""", ["CO_f1ecac"]))
def l5(spark, d):
    points = base.weekly(spark, d)
    rows = autocorr.acf_features(points, autocorr.lag_sums(points, longest=base.WEEKS), longest=base.WEEKS)
    return rounded(rows.select(*KEY, "CO_f1ecac"))


@query("l6_l31_acf_extrema", sql(BASIS, f"""SELECT s.series_id, s.channel, CAST(coalesce(m.k, s.n) AS DOUBLE) AS CO_FirstMin_ac, CAST(coalesce(m.k, s.n - 1) AS DOUBLE) AS firstmin_ac,
    CAST(coalesce(z.k, 0) AS DOUBLE) AS firstzero_ac
  FROM stats s LEFT JOIN (SELECT series_id, channel, min(k) AS k FROM {NEIGHBOURS} WHERE k > 0 AND ac < p AND ac < x GROUP BY ALL) m USING (series_id, channel)
  LEFT JOIN (SELECT series_id, channel, min(k) AS k FROM acf WHERE ac < 0 GROUP BY ALL) z USING (series_id, channel)""", ["CO_FirstMin_ac", "firstmin_ac", "firstzero_ac"]))
def l6(spark, d):
    points = base.weekly(spark, d)
    rows = autocorr.acf_features(points, autocorr.lag_sums(points, longest=base.WEEKS), longest=base.WEEKS)
    return rounded(rows.drop("CO_f1ecac"))


@query("lag_products", sql([HOURLY, pts("hourly"), STATS, ACF], "FROM acf", ["ac"], ["k"]))
def lag_products(spark, d):
    rows = autocorr.lag_sums(base.hourly(spark, d), longest=base.HOURS)
    ac = F.transform("s", lambda x: x / F.get("s", F.lit(0)))
    return rounded(rows.select(*KEY, F.posexplode(ac).alias("k", "ac")))


def diffs(prefix, source):
    return f"""{prefix} AS (SELECT series_id, channel, t - 1 AS t, d AS v FROM (
      SELECT *, v - lag(v) OVER (PARTITION BY series_id, channel ORDER BY t) AS d FROM {source}) WHERE d IS NOT NULL)"""


def short_acf(name, source):
    return f"""{name} AS (SELECT a.series_id, a.channel, b.t - a.t AS k, sum((a.v - m) * (b.v - m)) / any_value(q) AS ac
      FROM {source} a JOIN {source} b ON a.series_id = b.series_id AND a.channel = b.channel AND b.t - a.t BETWEEN 1 AND 10
      JOIN (SELECT series_id, channel, avg(v) AS m, var_pop(v) * count(*) AS q FROM {source} GROUP BY ALL) s ON s.series_id = a.series_id AND s.channel = a.channel
      GROUP BY a.series_id, a.channel, b.t - a.t)"""


def pick(name, label):
    return (
        f"(SELECT series_id, channel, max(CASE WHEN k = 1 THEN ac END) AS {label}_acf1, sum(ac * ac) AS {label}_acf10 FROM {name} GROUP BY ALL)"
    )


@query(
    "l20_acf_features",
    sql(
        [WEEKLY, pts("weekly"), diffs("d1", "pts"), diffs("d2", "d1"), short_acf("a0", "pts"), short_acf("a1", "d1"), short_acf("a2", "d2")],
        f"SELECT * FROM {pick('a0', 'x')} JOIN {pick('a1', 'diff1')} USING (series_id, channel) JOIN {pick('a2', 'diff2')} USING (series_id, channel)",
        ["x_acf1", "x_acf10", "diff1_acf1", "diff1_acf10", "diff2_acf1", "diff2_acf10"],
    ),
)
def l20(spark, d):
    rows = autocorr.acf_pacf(base.weekly(spark, d))
    return rounded(rows.select(*KEY, *[c for c in rows.columns if "_acf" in c]))


def partial(name, source, label):
    """Durbin-Levinson to order 5, written out order by order."""
    r = ", ".join(f"max(CASE WHEN k = {k} THEN ac END) AS r{k}" for k in range(1, 6))
    inner = f"SELECT series_id, channel, {r}, max(CASE WHEN k = 1 THEN ac END) AS p1_1 FROM {source} GROUP BY ALL"
    for k in range(2, 6):
        top = " - ".join([f"r{k}", *[f"p{k - 1}_{j} * r{k - j}" for j in range(1, k)]])
        low = " - ".join(["1", *[f"p{k - 1}_{j} * r{j}" for j in range(1, k)]])
        inner = f"SELECT *, ({top}) / ({low}) AS p{k}_{k} FROM ({inner})"
        rest = ", ".join(f"p{k - 1}_{j} - p{k}_{k} * p{k - 1}_{k - j} AS p{k}_{j}" for j in range(1, k))
        inner = f"SELECT *, {rest} FROM ({inner})"
    total = " + ".join(f"p{k}_{k} * p{k}_{k}" for k in range(1, 6))
    return f"{name} AS (SELECT series_id, channel, {total} AS {label}_pacf5 FROM ({inner}))"


@query(
    "l21_pacf5",
    sql(
        [WEEKLY, pts("weekly"), diffs("d1", "pts"), diffs("d2", "d1"), short_acf("a0", "pts"), short_acf("a1", "d1"), short_acf("a2", "d2"), partial("p0", "a0", "x"), partial("p1", "a1", "diff1x"), partial("p2", "a2", "diff2x")],
        "SELECT * FROM p0 JOIN p1 USING (series_id, channel) JOIN p2 USING (series_id, channel)",
        ["x_pacf5", "diff1x_pacf5", "diff2x_pacf5"],
    ),
)
def l21(spark, d):
    rows = autocorr.acf_pacf(base.weekly(spark, d))
    return rounded(rows.select(*KEY, *[c for c in rows.columns if "_pacf" in c]))


GAUSS = """info AS (
  SELECT a.series_id, a.channel, b.t - a.t - 1 AS i, any_value(n) AS n, -0.5 * ln(1 - pow(corr(a.v, b.v), 2)) AS ami
  FROM pts a JOIN pts b ON a.series_id = b.series_id AND a.channel = b.channel AND b.t - a.t BETWEEN 1 AND 40
  JOIN stats s ON s.series_id = a.series_id AND s.channel = a.channel GROUP BY a.series_id, a.channel, b.t - a.t)"""


@query(
    "l13_gaussian_information",
    sql(
        [WEEKLY, pts("weekly"), STATS, GAUSS],
        """SELECT s.series_id, s.channel, CAST(coalesce(m.i, 40) AS DOUBLE) AS IN_AutoMutualInfoStats_40_gaussian_fmmi FROM stats s LEFT JOIN (
  SELECT series_id, channel, min(i) AS i FROM (SELECT *, lag(ami) OVER w AS p, lead(ami) OVER w AS x FROM info WINDOW w AS (PARTITION BY series_id, channel ORDER BY i))
  WHERE ami < p AND ami < x GROUP BY ALL) m USING (series_id, channel)""",
        ["IN_AutoMutualInfoStats_40_gaussian_fmmi"],
    ),
)
def l13(spark, d):
    return rounded(autocorr.gaussian_information(base.weekly(spark, d)))


def kpss_cte(lags):
    return f"""kp AS (
  SELECT series_id, channel, n, lags, (q / (n * n)) / ((s0 + 2 * coalesce(w, 0)) / n) AS stat FROM (
    SELECT a.series_id, a.channel, any_value(a.n) AS n, any_value(lags) AS lags, max(CASE WHEN k = 0 THEN s END) AS s0,
      sum(CASE WHEN k BETWEEN 1 AND lags THEN s * (1 - k / (lags + 1.0::DOUBLE)) END) AS w
    FROM acf a JOIN {lags} l ON l.series_id = a.series_id AND l.channel = a.channel GROUP BY a.series_id, a.channel)
  JOIN (SELECT series_id, channel, sum(c * c) AS q FROM (
    SELECT p.series_id, p.channel, sum(v - mean) OVER (PARTITION BY p.series_id, p.channel ORDER BY t ROWS UNBOUNDED PRECEDING) AS c
    FROM pts p JOIN stats s ON s.series_id = p.series_id AND s.channel = p.channel) GROUP BY ALL) USING (series_id, channel))"""


AUTO_LAGS = """auto AS (
  SELECT series_id, channel, least(CAST(floor(1.1447 * pow(pow(s1 / s0, 2), 1.0 / 3) * pow(n, 1.0 / 3)) AS BIGINT), n - 1) AS lags FROM (
    SELECT series_id, channel, any_value(n) AS n, sum(CASE WHEN k = 0 THEN s / n ELSE s / (n / 2) END) AS s0, coalesce(sum(CASE WHEN k > 0 THEN k * s / (n / 2) END), 0) AS s1
    FROM acf WHERE k <= floor(pow(n, 2.0 / 9)) GROUP BY series_id, channel))"""
P = """CASE WHEN stat <= 0.347 THEN 0.1 WHEN stat <= 0.463 THEN 0.1 + (stat - 0.347) * (0.05 - 0.1) / (0.463 - 0.347)
  WHEN stat <= 0.574 THEN 0.05 + (stat - 0.463) * (0.025 - 0.05) / (0.574 - 0.463)
  WHEN stat <= 0.739 THEN 0.025 + (stat - 0.574) * (0.01 - 0.025) / (0.739 - 0.574) ELSE 0.01 END"""


@query("math11_kpss", sql([*BASIS, AUTO_LAGS, kpss_cte("auto")], f"SELECT series_id, channel, stat AS kpss_stat, lags AS kpss_lag, {P} AS kpss_pvalue FROM kp", ["kpss_stat", "kpss_pvalue"], ["kpss_lag"]))
def math11(spark, d):
    points = base.weekly(spark, d)
    return rounded(unitroot.kpss(points, autocorr.lag_sums(points, longest=base.WEEKS)))


SHORT_LAGS = "short AS (SELECT series_id, channel, CAST(floor(4 * pow(n / 100, 0.25)) AS BIGINT) AS lags FROM stats)"
PP = """pp AS (
  SELECT series_id, channel, v AS y, lag(v) OVER (PARTITION BY series_id, channel ORDER BY t) AS x, t - 1 AS t FROM pts)
, fit AS (SELECT series_id, channel, count(*) AS m, regr_slope(y, x) AS rho, regr_intercept(y, x) AS icpt, var_pop(y) AS vy FROM pp WHERE x IS NOT NULL GROUP BY ALL)
, res AS (SELECT series_id, channel, t, y - icpt - rho * x AS e FROM pp JOIN fit USING (series_id, channel) WHERE x IS NOT NULL)
, gam AS (SELECT a.series_id, a.channel, b.t - a.t AS k, sum(a.e * b.e) AS g FROM res a JOIN res b ON a.series_id = b.series_id AND a.channel = b.channel AND b.t - a.t BETWEEN 0 AND 20 GROUP BY ALL)
, zalpha AS (
  SELECT series_id, channel, any_value(m) * (any_value(rho) - 1) - 0.5 * any_value(m) / any_value(vy)
    * sum(CASE WHEN k BETWEEN 1 AND floor(4 * pow(m / 100, 0.25)) THEN 2 * g / m * (1 - k / (floor(4 * pow(m / 100, 0.25)) + 1)) ELSE 0 END) AS unitroot_pp
  FROM gam JOIN fit USING (series_id, channel) GROUP BY ALL)"""


@query(
    "l30_unitroot_statistics",
    sql(
        [*BASIS, SHORT_LAGS, kpss_cte("short"), PP],
        "SELECT series_id, channel, stat AS unitroot_kpss, unitroot_pp FROM kp JOIN zalpha USING (series_id, channel)",
        ["unitroot_kpss", "unitroot_pp"],
        digits=5,
    ),
)
def l30(spark, d):
    points = base.weekly(spark, d)
    return rounded(unitroot.unitroot_stats(points, autocorr.lag_sums(points, longest=base.WEEKS)), 5)


LAGS = 17  # the largest lag tried at the 357 points of the fixture
DELTAS = [f"d{k}" for k in range(1, LAGS + 1)]
SERIES = "OVER (PARTITION BY series_id, channel ORDER BY t)"


def polynomial(coefs):
    return " + ".join(f"{c} * pow(stat, {i})" for i, c in enumerate(coefs))


ADF = [
    f"step AS (SELECT series_id, channel, t, v - lag(v) {SERIES} AS y, lag(v) {SERIES} AS x1 FROM pts JOIN stats USING (series_id, channel) WHERE sd > 0)",
    f"steps AS MATERIALIZED (SELECT *, {', '.join(f'lag(y, {k}) {SERIES} AS d{k}' for k in range(1, LAGS + 1))} FROM step)",
    *regression("tried", ["x1", *DELTAS], "SELECT * FROM steps"),
    """chosen AS (SELECT series_id, channel, arg_min(lag, aic) AS lag FROM (
  SELECT series_id, channel, step - 1 AS lag, count(*) * ln(sum(y * y) / count(*)) + 2 * (step + 1) AS aic FROM tried_fit WHERE step > 0 GROUP BY series_id, channel, step) GROUP BY ALL)""",
    *regression("final", [*DELTAS, "x1"], f"SELECT series_id, channel, t, y, x1, {', '.join(f'CASE WHEN lag >= {k} THEN d{k} ELSE 0 END AS d{k}' for k in range(1, LAGS + 1))} FROM steps JOIN chosen USING (series_id, channel) WHERE t > lag"),
    f"""adf AS (SELECT series_id, channel, lag, sxy / sxx / sqrt((syy - sxy * sxy / sxx) / (m - lag - 2) / sxx) AS stat FROM (
  SELECT series_id, channel, count(*) AS m, sum(x1 * y) AS sxy, sum(x1 * x1) AS sxx, sum(y * y) AS syy FROM final_{LAGS} GROUP BY ALL) JOIN chosen USING (series_id, channel))""",
    f"""level AS (SELECT *, CASE WHEN stat <= {scalars.ADF_SWITCH} THEN {polynomial(scalars.ADF_SMALL)} ELSE {polynomial(scalars.ADF_LARGE)} END AS z FROM adf)""",
    # the normal distribution function by its series in odd powers over double factorials
    f"""adf_p AS (SELECT series_id, channel, any_value(stat) AS stat, any_value(lag) AS lag,
    CASE WHEN any_value(stat) > {scalars.ADF_MAX} THEN 1 WHEN any_value(stat) < {scalars.ADF_MIN} THEN 0 ELSE 0.5 + sign(any_value(z)) * exp(-any_value(z * z) / 2) / sqrt(2 * pi())
      * sum(exp((2 * k + 1) * ln(greatest(abs(z), 1e-300)) - (k + 1) * ln(2) - lgamma(k + 1.5) + ln(pi()) / 2)) END AS p
  FROM level, range(250) r(k) GROUP BY series_id, channel)""",
]


@query("math10_adf", sql([WEEKLY, pts("weekly"), STATS, *ADF], "SELECT s.series_id, s.channel, a.stat AS adf_stat, a.lag AS adf_lag, a.p AS adf_pvalue FROM stats s LEFT JOIN adf_p a USING (series_id, channel)", ["adf_stat", "adf_pvalue"], ["adf_lag"]))
def math10(spark, d):
    return rounded(unitroot.adf(base.weekly(spark, d), longest=base.WEEKS))


@query(
    "math12_stationarity",
    sql(
        [*BASIS, AUTO_LAGS, kpss_cte("auto"), *ADF],
        f"""SELECT series_id, channel, CASE WHEN q IS NOT NULL THEN p END AS adf_pvalue, CASE WHEN p IS NOT NULL THEN q END AS kpss_pvalue,
    CASE WHEN p IS NOT NULL AND q IS NOT NULL THEN p <= 0.05 OR q >= 0.05 END AS stability
  FROM stats LEFT JOIN (SELECT series_id, channel, p FROM adf_p) a USING (series_id, channel) LEFT JOIN (SELECT series_id, channel, {P} AS q FROM kp) k USING (series_id, channel)""",
        ["adf_pvalue", "kpss_pvalue"],
        ["stability"],
    ),
)
def math12(spark, d):
    points = base.weekly(spark, d)
    return rounded(unitroot.stationarity(points, autocorr.lag_sums(points, longest=base.WEEKS)))
