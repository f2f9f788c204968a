"""Small numpy helpers that run on one bounded block per row.

Each one returns either a finished per-block number or a partial that Spark
merges with a ``groupBy``; none of them sees more than one block and its halo.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql.functions import arrow_udf, pandas_udf
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType


def _struct(**fields) -> StructType:
    return StructType([StructField(k, t) for k, t in fields.items()])


LONG, DOUBLE = LongType(), DoubleType()
DOUBLES = ArrayType(DOUBLE)


def _arr(x) -> np.ndarray:
    return np.asarray(x, dtype=float)


# ---------------------------------------------------------------- inversions
def _inversions(x: np.ndarray) -> int:
    """Pairs i < j with x[i] > x[j], one bit of the dense rank at a time."""
    r = np.unique(x, return_inverse=True)[1].astype(np.int64)
    total = 0
    for b in reversed(range(int(r.max()).bit_length() if len(r) else 0)):
        r = r[np.argsort(r >> (b + 1), kind="stable")]
        bit = (r >> b) & 1
        before = np.cumsum(bit) - bit
        head = np.searchsorted(r >> (b + 1), r >> (b + 1), side="left")
        total += int(np.sum((before - before[head])[bit == 0]))
    return total


@pandas_udf(LONG)
def inversion_count(values: pd.Series) -> pd.Series:
    return pd.Series([_inversions(_arr(v)) for v in values], dtype="int64")


@pandas_udf(ArrayType(LONG))
def value_slots(values: pd.Series, splitters: pd.Series) -> pd.Series:
    """Slot of every value among ascending splitters: 2i strictly between two of them, 2i + 1 on the i-th one."""
    out = []
    for v, s in zip(values, splitters):
        x, cuts = _arr(v), np.unique(_arr(s))
        below = np.searchsorted(cuts, x, "left")
        out.append(below + np.searchsorted(cuts, x, "right"))
    return pd.Series(out, dtype=object)


# ---------------------------------------------------------------- divergence
def _bin_index(x, unit, lo, step, k):
    """Equal-width bin per value, ``unit`` being (x - lo) / range; the right edge is in the last bin.

    A value within rounding distance of an edge is compared with the edge itself.
    """
    f = unit * k
    i = np.minimum(f.astype(np.int64), k - 1)
    near = np.nonzero(np.abs(f - np.rint(f)) < 1e-6)
    if len(near[0]):
        v, j, a, s = x[near], i[near], lo[near[0], 0], step[near[0], 0]
        j = j - (v < j * s + a)
        i[near] = j + ((v >= (j + 1) * s + a) & (j != k - 1))
    return i


def _counts(x, unit, lo, width, k):
    offset = np.arange(len(x))[:, None] * k
    flat = (_bin_index(x, unit, lo, width / k, k) + offset).ravel()
    return np.bincount(flat, minlength=len(x) * k).reshape(len(x), k)


def best_bins(x: np.ndarray) -> np.ndarray:
    """Bin count per row by leave-one-out risk (Stone 1984), first minimum wins."""
    n = x.shape[1]
    lo = x.min(axis=1, keepdims=True)
    width = x.max(axis=1, keepdims=True) - lo
    unit = (x - lo) / width
    limit = max(100, int(np.sqrt(n)))
    risk = np.empty((limit, len(x)))
    for k in range(1, limit + 1):
        c = _counts(x, unit, lo, width, k).astype(float)
        square = np.einsum("ij,ij->i", c, c)
        risk[k - 1] = (2 - (n + 1) * square / (n * n)) / (width[:, 0] / k)
    k = risk.argmin(axis=0) + 1
    # the bin count follows from the bin width, which can round up to one more bin
    return np.ceil(width[:, 0] / (width[:, 0] / k)).astype(int)


def normal_jsd(x: np.ndarray) -> np.ndarray:
    """Divergence of each row's histogram from the normal curve fitted to the row."""
    x = np.sort(x, axis=1)
    out = np.zeros(len(x))
    mu, sigma = x.mean(axis=1), x.std(axis=1)
    live = np.flatnonzero((sigma > 0) & (x[:, -1] > x[:, 0]))
    if not len(live):
        return out
    bins = best_bins(x[live])
    for k in np.unique(bins):
        idx = live[bins == k]
        rows = x[idx]
        lo = rows[:, :1]
        width = rows[:, -1:] - lo
        h = width / k
        p = _counts(rows, (rows - lo) / width, lo, width, k) / (x.shape[1] * h)
        centre = lo + (np.arange(k) + 0.5) * h
        s = sigma[idx][:, None]
        q = np.exp(-(((centre - mu[idx][:, None]) / s) ** 2) / 2) / (s * np.sqrt(2 * np.pi))
        m = (p + q) / 2
        p, q, m = (a / a.sum(axis=1, keepdims=True) for a in (p, q, m))
        with np.errstate(divide="ignore", invalid="ignore"):
            left = np.where(p > 0, p * np.log(p / m), 0.0)
            right = np.where(q > 0, q * np.log(q / m), 0.0)
        out[idx] = (left.sum(axis=1) + right.sum(axis=1)) / 2
    return out


def window_jsd_udf(window: int, chunk: int = 1 << 15):
    """UDF: block values -> one divergence per full window of the block."""

    @pandas_udf(DOUBLES)
    def window_jsd(values: pd.Series) -> pd.Series:
        full = [_arr(v)[: len(v) // window * window].reshape(-1, window) for v in values]
        cuts = np.cumsum([len(f) for f in full])
        if not len(cuts) or cuts[-1] == 0:
            return pd.Series([[] for _ in full], dtype=object)
        rows = np.concatenate(full)
        step = max(1, chunk // window)
        jsd = np.concatenate([normal_jsd(rows[i : i + step]) for i in range(0, len(rows), step)])
        return pd.Series(np.split(jsd, cuts[:-1]), dtype=object)

    return window_jsd


# ------------------------------------------------------- spectrum, lag products
@pandas_udf(DOUBLES)
def amplitudes(values: pd.Series) -> pd.Series:
    """2|F_k|/n for k < n // 2, mean kept."""
    out = []
    for v in values:
        x = _arr(v)
        out.append(np.abs(np.fft.rfft(x))[: len(x) // 2] * (2.0 / max(len(x), 1)))
    return pd.Series(out, dtype=object)


@pandas_udf(ArrayType(_struct(re=DOUBLE, im=DOUBLE)))
def transform_cells(cells: pd.Series, length: pd.Series) -> pd.Series:
    """Discrete Fourier transform of sparse cells (i, re, im) of the given length."""
    out = []
    for c, size in zip(cells, length):
        z = np.zeros(int(size), dtype=complex)
        for x in c:
            z[x["i"]] = complex(x["re"], x["im"])
        out.append([{"re": f.real, "im": f.imag} for f in np.fft.fft(z)])
    return pd.Series(out, dtype=object)


@pandas_udf(DOUBLES)
def lag_products(left: pd.Series, right: pd.Series, mean: pd.Series, first: pd.Series, count: pd.Series) -> pd.Series:
    """Sum over t of (left[t]-m)(right[t+k]-m) for k = first .. first+count-1."""
    out = []
    for a, b, m, f, c in zip(left, right, mean, first, count):
        out.append(_lag_products(_arr(a) - m, _arr(b) - m, int(f), int(c)))
    return pd.Series(out, dtype=object)


def _lag_products(a: np.ndarray, b: np.ndarray, f: int, c: int) -> np.ndarray:
    size = 1 << int(len(a) + len(b)).bit_length()
    if c <= 64:
        return np.array([np.dot(a[: max(len(b) - k, 0)], b[k : k + len(a)]) for k in range(f, f + c)])
    return np.fft.irfft(np.conj(np.fft.rfft(a, size)) * np.fft.rfft(b, size), size)[f : f + c]


# ------------------------------------------------------- seasonal-trend split
def _tricube(pos: float, left: int, right: int, q: int, n: int, span: float) -> np.ndarray:
    """Local-linear weights at ``pos`` for points left..right (Cleveland et al. 1990)."""
    j = np.arange(left, right + 1, dtype=float)
    h = max(pos - left, right - pos)
    if q > n:
        h += (q - n) // 2
    d = np.abs(j - pos)
    w = np.where(d <= 0.001 * h, 1.0, np.where(d <= 0.999 * h, (1 - (d / max(h, 1e-300)) ** 3) ** 3, 0.0))
    w /= w.sum()
    centre = np.dot(w, j)
    spread = np.dot(w, (j - centre) ** 2)
    if h > 0 and np.sqrt(spread) > 0.001 * span:
        w = w * ((pos - centre) / spread * (j - centre) + 1)
    return w


DENSE_WIDTH = 256  # up to this width edge weights are kept as rows; wider ones are summed from moments


@lru_cache(maxsize=512)
def _loess_plan(n: int, q: int, span: float):
    """Edge weight rows and the interior weights of a loess of width q <= DENSE_WIDTH on n points."""
    if n <= q:
        return np.array([_tricube(i, 0, n - 1, q, n, span) for i in range(n)]), None, None
    half = (q - 1) // 2
    head = np.array([_tricube(i, 0, q - 1, q, n, span) for i in range(half)]).reshape(half, q)
    return head, _tricube(half, 0, q - 1, q, n, span), head[::-1, ::-1]


def _edge_fits(y: np.ndarray, count: int, q: int, n: int, span: float) -> np.ndarray:
    """Local-linear fits at positions 0..count-1 of the last axis of ``y``, all of it being the window.

    The weight (1 - (d/h)**3)**3 is a polynomial of degree 9 in the distance on either side, so its sums
    against 1, x, x**2, y and x*y are differences of prefix sums of x**k and x**k * y: no row of weights is formed.
    x runs from -1/2 to 1/2 over the window, which keeps the powers well scaled.
    """
    width = y.shape[-1]
    i = np.arange(count)
    h = np.maximum(i, width - 1 - i) + ((q - n) // 2 if q > n else 0)
    scale = float(max(width - 1, 1))
    x = np.arange(width) / scale - 0.5
    powers = x ** np.arange(12)[:, None]

    def prefix(z: np.ndarray) -> np.ndarray:
        # extended precision: ten powers of a running sum are subtracted from each other
        return np.concatenate([np.zeros((*z.shape[:-1], 1)), np.cumsum(z, axis=-1, dtype=np.longdouble)], axis=-1)

    plain = prefix(powers)
    weighted = [prefix(powers[k] * y) for k in range(11)]
    near, far = np.floor(0.001 * h).astype(np.int64), np.floor(0.999 * h).astype(np.int64)
    clip = lambda j: np.clip(j, 0, width)
    at = x[:count]
    hs = h / scale
    # (first, end, sign): left flank, centre of weight one, right flank
    flanks = [(clip(i - far), clip(i - near), -1.0), (clip(i - near), clip(i + near + 1), 0.0), (clip(i + near + 1), clip(i + far + 1), 1.0)]
    s = [np.zeros(count, np.longdouble) for _ in range(3)]
    t = [np.zeros((*y.shape[:-1], count), np.longdouble) for _ in range(2)]
    for lo, hi, sign in flanks:
        hi = np.maximum(lo, hi)
        steps = [plain[k][hi] - plain[k][lo] for k in range(12)]
        turns = [w[..., hi] - w[..., lo] for w in weighted]
        for r, c in ((0, 1.0), (3, -3.0), (6, 3.0), (9, -1.0)) if sign else ((0, 1.0),):
            for k in range(r + 1):  # binomial terms of (x - at)**r
                f = c * sign**r / hs**r * math.comb(r, k) * (-at) ** (r - k)
                for m in range(3):
                    s[m] += f * steps[k + m]
                for m in range(2):
                    t[m] += f * turns[k + m]
    centre = s[1] / s[0]
    spread = s[2] / s[0] - centre * centre
    tilted = np.sqrt(np.maximum(spread, 0)) * scale > 0.001 * span
    slope = np.where(tilted, (at - centre) / np.where(tilted, spread, 1.0), 0.0)
    return (t[0] / s[0] + slope * (t[1] / s[0] - centre * t[0] / s[0])).astype(float)


def _loess(y: np.ndarray, q: int, span: float) -> np.ndarray:
    """Smooth the last axis of ``y``."""
    n = y.shape[-1]
    if min(n, q) > DENSE_WIDTH:
        return _wide_loess(y, q, span)
    head, mid, tail = _loess_plan(n, q, span)
    if mid is None:
        return y @ head.T
    m = n - q + 1
    if q <= 48:
        inner = sum(w * y[..., k : k + m] for k, w in enumerate(mid))
    else:
        inner = _correlated(y, mid)
    return np.concatenate([y[..., :q] @ head.T, inner, y[..., -q:] @ tail.T], axis=-1)


def _correlated(y: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sums of every full window against the weights."""
    n, q = y.shape[-1], len(weights)
    size = 1 << int(n + q).bit_length()
    spec = np.fft.rfft(y, size) * np.fft.rfft(weights[::-1], size)
    return np.fft.irfft(spec, size)[..., q - 1 : n]


def _wide_loess(y: np.ndarray, q: int, span: float) -> np.ndarray:
    """The same smooth in memory proportional to the series, whatever the width."""
    n = y.shape[-1]
    level = y.mean(axis=-1, keepdims=True)  # fits are exact on constants: less to cancel
    y = y - level
    if n <= q:
        return _edge_fits(y, n, q, n, span) + level
    half = (q - 1) // 2
    head = _edge_fits(y[..., :q], half, q, n, span)
    tail = _edge_fits(y[..., : -q - 1 : -1], half, q, n, span)[..., ::-1]
    return np.concatenate([head, _correlated(y, _tricube(half, 0, q - 1, q, n, span)), tail], axis=-1) + level


def _moving_mean(y: np.ndarray, w: int) -> np.ndarray:
    c = np.cumsum(y, axis=-1)
    c = np.concatenate([np.zeros((*y.shape[:-1], 1)), c], axis=-1)
    return (c[..., w:] - c[..., :-w]) / w


def _cycle_smooth(y: np.ndarray, p: int, q: int, total: int) -> np.ndarray:
    """Smooth every phase of the cycle and extend it by one cycle on both sides."""
    s, n = y.shape
    out = np.empty((s, n + 2 * p))
    whole, rest = divmod(n, p)
    for start, stop, length in ((0, rest, whole + 1), (rest, p, whole)):
        if start == stop:
            continue
        idx = np.arange(start, stop)[:, None] + p * np.arange(length)[None, :]
        sub = y[:, idx]
        span = float(max(total // p - 1 + (start < total % p), 1))
        k = min(q, length)
        ahead = sub[..., :k] @ _tricube(-1, 0, k - 1, q, length, span)
        behind = sub[..., -k:] @ _tricube(k, 0, k - 1, q, length, span)
        body = np.concatenate([ahead[..., None], _loess(sub, q, span), behind[..., None]], axis=-1)
        out[:, np.arange(start, stop)[:, None] + p * np.arange(length + 2)[None, :]] = body
    return out


def _odd(k: int) -> int:
    return k + (k % 2 == 0)


def stl(y: np.ndarray, p: int, total: int | None = None, passes: int = 5):
    """Non-robust seasonal and trend parts of each row of ``y`` at period ``p``.

    Fixed values: seasonal span 7, trend span the next odd number from
    1.5 p / (1 - 1.5/7), low-pass span the next odd number above p, five passes.
    ``total`` is the length of the whole series when ``y`` is a slice of it.
    """
    n = y.shape[1]
    total = total or n
    span = float(total - 1)
    q_trend = _odd(int(np.ceil(1.5 * p / (1 - 1.5 / 7))))
    q_low = _odd(p + 1)
    trend = np.zeros_like(y)
    for _ in range(passes):
        cycle = _cycle_smooth(y - trend, p, 7, total)
        low = _moving_mean(_moving_mean(_moving_mean(cycle, p), p), 3)
        seasonal = cycle[:, p : p + n] - _loess(low, q_low, span)
        trend = _loess(y - seasonal, q_trend, span)
    return seasonal, trend


def stl_reach(p):
    """Observations on each side that can influence a decomposed point."""
    return 30 * p + 40


STL_MOMENTS = ArrayType(_struct(period=LONG, m=LONG, r=DOUBLE, rr=DOUBLE, d=DOUBLE, dd=DOUBLE, s=DOUBLE, ss=DOUBLE))


@pandas_udf(STL_MOMENTS)
def stl_moments(values: pd.Series, periods: pd.Series, head: pd.Series, own: pd.Series, total: pd.Series) -> pd.Series:
    """Mean and centred square sum of remainder, detrended and deseasonalised values.

    ``head`` values before the owned ``own`` ones are halo.  Rows of equal shape
    are decomposed together.
    """
    out = [[] for _ in range(len(values))]
    jobs: dict[tuple, list[int]] = {}
    for i, (v, ps, h, o, n) in enumerate(zip(values, periods, head, own, total)):
        for p in ps:
            jobs.setdefault((int(p), len(v), int(h), int(o), int(n)), []).append(i)
    for (p, size, h, o, n), rows in jobs.items():
        step = max(1, (1 << 17) // size)
        for a in range(0, len(rows), step):
            part = rows[a : a + step]
            y = np.stack([_arr(values.iloc[i]) for i in part])
            seasonal, trend = stl(y, p, n)
            y, seasonal, trend = (z[:, h : h + o] for z in (y, seasonal, trend))
            sets = (y - seasonal - trend, y - trend, y - seasonal)
            means = [z.mean(axis=1) for z in sets]
            sq = [((z - m[:, None]) ** 2).sum(axis=1) for z, m in zip(sets, means)]
            for k, i in enumerate(part):
                out[i].append(
                    {"period": p, "m": o, "r": means[0][k], "rr": sq[0][k], "d": means[1][k],
                     "dd": sq[1][k], "s": means[2][k], "ss": sq[2][k]}
                )
    return pd.Series(out, dtype=object)


@pandas_udf(ArrayType(_struct(seasonal=DOUBLE, trend=DOUBLE)))
def stl_components(values: pd.Series, period: pd.Series, total: pd.Series) -> pd.Series:
    """Seasonal and trend value of every position of the slice."""
    out = []
    for v, p, n in zip(values, period, total):
        s, tr = stl(_arr(v)[None, :], int(p), int(n))
        out.append([{"seasonal": a, "trend": b} for a, b in zip(s[0], tr[0])])
    return pd.Series(out, dtype=object)


# ------------------------------------------------------------- cross products
@pandas_udf(DOUBLES)
def adf_gram(values: pd.Series, lo: pd.Series, start: pd.Series, lags: pd.Series, mean: pd.Series) -> pd.Series:
    """Flat cross-product matrix of [1, x(t-1), dx(t-1..t-lags), dx(t)] over owned t >= lags + 1.

    ``values[0]`` is the observation at ``lo`` and ``start`` the first owned t.
    """
    out = []
    for v, a, s, m, mu in zip(values, lo, start, lags, mean):
        x = _arr(v) - mu
        m, t = int(m), np.arange(max(int(s), int(m) + 1) - int(a), len(x))
        dx = np.diff(x, prepend=x[:1])
        cols = [np.ones(len(t)), x[t - 1], *[dx[t - k] for k in range(1, m + 1)], dx[t]]
        z = np.stack(cols)
        out.append((z @ z.T).ravel())
    return pd.Series(out, dtype=object)


def _ols(g: np.ndarray, k: int):
    """Coefficients and residual square sum of the last column on the first k."""
    xtx, xty = g[:k, :k], g[:k, -1]
    scale = np.sqrt(np.where(np.diag(xtx) > 0, np.diag(xtx), 1.0))
    inv = np.linalg.pinv(xtx / np.outer(scale, scale), rcond=1e-13, hermitian=True) / np.outer(scale, scale)
    b = inv @ xty
    return b, max(g[-1, -1] - 2 * b @ xty + b @ xtx @ b, 0.0), inv


def _nested_ssr(g: np.ndarray) -> np.ndarray:
    """Residual square sums of the last column on the first 2, 3, .. columns."""
    scale = np.sqrt(np.where(np.diag(g) > 0, np.diag(g), 1.0))
    try:
        low = np.linalg.cholesky(g / np.outer(scale, scale))
    except np.linalg.LinAlgError:
        return np.array([_ols(g, k)[1] for k in range(2, len(g))])
    y = low[-1] * scale[-1]
    return g[-1, -1] - np.cumsum(y[:-1] ** 2)[1:]


@pandas_udf(_struct(stat=DOUBLE, lag=LONG))
def adf_solve(gram: pd.Series, head: pd.Series, lags: pd.Series, n: pd.Series, mean: pd.Series) -> pd.DataFrame:
    """Lag by smallest AIC on the common sample, then the t value of the level term.

    ``head`` holds the first ``lags + 1`` observations: with fewer lags the final
    regression also uses the rows the common sample leaves out.
    """
    rows = []
    for g, h, m, size, mu in zip(gram, head, lags, n, mean):
        m, size = int(m), int(size)
        g = _arr(g).reshape(m + 3, m + 3)
        nobs = size - m - 1
        ssr = np.maximum(_nested_ssr(g), 1e-300)
        best = int(np.argmin(nobs * np.log(ssr / nobs) + 2 * np.arange(2, m + 3)))
        keep = [*range(best + 2), m + 2]
        sub = g[np.ix_(keep, keep)].copy()
        x = _arr(h)[: m + 1] - mu
        dx = np.diff(x, prepend=x[:1])
        for t in range(best + 1, min(m + 1, len(x))):
            row = np.array([1.0, x[t - 1], *[dx[t - k] for k in range(1, best + 1)], dx[t]])
            sub += np.outer(row, row)
        b, ssr, inv = _ols(sub, best + 2)
        free = size - best - 1 - (best + 2)
        se = np.sqrt(ssr / free * inv[1, 1]) if free > 0 else 0.0
        rows.append((b[1] / se if se > 0 else None, best))
    return pd.DataFrame(rows, columns=["stat", "lag"])


# ------------------------------------------------------------ outlier timing
@pandas_udf(DOUBLE)
def outlier_timing_whole(values: pd.Series, mean: pd.Series, sd: pd.Series, sign: pd.Series) -> pd.Series:
    """Median over thresholds of the relative time of the median exceeding point of a whole series."""
    out = []
    for v, m, s, g in zip(values, mean, sd, sign):
        n = len(v)
        z = (_arr(v) - m) / s * g if s and s > 0 else np.zeros(n)
        if n == 0 or z.max() < 0.01:
            out.append(0.0 if n else None)
            continue
        q = np.floor(z / 0.01)
        q -= z < q * 0.01
        q += z >= (q + 1) * 0.01
        count = n - np.searchsorted(np.sort(q), np.arange(q.max() + 1), side="left")
        keep = (count - 1) * 100.0 / count[0] > 2
        keep[0] = True
        level, count = np.flatnonzero(keep), count[keep]
        at = np.empty(len(level))
        step = max(1, (1 << 20) // n)
        for a in range(0, len(level), step):
            run = np.cumsum(q[None, :] >= level[a : a + step, None], axis=1, dtype=np.int32)
            c = count[a : a + step, None]
            first = np.argmax(run > (c - 1) // 2, axis=1)
            second = np.argmax(run > c // 2, axis=1)
            at[a : a + step] = (first + second) / 2 + 1
        out.append(float(np.median(at / (n / 2) - 1)))
    return pd.Series(out, dtype=float)


@arrow_udf(ArrayType(_struct(j=LONG, k=LONG, t=LONG)))
def nth_exceeding(level: pa.Array, lo: pa.Array, wanted: pa.Array) -> pa.Array:
    """For each wanted (j, k): the t of the k-th (0-based) point of the block with level >= j.

    A batch stays in flat arrays, 24 bytes a wanted entry, and one level's points are held at a time.
    """
    levels = level.values.fill_null(-1).to_numpy()
    j, k = (wanted.values.field(c).to_numpy() for c in ("j", "k"))
    t = np.empty(len(j), np.int64)
    ends, at = level.offsets.to_numpy(), wanted.offsets.to_numpy()
    for i, first in enumerate(lo.to_numpy()):
        q = levels[ends[i] : ends[i + 1]]
        order = at[i] + np.argsort(j[at[i] : at[i + 1]], kind="stable")
        for same in np.split(order, np.flatnonzero(np.diff(j[order])) + 1) if len(order) else []:
            t[same] = first + np.flatnonzero(q >= j[same[0]])[k[same]]
    return pa.ListArray.from_arrays(wanted.offsets, pa.StructArray.from_arrays([pa.array(x) for x in (j, k, t)], ["j", "k", "t"]))


# -------------------------------------------------------- channel similarity
@pandas_udf(_struct(total=DOUBLE, square=DOUBLE, pairs=LONG))
def tile_similarity(left: pd.Series, right: pd.Series, same: pd.Series) -> pd.DataFrame:
    """Sum and square sum of |a.b| over the vectors of two tiles (i < j inside one tile)."""
    rows = []
    for a, b, s in zip(left, right, same):
        c = np.abs(np.stack([_arr(v) for v in a]) @ np.stack([_arr(v) for v in b]).T)
        c = c[np.triu_indices(len(c), 1)] if s else c.ravel()
        rows.append((float(c.sum()), float((c * c).sum()), len(c)))
    return pd.DataFrame(rows, columns=["total", "square", "pairs"])


# ------------------------------------------------------ regressions on sums
@pandas_udf(DOUBLES)
def nested_residuals(gram: pd.Series, size: pd.Series) -> pd.Series:
    """Residual square sums of the last column on the first 1, 2, .. size-1 columns."""
    out = []
    for g, k in zip(gram, size):
        k = int(k)
        g = _arr(g).reshape(k, k)
        out.append([_ols(g, j)[1] for j in range(1, k)])
    return pd.Series(out, dtype=object)


@pandas_udf(DOUBLES)
def solve_gram(gram: pd.Series, size: pd.Series) -> pd.Series:
    """Coefficients of the last column on all the others."""
    out = []
    for g, k in zip(gram, size):
        k = int(k)
        out.append(_ols(_arr(g).reshape(k, k), k - 1)[0])
    return pd.Series(out, dtype=object)


@pandas_udf(DOUBLES)
def yule_walker(products: pd.Series, n: pd.Series) -> pd.Series:
    """Autoregression coefficients from lag products, order by AIC up to 10 log10(n)."""
    return pd.Series([_yule_walker(_arr(s), int(m)) for s, m in zip(products, n)], dtype=object)


def _yule_walker(s: np.ndarray, m: int) -> np.ndarray:
    r = s / m
    top = min(m - 1, int(10 * np.log10(m)), len(r) - 1) if m > 1 else 0
    best, kept = m * np.log(r[0]), np.array([])
    phi, var = np.array([]), r[0]
    for k in range(1, top + 1):
        last = (r[k] - phi @ r[k - 1 : 0 : -1]) / var
        phi = np.append(phi - last * phi[::-1], last)
        var *= 1 - last * last
        if var <= 0:
            break
        aic = m * np.log(var) + 2 * k
        if aic < best:
            best, kept = aic, phi
    return kept


@pandas_udf(DOUBLES)
def whiten(values: pd.Series, coefs: pd.Series, mean: pd.Series) -> pd.Series:
    """x[t] - sum of coefs[i] x[t-1-i] for every position with a full history, x centred."""
    out = []
    for v, c, m in zip(values, coefs, mean):
        x, c = _arr(v) - m, _arr(c)
        out.append(np.convolve(x, np.append(1.0, -c), mode="valid") if len(x) > len(c) else [])
    return pd.Series(out, dtype=object)


# ------------------------------------------------------------ density shift
@pandas_udf(_struct(value=DOUBLE, at=LONG))
def density_shift(
    values: pd.Series, lo: pd.Series, start: pd.Series, stop: pd.Series, n: pd.Series,
    low: pd.Series, high: pd.Series, width: pd.Series, window: pd.Series,
) -> pd.DataFrame:
    """Largest step between successive divergences of neighbouring windows, for owned t.

    Densities are normal kernels of bandwidth ``width`` on a grid of 100 points.
    """
    rows = []
    for v, a, s, e, total, zl, zh, bw, w in zip(values, lo, start, stop, n, low, high, width, window):
        rows.append(_density_shift(_arr(v), int(a), int(s), int(e), int(total), zl, zh, bw, int(w)))
    return pd.DataFrame(rows, columns=["value", "at"])


def _density_shift(x: np.ndarray, a: int, s: int, e: int, total: int, zl: float, zh: float, bw: float, w: int) -> tuple:
    grid = np.linspace(zl, zh, 100)
    step = grid[1] - grid[0]
    best = (None, None)
    # at least one step of rows at a time keeps the density matrix small
    last = min(e, total - w - 1)
    for c in range(s, last, 4096):
        d = min(c + 4096, last)
        p, q = max(c - w + 1, a), min(d + w + 1, a + len(x))
        dens = np.exp(-(((grid[None, :] - x[p - a : q - a, None]) / bw) ** 2) / 2) / (bw * np.sqrt(2 * np.pi))
        dens = np.maximum(dens, np.exp(-(38.0**2) / 2) / np.sqrt(2 * np.pi))
        mean = sum(dens[k : len(dens) - w + 1 + k] for k in range(w)) / w
        t = np.arange(c, d + 1)
        kl = np.zeros(len(t))
        ok = t >= w - 1
        i = t[ok] - p - w + 1
        m1, m2 = mean[i], mean[i + w]
        kl[ok] = (m1 * (np.log(m1) - np.log(m2))).sum(axis=1) * step
        gap = np.diff(kl)
        j = int(np.argmax(gap))
        if best[0] is None or gap[j] > best[0]:
            best = (float(gap[j]), c + j + w)
    return best


# -------------------------------------------------------- fluctuation scales
def scale_grid(n: int) -> np.ndarray:
    """Distinct of 50 log-spaced window lengths from 5 to n // 2."""
    if n // 2 < 5:
        return np.array([], dtype=int)
    raw = np.exp(np.log(5) + np.arange(50) * (np.log(n // 2) - np.log(5)) / 49)
    return np.unique(np.floor(raw + 0.5).astype(int))


def _fluctuations(x: np.ndarray, taus: np.ndarray, spread: bool) -> np.ndarray:
    """Root mean square range (or deviation) of the detrended profile per window length."""
    walk = np.cumsum(x)
    out = np.empty(len(taus))
    for k, tau in enumerate(taus):
        out[k] = np.sqrt(_detrended(walk[: len(walk) // tau * tau].reshape(-1, tau), spread).mean())
    return out


def _detrended(y: np.ndarray, spread: bool) -> np.ndarray:
    """Squared range (or mean square) of what a straight line leaves of each row."""
    tau = y.shape[1]
    u = np.arange(1, tau + 1) - (tau + 1) / 2
    centred = y - y.mean(axis=1, keepdims=True)
    rest = centred - (centred @ u / (u @ u))[:, None] * u
    return (rest.max(axis=1) - rest.min(axis=1)) ** 2 if spread else (rest**2).mean(axis=1)


def break_share(taus: np.ndarray, f: np.ndarray) -> float:
    """Share of scales before the best break between two straight log-log segments."""
    m, edge = len(taus), 6
    if m < 12:
        return 0.0
    x, y = np.log(taus), np.log(f)
    at, here = np.arange(edge, m - edge + 1)[:, None], np.arange(m)
    cost = 0.0
    for own in (here < at, here >= at - 1):  # a row per break: the points of its segment
        count = own.sum(axis=1, keepdims=True)
        a = (x - (own * x).sum(axis=1, keepdims=True) / count) * own
        b = (y - (own * y).sum(axis=1, keepdims=True) / count) * own
        slope = (a * b).sum(axis=1, keepdims=True) / (a * a).sum(axis=1, keepdims=True)
        cost = cost + np.linalg.norm(b - slope * a, axis=1)
    return (int(np.argmin(cost)) + edge) / m


@pandas_udf(_struct(rs=DOUBLE, dfa=DOUBLE))
def fluctuation_breaks(values: pd.Series) -> pd.DataFrame:
    """Range analysis of the series and detrended analysis of every second value."""
    rows = []
    for v in values:
        x = _arr(v)
        taus = scale_grid(len(x))
        sd = x.std(ddof=1) if len(x) > 1 else 0.0
        if len(taus) < 12 or not sd > 0:
            rows.append((0.0, 0.0) if sd > 0 else (None, None))
            continue
        z = (x - x.mean()) / sd
        half = z[: len(z) // 2 * 2 : 2]
        rows.append((break_share(taus, _fluctuations(z, taus, True)), break_share(taus, _fluctuations(half, taus[taus <= len(half)], False))))
    return pd.DataFrame(rows, columns=["rs", "dfa"])


@pandas_udf(ArrayType(_struct(tau=LONG, w=LONG, k=LONG, q=DOUBLE, s=DOUBLE, c=DOUBLE)))
def window_parts(values: pd.Series, lo: pd.Series, base: pd.Series, n: pd.Series, full: pd.Series, spread: pd.Series) -> pd.Series:
    """Windows of one block: per scale the summed measure of those inside, and moments of those that reach over an end.

    ``s`` sums the profile and ``c`` its product with the centred position in the window.
    """
    out = []
    for v, a, start, size, total, wide in zip(values, lo, base, n, full, spread):
        a, size, rows = int(a), int(size), []
        walk = start + np.cumsum(_arr(v))
        stop = min(a + len(walk), size)
        for tau in scale_grid(int(total)).tolist():
            end = size // tau * tau
            first, last = -(-a // tau), stop // tau  # windows first .. last - 1 lie inside
            if last > first:
                square = _detrended(walk[first * tau - a : last * tau - a].reshape(-1, tau), wide)
                rows.append((tau, None, last - first, float(square.sum()), None, None))
            for w in sorted({a // tau, (stop - 1) // tau}) if stop > a else ():
                p, q = max(w * tau, a), min((w + 1) * tau, stop)
                if (first <= w < last) or w * tau >= end:
                    continue
                y, u = walk[p - a : q - a], np.arange(p, q) - w * tau - (tau - 1) / 2
                rows.append((tau, w, None, None, float(y.sum()), float(u @ y)))
        out.append(rows)
    return pd.Series(out, dtype=object)


@pandas_udf(ArrayType(_struct(tau=LONG, w=LONG, low=DOUBLE, high=DOUBLE, ss=DOUBLE)))
def window_rests(
    values: pd.Series, lo: pd.Series, base: pd.Series, taus: pd.Series, windows: pd.Series, levels: pd.Series, slopes: pd.Series
) -> pd.Series:
    """What each fitted window leaves in one block: lowest, highest and squared sum of the residuals."""
    out = []
    for v, a, start, scale, number, level, slope in zip(values, lo, base, taus, windows, levels, slopes):
        a, rows = int(a), []
        walk = start + np.cumsum(_arr(v))
        for tau, w, mean, m in zip(map(int, scale), map(int, number), level, slope):
            p, q = max(w * tau, a), min((w + 1) * tau, a + len(walk))
            r = walk[p - a : q - a] - mean - m * (np.arange(p, q) - w * tau - (tau - 1) / 2)
            rows.append((tau, w, float(r.min()), float(r.max()), float(r @ r)))
        out.append(rows)
    return pd.Series(out, dtype=object)


@pandas_udf(DOUBLE)
def break_of_scales(taus: pd.Series, f: pd.Series) -> pd.Series:
    return pd.Series([break_share(_arr(t), _arr(x)) for t, x in zip(taus, f)], dtype=float)


# ------------------------------------------------------------- padded power
@pandas_udf(DOUBLES)
def padded_power(values: pd.Series, mean: pd.Series) -> pd.Series:
    """|F_k|^2 of the centred series padded to a power of two, k = 0 .. half."""
    out = []
    for v, m in zip(values, mean):
        size = 1 << int(np.ceil(np.log2(max(len(v), 2))))
        out.append(np.abs(np.fft.rfft(_arr(v) - m, size)) ** 2)
    return pd.Series(out, dtype=object)


# ------------------------------------------------------------- holt smoothing
HOLT_GRID = [(a / 10, b / 10) for a in range(1, 11) for b in range(0, 11) if b <= a]  # fixed values: (alpha, beta)


@pandas_udf(ArrayType(DOUBLES))
def holt_maps(values: pd.Series, start: pd.Series) -> pd.Series:
    """Per grid point the effect of a block on the smoothing state.

    With h = (level, slope, 1) before the block, the state after it is M h and the
    squared one-step errors add up to h' Q h; each entry is M (2x3) then Q (3x3).
    ``start`` values at the front are skipped.
    """
    out = []
    for v, s in zip(values, start):
        state, q = _holt_block(_arr(v)[int(s) :])
        out.append(list(np.concatenate([state[:, :2].reshape(-1, 6), q.reshape(-1, 9)], axis=1)))
    return pd.Series(out, dtype=object)


def _holt_block(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State map (3x3) and error form (3x3) of a run of values, per grid point.

    About sqrt(n) runs step side by side, so Python takes sqrt(n) steps; then
    neighbouring runs are joined two by two, as joining maps is associative.
    """
    alpha = np.array([g[0] for g in HOLT_GRID])[:, None]
    gain = np.array([g[0] * g[1] for g in HOLT_GRID])[:, None]
    length = max(int(np.sqrt(len(x))), 1)
    runs = max(-(-len(x) // length), 1)
    state = np.tile(np.eye(3), (runs, len(HOLT_GRID), 1, 1))
    q = np.zeros_like(state)
    for i in range(length):
        now = x[i::length]  # value i of every run that has one: the last run may be shorter
        if not len(now):
            break
        level, slope = state[: len(now), :, 0], state[: len(now), :, 1]
        ahead = level + slope
        err = -ahead
        err[:, :, 2] += now[:, None]
        q[: len(now)] += err[:, :, :, None] * err[:, :, None, :]
        level[:] = ahead + alpha * err
        slope += gain * err
    while len(state) > 1:
        even = len(state) // 2 * 2
        first, second = state[0:even:2], state[1:even:2]
        joined = q[0:even:2] + first.swapaxes(-1, -2) @ q[1:even:2] @ first
        state, q = np.concatenate([second @ first, state[even:]]), np.concatenate([joined, q[even:]])
    return state[0], q[0]


# ------------------------------------------------------------ super smoother
def _running_line(y: np.ndarray, half: int):
    """Local-linear fit on t-half .. t+half (one-sided windows keep their length at the
    ends) and its leave-one-out residual."""
    n = len(y)
    lo = np.clip(np.arange(n) - half, 0, max(n - 2 * half - 1, 0))
    hi = np.minimum(lo + 2 * half + 1, n)
    x = np.arange(n, dtype=float) - (n - 1) / 2

    def sums(a):
        c = np.concatenate([[0.0], np.cumsum(a)])
        return c[hi] - c[lo]

    m = (hi - lo).astype(float)
    mx, my = sums(x) / m, sums(y) / m
    vx = sums(x * x) - m * mx * mx
    cxy = sums(x * y) - m * mx * my
    fit = my + np.where(vx > 0, cxy / np.where(vx > 0, vx, 1.0), 0.0) * (x - mx)
    lever = 1 - 1 / m - np.where(vx > 0, (x - mx) ** 2 / np.where(vx > 0, vx, 1.0), 0.0)
    return fit, np.abs(y - fit) / np.where(lever > 1e-9, lever, 1.0)


def super_smooth(y: np.ndarray) -> np.ndarray:
    """Smoother with a span chosen per point by cross-validation (Friedman 1984).

    Fixed values: spans 0.05, 0.2 and 0.5 of the length.
    """
    n = len(y)
    spans = (0.05, 0.2, 0.5)
    halves = [max(int(0.5 * s * n + 0.5), 2) for s in spans]
    fits, resid = zip(*[_running_line(y, min(h, (n - 1) // 2)) for h in halves])
    mid = min(halves[1], (n - 1) // 2)
    resid = [_running_line(r, mid)[0] for r in resid]
    pick = np.take(spans, np.argmin(resid, axis=0))
    span = np.clip(_running_line(pick, mid)[0], spans[0], spans[2])
    below = span < spans[1]
    f = np.where(below, (span - spans[0]) / (spans[1] - spans[0]), (span - spans[1]) / (spans[2] - spans[1]))
    mix = np.where(below, (1 - f) * fits[0] + f * fits[1], (1 - f) * fits[1] + f * fits[2])
    return _running_line(mix, min(halves[0], (n - 1) // 2))[0]


@pandas_udf(DOUBLES)
def smooth_trend(values: pd.Series) -> pd.Series:
    return pd.Series([super_smooth(_arr(v)) if len(v) > 4 else _arr(v) for v in values], dtype=object)
