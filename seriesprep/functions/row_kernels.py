"""Small numpy helpers that score a whole series held in one row; each is the one-row form of an operator.

``z`` is the standardised series in time order, NULL for a constant one, which gives NULL; ``t`` are its times.
Means and cross products are summed in time order, as Spark sums the rows of a series: what is left of a fit
that is exact, or of a constant series, then comes out as in the block-wise form.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql.functions import pandas_udf

from .kernels import DOUBLES, HOLT_GRID, _arr, _density_shift, _holt_block, _lag_products, _ols, _yule_walker, super_smooth


def _per_row(score: Callable):
    """UDF: arrays of one series -> the list of its scores, NULL where the first array is."""

    @pandas_udf(DOUBLES)
    def scores(*columns: pd.Series) -> pd.Series:
        rows = (None if x[0] is None else score(*map(_arr, x)) for x in zip(*columns))
        return pd.Series(list(rows), dtype=object)

    return scores


def _steps(x: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First differences and their times, shifted down by one."""
    own = t[1:] > 0
    return np.diff(x)[own], t[1:][own] - 1


def _mean(x: np.ndarray) -> float:
    return np.cumsum(x)[-1] / len(x)


def _all_lags(x: np.ndarray) -> np.ndarray:
    d = x - _mean(x)
    return _lag_products(d, d, 0, len(d))


def _first_nonpositive(x: np.ndarray) -> int:
    """First lag whose autocorrelation is <= 0, the length if there is none."""
    low = np.flatnonzero(_all_lags(x) <= 0)
    return int(low[0]) if len(low) else len(x)


def _correlations(x: np.ndarray, lags: int) -> np.ndarray | None:
    """Autocorrelations 1..lags; 0 beyond the length, None without variation."""
    d = x - _mean(x) if len(x) else x
    total = d @ d
    return np.array([d[k:] @ d[: max(len(d) - k, 0)] for k in range(1, lags + 1)]) / total if total else None


def _gram(columns: list[np.ndarray], step: int = 4096) -> np.ndarray:
    z = np.stack(columns)
    gram = np.zeros((len(z), len(z)))
    for a in range(0, z.shape[1], step):
        part = z[:, None, a : a + step] * z[:, a : a + step]
        part[..., 0] += gram
        gram = np.cumsum(part, axis=-1)[..., -1]
    return gram


def _embedding(z, t):
    n = len(z)
    tau = min(_first_nonpositive(z), n // 10)
    d, at = _steps(z, t.astype(np.int64))
    i, q = np.concatenate([at, at - tau]), np.tile(d * d, 2)
    inside = (i >= 0) & (i < n - tau - 1)
    if not inside.any():
        return None
    i, q = i[inside], q[inside]
    v = np.sqrt(np.bincount(i, q)[np.bincount(i) > 0])
    m, low, sd = len(v), v.min(), v.std(ddof=1) if len(v) > 1 else 0.0
    bins = int(np.ceil((v.max() - low) / (3.5 * sd / m ** (1.0 / 3.0)))) if sd >= 0.001 else 0
    if not bins:
        return [0.0]
    step, mean = (v.max() - low) / bins, v.mean()
    counts = np.bincount(np.minimum(np.floor((v - low) / step), bins - 1).astype(np.int64), minlength=bins)
    centre = low + step * (np.arange(bins) + 0.5)
    return [np.abs(counts / m - np.exp(-centre / mean) / mean).mean()]


def _arch(z, lags: int = 12):
    """R^2 of the squares on their own lags; None when too short."""
    y = z * z
    m = len(y) - lags
    if m <= 1:
        return None
    gram = _gram([np.ones(m), *[y[lags - k : len(y) - k] for k in range(1, lags + 1)], y[lags:]])
    total, rest = _ols(gram, 1)[1], _ols(gram, lags + 1)[1]
    return 1 - rest / total if total else None


def _heterogeneity(z):
    coefs = _yule_walker(_all_lags(z)[:512], len(z))
    rest = np.convolve(z, np.append(1.0, -coefs), mode="valid") if len(z) > len(coefs) else z[:0]
    ac = _correlations(rest * rest, 12)
    sd = rest.std(ddof=1) if len(rest) > 1 and rest.max() > rest.min() else 0.0
    return [None if ac is None else ac @ ac, _arch((rest - _mean(rest)) / sd) if sd > 0 else None]


def _periodicity(z, t):
    n = len(z)
    scale = max((n - 1) / 2.0, 1.0)
    x = t / scale - 1
    u = np.maximum(x - ((n // 2 - 1) / scale - 1), 0.0)
    basis = [np.ones(n), x, x**2, x**3, u**3]
    rest = z - _ols(_gram([*basis, z]), 5)[0] @ np.stack(basis)
    lag = np.arange(1, min(-(-n // 3), n - 1) + 1)
    ac = _all_lags(rest)[lag] / (n - lag)
    before, here, after = ac[:-2], ac[1:-1], ac[2:]
    low = None
    for i in np.flatnonzero(((here < before) & (here < after)) | ((here > before) & (here > after))):
        if here[i] < before[i]:
            low = here[i]
        elif low is not None and here[i] - low >= 0.01 and here[i] >= 0:
            return [float(i + 1)]
    return [0.0]


def _decomposition(z):
    n = len(z)
    trend = super_smooth(z) if n > 4 else z
    e = z - trend
    varied, whole = e.var(ddof=1), z.var(ddof=1)
    ac = _correlations(e, 10)
    c = np.arange(n) - (n - 1) / 2.0
    line = c @ trend / np.sqrt(n * (n * n - 1) / 12.0)
    spike = curve = None
    if n > 2:
        spike = ((varied * (n - 1) - (e - e.mean()) ** 2) / (n - 2)).var(ddof=1)
        curve = (c * c - (n * n - 1) / 12.0) @ trend / np.sqrt(float(n) * (n * n - 1) * (n * n - 4) / 180.0)
    strength = max(0.0, min(1.0, 1 - varied / whole))
    return [strength, spike, line, curve, *([None, None] if ac is None else [ac[0], ac @ ac])]


def _modes(z, step):
    low, high = z.min(), z.max()
    out = []
    for bins in (5, 10):
        width = (high - low) / bins
        slot = np.minimum(np.floor((z - low) / width), bins - 1).astype(np.int64)
        counts = np.bincount(slot, minlength=bins)
        out.append((low + width * (np.flatnonzero(counts == counts.max()) + 0.5)).mean())
    neat = np.maximum(np.ceil(np.round(z / step, 7)) - 1, np.floor(low / step + 1e-7))
    edges, counts = np.unique(neat, return_counts=True)
    return [*out, (edges[counts.argmax()] + 0.5) * step]


def _tau_ratio(x, t):
    d, at = _steps(x, t)
    d = d[np.lexsort((d, at))]  # a time may repeat
    return [_first_nonpositive(d) / _first_nonpositive(x)] if len(d) else None


def _partial(ac: np.ndarray, order: int) -> np.ndarray | None:
    """Partial autocorrelations 1..order by the Durbin-Levinson recursion."""
    phi, out = ac[:1], [ac[0]]
    for k in range(2, order + 1):
        down = 1.0 - phi @ ac[: k - 1]
        if down == 0:
            return None
        last = (ac[k - 1] - phi[::-1] @ ac[: k - 1]) / down
        phi = np.append(phi - last * phi[::-1], last)
        out.append(last)
    return np.array(out)


def _acf_pacf(x, t):
    out = []
    for _ in range(3):
        ac = _correlations(x, 10)
        part = None if ac is None else _partial(ac, 5)
        out += [None, None] if ac is None else [ac[0], ac @ ac]
        out.append(None if part is None else part @ part)
        x, t = _steps(x, t)
    return out


def _nonlinearity(z):
    m = len(z) - 1
    power = [np.ones(m)]
    for _ in range(6):
        power.append(power[-1] * z[:-1])
    total = lambda a: np.cumsum(a)[-1]
    x, y = [total(p) for p in power], [*[total(p * z[1:]) for p in power[:4]], total(z[1:] * z[1:])]
    gram = np.array([[y[min(i, j)] if max(i, j) == 4 else x[i + j] for j in range(5)] for i in range(5)])
    gram[4, 4] = y[4]
    plain, cubic = _ols(gram, 2)[1], _ols(gram, 4)[1]
    return [m * np.log(plain / cubic) * 10 / (m + 1)] if plain > 0 and cubic else None


def _shifts(z, t, width: int = 10):
    out = []
    if len(z) < 2 * width:
        return [0.0, None, 0.0, None]
    windows = np.lib.stride_tricks.sliding_window_view(z, width)
    for level in (windows.mean(axis=1), windows.var(axis=1, ddof=1)):
        gap = np.abs(level[width:] - level[:-width])
        at = int(np.argmax(np.round(gap, 9)))
        out += [gap[at], width + t[at]]
    return out


def _density(z, width: int = 10):
    n = len(z)
    if n <= 2 * width:
        return None
    q1, q3 = np.quantile(z, [0.25, 0.75])
    sd = z.std(ddof=1)
    spread = min(sd, (q3 - q1) / 1.34)
    value, at = _density_shift(z, 0, 0, n, n, z.min(), z.max(), (spread if spread > 0 else sd) * 0.9 * n**-0.2, width)
    return None if value is None else [value, float(at)]


def _welch(z):
    size = 1 << int(np.ceil(np.log2(max(len(z), 2))))
    power = np.abs(np.fft.rfft(z - z.mean(), size)) ** 2 / len(z) / (2.0 * np.pi)
    last = len(power) - 1
    power[1:last] *= 2.0
    total = np.cumsum(power)
    step, low = np.pi / last, len(power) // 5
    return [(total[low - 1] if low else 0.0) * step, np.count_nonzero(total <= total[-1] * 0.5) * step]


def _holt(z):
    if len(z) < 3:
        return None
    _, q = _holt_block(z[2:])
    h = (z[1], z[1] - z[0], 1.0)
    error = np.zeros(len(q))
    for i in range(3):
        for j in range(3):
            error = error + q[:, i, j] * h[i] * h[j]
    return list(HOLT_GRID[int(error.argmin())])


def _tiles(z, t, width: int = 10):
    tile = t.astype(np.int64) // width
    count = np.maximum(np.bincount(tile), 1)
    mean = np.bincount(tile, z) / count
    var = np.bincount(tile, (z - mean[tile]) ** 2) / (width - 1)
    full = count == width
    return [var[full].var(ddof=1), mean[full].var(ddof=1)] if full.sum() > 1 else [0.0, 0.0]


def _walker(z):
    """Share of steps where a walker with gain 0.1 crosses the series."""
    x = z.tolist()
    w, crossed = 0.0, 0
    for i in range(1, len(x)):
        ahead = w + (x[i - 1] - w) * 0.1
        crossed += (w - x[i - 1]) * (ahead - x[i]) < 0
        w = ahead
    return [crossed / (len(x) - 1)]


def _lag2_information(z):
    if len(z) < 3:
        return None
    low = z.min()
    code = np.floor((z - low + 0.1) / ((z.max() - low + 0.2) / 5)).astype(np.int64)
    c = np.zeros((6, 6))
    np.add.at(c, (code[:-2], code[2:]), 1)
    m, at = len(z) - 2, c > 0
    return [(c / m * np.log(np.where(at, c * m, 1.0) / np.where(at, np.outer(c.sum(axis=1), c.sum(axis=0)), 1.0))).sum()]


def _stretches(x, t, mean):
    n = len(x)
    own = t < n - 1
    if not own.any():
        return None
    after = np.append(x[1:], np.nan)
    out = []
    for stop in ((x <= mean), (after >= x)):
        at = t[own & (stop | (t == n - 2))]
        out.append(np.diff(at, prepend=0.0).max() if len(at) else None)
    return out


def _motif(x):
    n = len(x)
    if n < 2:
        return None
    s, code = np.sort(x), np.zeros(n, np.int64)
    for q in (1.0 / 3.0, 2.0 / 3.0):
        at = min(max(n * q - 0.5, 0.0), n - 1)
        low = int(at)
        code += x > s[low] + (at - low) * (s[int(np.ceil(at))] - s[low])
    p = np.bincount(code[:-1] * 3 + code[1:]) / (n - 1)
    p = p[p > 0]
    return [-(p * np.log(p)).sum()]


def _flat_spots(x, t):
    width = (x.max() - x.min()) / 10
    tenth = np.maximum(np.ceil((x - x.min()) / width), 1) if width else np.ones(len(x))
    start = np.append(True, tenth[1:] != tenth[:-1])
    return [(t - t[start][np.cumsum(start) - 1] + 1).max()]


def _gaussian(x, t, mean, top: int = 40):
    n, d = len(x), x - mean
    total = lambda a: np.cumsum(a)[-1] if len(a) else 0.0
    s, q = total(d), total(d * d)
    head, tail = d[t < top], d[t >= n - top][::-1]
    limit = min(top, -(-n // 2))
    ami = np.full(limit + 1, np.nan)
    for k in range(1, limit + 1):
        m = n - k
        if m <= 1:
            continue
        sa, sb = s - total(head[:k]), s - total(tail[:k])
        va, vb = q - total(head[:k] ** 2) - sa * sa / m, q - total(tail[:k] ** 2) - sb * sb / m
        cov = total(d[k:] * d[:-k]) - sa * sb / m
        left = 1 - cov * cov / (va * vb) if va * vb else 0.0
        ami[k - 1] = -0.5 * np.log(left) if left > 0 else np.nan
    if np.isnan(ami[0]):
        return None
    low = np.flatnonzero((ami[1:-1] < ami[:-2]) & (ami[1:-1] < ami[2:]))
    return [float(low[0] + 1) if len(low) else float(limit)]


BOX_COX_GRID = np.array([round(-1 + 0.1 * i, 1) for i in range(31)])  # fixed values: -1, -0.9, .., 2


def _box_cox(x, t):
    odd = len(x) % 2
    own = t >= odd
    pair = (t[own].astype(np.int64) - odd) // 2
    v, count = x[own], np.bincount(pair)
    mean = np.bincount(pair, v) / np.maximum(count, 1)
    square = np.bincount(pair, (v - mean[pair]) ** 2)
    full = (count > 1) & (mean > 0)
    m, sd = mean[full], np.sqrt(square[full] / (count[full] - 1))
    if len(m) < 2:
        return None
    ratio = sd * np.power(m, (BOX_COX_GRID - 1)[:, None])
    level, spread = ratio.mean(axis=1), ratio.std(axis=1, ddof=1)
    known = (level != 0) & ((BOX_COX_GRID >= 0) | (x.min() > 0))
    if not known.any():
        return None
    return [BOX_COX_GRID[known][np.round(spread[known] / level[known], 12).argmin()]]


embedding = _per_row(_embedding)
arch = _per_row(lambda z: [_arch(z)])
heterogeneity = _per_row(_heterogeneity)
periodicity = _per_row(_periodicity)
decomposition = _per_row(_decomposition)
modes = _per_row(_modes)
tau_ratio = _per_row(_tau_ratio)
acf_pacf = _per_row(_acf_pacf)
nonlinearity = _per_row(_nonlinearity)
shifts = _per_row(_shifts)
density = _per_row(_density)
welch = _per_row(_welch)
holt = _per_row(_holt)
tiles = _per_row(_tiles)
walker = _per_row(_walker)
lag2_information = _per_row(_lag2_information)
stretches = _per_row(_stretches)
motif = _per_row(_motif)
flat_spots = _per_row(_flat_spots)
gaussian = _per_row(_gaussian)
box_cox = _per_row(_box_cox)
