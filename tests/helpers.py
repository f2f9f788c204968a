import math

import numpy as np

KEY = ["series_id", "channel"]


def points(spark, series: dict, channel="0"):
    """Points from {series_id: values}; None and NaN are missing."""
    rows = [
        (str(k), channel, t, None if v is None or (isinstance(v, float) and math.isnan(v)) else float(v))
        for k, vs in series.items()
        for t, v in enumerate(vs)
    ]
    return spark.createDataFrame(rows, "series_id string, channel string, t bigint, v double")


def table(df, extra=()):
    """Rows as {key: row dict}."""
    keys = [*[k for k in KEY if k in df.columns], *extra]
    return {tuple(r[k] for k in keys): r.asDict(recursive=True) for r in df.collect()}


def assert_same(a, b, extra=(), tol=1e-7):
    """Two results with the same rows and nearly equal numbers."""
    x, y = table(a, extra), table(b, extra)
    assert x.keys() == y.keys()
    for k in x:
        assert x[k].keys() == y[k].keys()
        for c, v in x[k].items():
            w = y[k][c]
            if isinstance(v, float) and isinstance(w, (float, int)):
                assert abs(v - w) <= tol * max(1.0, abs(v)), (k, c, v, w)
            elif isinstance(v, list):
                assert np.allclose(np.array(v, float), np.array(w, float), rtol=tol, atol=tol), (k, c)
            else:
                assert v == w, (k, c, v, w)


def some_series(seed=7, n=230):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return {
        "noise": np.round(rng.normal(5, 2, n), 3),
        "sine": np.sin(2 * np.pi * t / 12) * 3 + 0.2 * rng.normal(size=n) + 10,
        "walk": np.cumsum(rng.normal(size=n)) + 50,
        "zeros": np.where(rng.random(n) < 0.3, 0.0, rng.gamma(2, 3, n)),
        "short": np.round(rng.normal(0, 1, 40), 2),
        "slow": np.linspace(0, 5, n) ** 2 + rng.normal(size=n) * 0.1,
    }
