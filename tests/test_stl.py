"""STL in blocks against a serial version written point by point."""

import numpy as np
import pytest

from riskframe.operators import series as H
from riskframe.operators import stl as S


def fitted(y, width, at):
    """A line through the nearest values with tricube weights, solved by least squares."""
    n = len(y)
    m = min(width, n)
    first = min(max(int(at) - (width - 1) // 2, 0), n - m) if n > width else 0
    t = np.arange(first, first + m, dtype=float)
    far = max(abs(t[0] - at), abs(t[-1] - at)) + (max(0, width - n) // 2)
    d = np.abs(t - at) / far
    w = np.where(d <= 0.999, (1 - d ** 3) ** 3, 0)
    design = np.column_stack([np.ones(m), t - at]) * np.sqrt(w)[:, None]
    return np.linalg.lstsq(design, y[first:first + m] * np.sqrt(w), rcond=None)[0][0]


def serial(x, period, seasonal=7, rounds=5):
    low, trend_width = period + 1 + period % 2, int(np.ceil(1.5 * period / (1 - 1.5 / seasonal)))
    trend_width += 1 - trend_width % 2
    n, trend = len(x), np.zeros(len(x))
    for _ in range(rounds):
        c = {}
        for p in range(period):
            sub = (x - trend)[p::period]
            for k in range(-1, len(sub) + 1):
                c[p + k * period] = fitted(sub, seasonal, k)
        c = np.array([c[i] for i in range(-period, n + period)])
        for width in (period, period, 3):
            c2 = [c[i:i + width].mean() for i in range(len(c) - width + 1)]
            if width == period and len(c) == n + 2 * period:
                whole = c
            c = np.array(c2)
        season = whole[period:period + n] - np.array([fitted(c, low, i) for i in range(n)])
        trend = np.array([fitted(x - season, trend_width, i) for i in range(n)])
    return trend, season


def made(n, period=12, seed=1):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return 1e4 + 0.01 * t + 5 * np.sin(2 * np.pi * t / period) * (1 + t / n) + np.cumsum(rng.normal(size=n)) * 0.3 + rng.normal(size=n)


@pytest.mark.parametrize("n,period", [(24, 12), (25, 12), (61, 12), (150, 12), (90, 7), (40, 4)])
def test_one_block_is_the_serial_one(n, period):
    x = made(n, period)
    trend, season = S.decompose(x, period)
    want = serial(x, period)
    assert np.allclose(trend, want[0], atol=1e-7) and np.allclose(season, want[1], atol=1e-7)


def test_blocks_are_the_whole_series(spark):
    """Two series in blocks of 4 * reach rows; the last block of one holds a single row."""
    size = 4 * S.reach(4, 3, 2)
    data = {"a": made(3 * size + 1, 4, 2), "b": made(size + 7, 4, 3), "short": made(7, 4, 4)}
    rows = [(k, i, float(v)) for k, x in data.items() for i, v in enumerate(x)] + [("a", -1, None), ("b", 10 ** 6, float("nan")), (None, 1, 1.0)]
    df = spark.createDataFrame(rows, "`k.y` string, t long, value double").repartition(7)
    got = S.stl(df, ["t"], period=4, seasonal=3, rounds=2, keys=["k.y"], block_rows=1).toPandas()
    assert len(got) == sum(map(len, data.values())) + 1
    for k, x in data.items():
        g = got[got["k.y"] == k].sort_values("_idx")
        assert np.array_equal(g["x"], x)
        if k == "short":
            assert g[["trend", "seasonal", "resid"]].isna().all(axis=None)
            continue
        trend, season = S.decompose(x, 4, 3, 2)
        assert np.allclose(g["trend"], trend, atol=1e-8) and np.allclose(g["seasonal"], season, atol=1e-8)
        assert np.allclose(g["trend"] + g["seasonal"] + g["resid"], x)


def test_halo_is_wide_enough():
    """What lies beyond the reach of a row changes nothing for it."""
    far = S.reach(12)
    x = made(2 * far + 200)
    y = x.copy()
    y[:100] += 1e6
    a, b = S.decompose(x, 12), S.decompose(y, 12)
    assert np.allclose(a[0][100 + far:], b[0][100 + far:], atol=1e-6) and np.allclose(a[1][100 + far:], b[1][100 + far:], atol=1e-6)


def test_parts_of_a_plain_series(spark):
    t = np.arange(240)
    season = np.tile(np.arange(12) - 5.5, 20)
    df = spark.createDataFrame([(int(i), float(100 + 2 * i + s)) for i, s in zip(t, season)], "t long, value double")
    got = S.stl(df, ["t"]).toPandas().sort_values("_idx")
    assert np.allclose(got["trend"], 100 + 2 * t, atol=0.05) and np.allclose(got["seasonal"], season, atol=0.05)
    row = H.decomposition_summary(S.stl(df, ["t"])).first()
    assert abs(row["resid_mean"]) < 0.01 and row["seasonal_max"] == pytest.approx(5.5, abs=0.05)


def test_empty_and_wrong_settings(spark):
    empty = spark.createDataFrame([], "t long, value double")
    assert S.stl(empty, ["t"]).count() == 0
    with pytest.raises(ValueError):
        S.stl(empty, ["t"], seasonal=6)
