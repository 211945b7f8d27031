"""Autocorrelation and ADF in time blocks against serial versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import series as H


def serial_adf(x, max_lag=None):
    """Least squares on the whole series for every lag."""
    x = np.asarray(x, float)
    n = len(x)
    top = min(int(np.ceil(12 * (n / 100) ** 0.25)) if max_lag is None else max_lag, n // 2 - 2)

    def fit(lag, drop):
        dx = np.diff(x)
        t = np.arange(drop, len(dx))
        m = np.column_stack([x[t], np.ones(len(t)), *[dx[t - k] for k in range(1, lag + 1)]])
        beta, *_ = np.linalg.lstsq(m, dx[t], rcond=None)
        rss = ((dx[t] - m @ beta) ** 2).sum()
        return rss, len(t), beta[0] / np.sqrt(rss / (len(t) - lag - 2) * np.linalg.inv(m.T @ m)[0, 0])

    best = min(range(top + 1), key=lambda k: (lambda r: r[1] * np.log(r[0] / r[1]) + 2 * (k + 2))(fit(k, top)))
    return best, fit(best, best)[1:]


def walk(kind, n=900, seed=3):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n)
    if kind == "walk":
        return np.cumsum(e) + 1e6
    x = np.zeros(n)
    for t in range(2, n):
        x[t] = (0.5 if kind == "short" else 0.9) * x[t - 1] + (0 if kind == "short" else -0.3) * x[t - 2] + e[t]
    return x


@pytest.mark.parametrize("kind", ["walk", "short", "long"])
@pytest.mark.parametrize("block", [32_768, 100])
def test_adf_is_the_serial_one(spark, kind, block, monkeypatch):
    monkeypatch.setattr(H, "halo_blocks", lambda indexed, width, keys=(), f=H.halo_blocks: f(indexed, width, keys, block))
    x = walk(kind)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)] + [(5_000, None)], "t long, value double").repartition(5)
    got = H.adf(df, ["t"]).first()
    lag, (n, stat) = serial_adf(x)
    assert (got["used_lag"], got["n_obs"]) == (lag, n) and abs(got["statistic"] - stat) < 1e-6
    assert got["stationary"] == (kind != "walk") and got["crit_1"] < got["crit_5"] < got["crit_10"]


def test_p_values_at_published_critical_values():
    """Asymptotic 1, 5 and 10 % points of the distribution with a constant."""
    for stat, p in ((-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)):
        assert abs(H.dickey_fuller_p(stat) - p) < 0.002
    grid = np.linspace(-20, 4, 400)
    p = [H.dickey_fuller_p(g) for g in grid]
    assert p[0] == 0 and p[-1] == 1 and (np.diff(p) >= -1e-3).all()


@pytest.mark.parametrize("values", [[], [1.0] * 50, [1.0, 2.0, 4.0]])
def test_adf_of_short_and_constant_series(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "t long, value double")
    assert H.adf(df, ["t"]).first()["statistic"] is None


@pytest.mark.parametrize("block", [32_768, 7])
def test_acf_in_blocks(spark, block, monkeypatch):
    monkeypatch.setattr(H, "halo_blocks", lambda indexed, width, keys=(), f=H.halo_blocks: f(indexed, width, keys, block))
    rng = np.random.default_rng(1)
    series = {"a": np.cumsum(rng.normal(size=200)), None: rng.normal(size=90), "short": np.array([1.0, 3.0, 2.0]), "flat": np.ones(9)}
    rows = [(k, i, float(v)) for k, x in series.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "k string, t long, value double").repartition(4)
    got = {(r["k"], r["lag"]): r["acf"] for r in H.acf(df, ["t"], lags=12, keys=["k"]).collect()}
    for k, x in series.items():
        d = x - x.mean()
        for lag in range(13):
            want = (d[lag:] * d[:len(d) - lag]).sum() / (d * d).sum() if d.any() and lag < len(d) else (None if not d.any() else 0.0)
            assert got[k, lag] is None if want is None else abs(got[k, lag] - want) < 1e-10
    plan = H.acf(df.where("k = 'a'"), ["t"], lags=12)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan.split("FlatMapGroups")[0]
