"""Correlations of many columns against pandas, Kendall against all pairs."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.operators import correlation as C


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(4)
    x = pd.DataFrame({"a": rng.normal(size=400), "b": rng.integers(0, 5, 400).astype(float), "c.d": rng.normal(size=400) * 1e6 + 1e9,
                      "const": 3.0, "gap": rng.normal(size=400), "skew": np.exp(rng.normal(size=400) * 3)})
    x["e"] = x["a"] * 2 + rng.normal(size=400) * 0.1
    x.loc[rng.random(400) < 0.3, "gap"] = np.nan
    x.loc[:9, "b"] = np.nan
    return x


def pairs(df):
    return {(r["var1"], r["var2"]): r["r"] for r in df.collect()}


def close(got, want):
    assert set(got) == set(want)
    for k, v in want.items():
        assert (got[k] is None) == math.isnan(v) and (got[k] is None or abs(got[k] - v) < 1e-9), k


def expected(frame, method):
    m = frame.corr(method)
    return {(a, b): m.loc[a, b] for i, a in enumerate(frame.columns) for b in frame.columns[i + 1:]}


def test_pairwise_complete_pearson(spark, table):
    close(pairs(C.pearson_pairs(spark.createDataFrame(table).repartition(3))), expected(table, "pearson"))


@pytest.mark.parametrize("method", ["pearson", "spearman"])
@pytest.mark.parametrize("lookup", [500_000, 300, 0])
def test_complete_case_correlations(spark, table, method, lookup, monkeypatch):
    """Ranks by lookup, by shuffles, and both."""
    monkeypatch.setattr(C, "LOOKUP", lookup)
    close(pairs(C.correlation_matrix(spark.createDataFrame(table).repartition(3), list(table.columns), method)), expected(table.dropna(), method))


def test_hundred_columns(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 110)).round(1)
    x[:, 50:] += x[:, :60] * 2
    frame = pd.DataFrame(x, columns=[f"v{i}" for i in range(110)])
    df = spark.createDataFrame(frame).repartition(4)
    close(pairs(C.correlation_matrix(df, list(frame.columns), "spearman")), expected(frame, "spearman"))
    close(pairs(C.pearson_pairs(df)), expected(frame, "pearson"))


def test_data_are_read_in_one_stage(spark):
    """One aggregate over the pairs' moments, no join and no wide aggregate."""
    df = spark.range(100).select(*[(F.col("id") * i % 17).cast("double").alias(f"v{i}") for i in range(1, 30)])
    plan = C.pearson_pairs(df)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("MapInArrow") == 1 and "corr(" not in plan


def test_empty_and_single(spark):
    none = spark.createDataFrame([], "a double, b double")
    assert [r["r"] for r in C.pearson_pairs(none).collect()] in ([], [None])
    assert C.pearson_pairs(none.select("a")).count() == 0 and C.kendall_tau_b(none, "a", "b").count() == 0
    with pytest.raises(ValueError):
        C.correlation_matrix(none, ["a", "b"], "kendall")


def tau_b(x, y):
    i, j = np.triu_indices(len(x), 1)
    dx, dy = np.sign(x[i] - x[j]), np.sign(y[i] - y[j])
    con, dis = int((dx * dy > 0).sum()), int((dx * dy < 0).sum())
    bottom = math.sqrt((dx != 0).sum()) * math.sqrt((dy != 0).sum())
    return con, dis, int((dx == 0).sum()), int((dy == 0).sum()), (con - dis) / bottom if bottom else None


@pytest.mark.parametrize("kind", ["ties", "few", "continuous", "equal", "one", "reversed"])
def test_kendall_is_that_of_all_pairs(spark, kind):
    rng = np.random.default_rng(9)
    x, y = {"ties": (rng.integers(0, 9, 300), rng.integers(0, 9, 300)), "few": (rng.integers(0, 2, 200), rng.normal(size=200)),
            "continuous": (rng.normal(size=257), rng.normal(size=257)), "equal": (np.ones(40), rng.normal(size=40)), "one": (np.ones(1), np.ones(1)),
            "reversed": (np.arange(65), -np.arange(65))}[kind]
    rows = [(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0), (1.0, None)]
    got = C.kendall_tau_b(spark.createDataFrame(rows, "x double, y double").repartition(3), "x", "y").first()
    con, dis, tx, ty, tau = tau_b(np.asarray(x, float), np.asarray(y, float))
    assert (got["n"], got["concordant"], got["discordant"], got["ties_x"], got["ties_y"]) == (len(x), con, dis, tx, ty)
    assert got["tau_b"] is None if tau is None else abs(got["tau_b"] - tau) < 1e-12


def test_centres_of_ranks_come_from_the_distinct_values(spark, table):
    own = table[["a", "b", "const"]].dropna()
    values = C.as_doubles(spark.createDataFrame(own), list(own.columns), complete=True)
    ranks, (mean, spread) = C.ranked(values)
    want = own.rank().to_numpy()
    assert sorted(map(tuple, ranks.collect())) == sorted(map(tuple, want))
    assert np.allclose(mean, want.mean(axis=0)) and np.allclose(spread[:2], want.std(axis=0)[:2]) and spread[2] == 1
