"""phi_K against a direct numerical integration and known cases."""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from riskframe.operators import phik as P


def direct_chi2(rho, rows, columns):
    """Cell shares by integrating the conditional distribution over fine steps of x."""
    cdf = np.vectorize(lambda v: 0.5 * math.erfc(-v / math.sqrt(2)))
    x, y = np.linspace(-5, 5, rows + 1), np.linspace(-5, 5, columns + 1)
    total = 0.0
    py = np.diff(cdf(y))
    for a, b in zip(x, x[1:]):
        edges = np.linspace(a, b, 2001)
        mid, dx = (edges[1:] + edges[:-1]) / 2, edges[1] - edges[0]
        density = np.exp(-mid ** 2 / 2) / math.sqrt(2 * math.pi) * dx
        share = density @ np.diff(cdf((y[None, :] - rho * mid[:, None]) / math.sqrt(1 - rho * rho)), axis=1)
        p = (cdf(b) - cdf(a)) * py
        total += ((share - p) ** 2 / p).sum()
    return total


@pytest.mark.parametrize("rho,rows,columns", [(0.3, 2, 2), (0.5, 10, 10), (0.8, 3, 7), (0.95, 10, 4)])
def test_normal_chi2_is_the_direct_integral(rho, rows, columns):
    assert P.normal_chi2(rho, rows, columns) == pytest.approx(direct_chi2(rho, rows, columns), rel=1e-4)


def test_normal_chi2_grows_to_the_largest():
    for rows, columns in [(2, 2), (10, 10), (3, 7), (40, 5)]:
        values = [P.normal_chi2(r, rows, columns) for r in (0, 0.2, 0.5, 0.8, 0.95, 0.999)] + [P.normal_chi2(1.0, rows, columns)]
        assert values[0] == pytest.approx(0, abs=1e-12) and values == sorted(values)
        assert rows != columns or values[-1] == pytest.approx(rows - 1, rel=1e-6)


def serial(x, y, bins=10):
    """phi_K of two pandas columns by cross table and bisection on the direct integral."""
    def codes(v):
        if v.dtype.kind in "if":
            return np.minimum(np.floor((v - v.min()) / (v.max() - v.min()) * bins), bins - 1)
        return v
    both = pd.concat([codes(x), codes(y)], axis=1).dropna()
    t = pd.crosstab(both.iloc[:, 0], both.iloc[:, 1]).to_numpy(float)
    n, (r, k) = t.sum(), t.shape
    e = np.outer(t.sum(1), t.sum(0)) / n
    chi2, chance = ((t - e) ** 2 / e).sum(), (r - 1) * (k - 1)
    if chi2 <= chance:
        return 0.0
    goal = (chi2 - chance) / (n * (min(r, k) - 1) - chance) * P.normal_chi2(1.0, r, k)
    low, high = 0.0, 0.9999
    for _ in range(30):
        mid = (low + high) / 2
        low, high = (mid, high) if direct_chi2(mid, r, k) < goal else (low, mid)
    return low


def test_all_pairs_against_serial(spark):
    rng = np.random.default_rng(7)
    n = 1500
    x = rng.normal(size=n)
    t = pd.DataFrame({"x": x, "y.z": 0.7 * x + math.sqrt(1 - 0.49) * rng.normal(size=n), "alone": rng.normal(size=n),
                      "kind": np.where(x > 0.5, "high", np.where(x > -1, "middle", "low")), "whole": rng.integers(0, 4, n)})
    t.loc[rng.random(n) < 0.2, "y.z"] = np.nan
    t.loc[:20, "kind"] = None
    got = {(r["var1"], r["var2"]): r for r in P.phik_matrix(spark.createDataFrame(t).repartition(6)).collect()}
    assert len(got) == 10
    for (a, b), r in got.items():
        assert r["phi_k"] == pytest.approx(serial(t[a], t[b]), abs=2e-3), (a, b)
    assert got["x", "y.z"]["rows"] == t[["x", "y.z"]].dropna().shape[0]
    kept = P.phik(spark.createDataFrame(t)).collect()
    assert [(r["var1"], r["var2"]) for r in kept][:1] == [("x", "kind")] and all(r["phi_k"] >= 0.5 and r["label"] for r in kept)


@pytest.mark.parametrize("rho", [0.2, 0.7, 0.9])
def test_table_of_a_normal_distribution_has_its_correlation(rho):
    fine = np.linspace(-5, 5, 20_001)
    mid = (fine[1:] + fine[:-1]) / 2
    density = np.exp(-mid ** 2 / 2) / math.sqrt(2 * math.pi) * (fine[1] - fine[0])
    cdf = np.vectorize(lambda v: 0.5 * math.erfc(-v / math.sqrt(2)))
    edges = np.linspace(-5, 5, 11)
    share = density[:, None] * np.diff(cdf((edges[None, :] - rho * mid[:, None]) / math.sqrt(1 - rho * rho)), axis=1)
    counts = np.rint(share.reshape(10, 2000, 10).sum(axis=1) * 1e15).astype(np.int64)
    a, b = np.nonzero(counts)
    got = P._solved(pd.DataFrame({"i": 0, "j": 1, "a": a, "b": b, "n": counts[a, b]}))
    assert got["phi_k"][0] == pytest.approx(rho, abs=1e-3)


def test_equal_columns_levels_and_odd_values(spark):
    rows = [(i % 5, str(i % 5), "one", f"id{i}", float("inf") if i == 3 else (float("nan") if i == 4 else float(i % 5))) for i in range(200)] + [(None, None, None, None, None)]
    df = spark.createDataFrame(rows, "a int, b string, one string, id string, f double")
    got = {(r["var1"], r["var2"]): r for r in P.phik_matrix(df, most_levels=50).collect()}
    assert got["a", "b"]["phi_k"] == 1.0 and got["a", "b"]["rows"] == 200
    assert got["a", "f"]["phi_k"] == 1.0 and got["a", "f"]["rows"] == 198
    assert got["a", "one"]["phi_k"] is None and got["a", "one"]["levels2"] == 1
    assert got["a", "id"]["phi_k"] is None and got["a", "id"]["rows"] is None
    labels = {(r["var1"], r["var2"]): r["label"] for r in P.phik(df, most_levels=50).collect()}
    assert labels["a", "id"] == "not compared" and labels["a", "b"] == "very high" and ("a", "one") not in labels


def test_empty_table_and_single_column(spark):
    empty = spark.createDataFrame([], "a int, b string, c double")
    assert [r["phi_k"] for r in P.phik_matrix(empty).collect()] == [None] * 3
    assert P.phik_matrix(empty, ["a"]).count() == 0


def test_text_is_coded_and_counted_in_one_worker():
    batch = pa.record_batch({"c0": pa.array([0, 1, None, 1], pa.int32()), "c1": pa.array(["y", "x", "x", None])})
    out = pa.Table.from_batches(P._cells([(0, 2), (1, 2)], {1: pa.array(["x", "y"])})([batch]))
    assert out.to_pylist() == [{"i": 0, "j": 1, "a": 0, "b": 1, "n": 1}, {"i": 0, "j": 1, "a": 1, "b": 0, "n": 1}]
