"""phi_K of columns of many levels: all pairs are compared, by codes or by exchanges alike."""

import numpy as np
import pandas as pd
import pytest

from riskframe.operators import phik as P


def by_hand(x, y):
    both = pd.concat([x, y], axis=1).dropna()
    t = pd.crosstab(both.iloc[:, 0], both.iloc[:, 1]).to_numpy(float)
    expected = np.outer(t.sum(1), t.sum(0)) / t.sum()
    return len(both), *t.shape, P.from_chi2(((t - expected) ** 2 / expected).sum(), len(both), *t.shape)


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(11)
    n = 5_000
    place = rng.integers(0, 1_300, n)
    t = pd.DataFrame({"town": [f"t{p:04d}" for p in place], "half": np.where(rng.random(n) < 0.9, place < 600, rng.random(n) < 0.5).astype(int),
                      "street": [f"s{(p * 7 + k) % 30}" for p, k in zip(place, rng.integers(0, 3, n))], "kind": rng.choice(list("abc"), n),
                      "one": "one", "id": [f"id{i}" for i in range(n)]})
    t.loc[:30, "town"] = None
    t.loc[20:60, "kind"] = None
    return t


def test_pairs_of_many_levels_are_compared(spark, table):
    got = {(r["var1"], r["var2"]): r for r in P.phik_matrix(spark.createDataFrame(table).repartition(4)).collect()}
    assert len(got) == 15
    for (a, b), r in got.items():
        n, left, right, phi = by_hand(table[a], table[b])
        assert (r["rows"], r["levels1"], r["levels2"]) == (n, left, right), (a, b)
        assert r["phi_k"] is None if phi is None else r["phi_k"] == pytest.approx(phi, abs=1e-6), (a, b)
    assert got["half", "id"]["phi_k"] == 1.0 and got["town", "one"]["phi_k"] is None and 0.5 < got["town", "half"]["phi_k"] < 1
    listed = P.phik(spark.createDataFrame(table)).collect()
    assert "not compared" not in {r["label"] for r in listed} and ("town", "half") in {(r["var1"], r["var2"]) for r in listed}


def test_exchanges_give_what_codes_give(spark, table, monkeypatch):
    df = spark.createDataFrame(table[["half", "kind", "one"]].assign(day=pd.to_datetime("2020-01-01") + pd.to_timedelta(table.index % 9, "D"), none=None), "half int, kind string, one string, day timestamp, none string").repartition(3)
    coded = sorted(map(tuple, P.phik_matrix(df).collect()))
    monkeypatch.setattr(P, "CODED_LEVELS", 0)
    exchanged = sorted(map(tuple, P.phik_matrix(df).collect()))
    assert [r[:5] for r in coded] == [r[:5] for r in exchanged]
    for a, b in zip(coded, exchanged):
        assert a[5] == b[5] if a[5] is None or b[5] is None else a[5] == pytest.approx(b[5], abs=1e-6)


@pytest.mark.parametrize("rows,columns", [(2, 3), (40, 7), (7, 40), (60, 60)])
def test_diagonal_is_the_whole_table(rows, columns):
    (x, px), (y, py) = P._normal(rows), P._normal(columns)
    low, high = np.maximum.outer(x[:-1], y[:-1]), np.minimum.outer(x[1:], y[1:])
    share = P._mass(low.ravel(), np.maximum(low, high).ravel()).reshape(low.shape)
    assert P.normal_chi2(1.0, rows, columns) == pytest.approx(((share - np.outer(px, py)) ** 2 / np.outer(px, py)).sum(), rel=1e-9)


def test_diagonal_in_blocks_and_resolution(monkeypatch):
    whole, fine = P.normal_chi2(1.0, 900, 311), P.from_chi2(8_000.0, 20_000, 900, 11)
    monkeypatch.setattr(P, "CELLS", 64)
    assert P.normal_chi2(1.0, 900, 311) == pytest.approx(whole, rel=1e-12)
    monkeypatch.setattr(P, "STEPS", 300)  # seven times as wide as in use: errors go by the square
    assert P.from_chi2(8_000.0, 20_000, 900, 11) == pytest.approx(fine, abs=5e-5)
