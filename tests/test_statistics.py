"""Metrics, drift and association statistics against brute force / hand computation."""

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from riskframe.operators import metrics as K
from riskframe.operators import monitor as J
from riskframe.operators import stats as S


def _auc_brute(y, s):
    pos = [a for a, b in zip(s, y) if b == 1]
    neg = [a for a, b in zip(s, y) if b == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_auc_with_ties(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400) + 0.3 * y, 1)
    df = spark.createDataFrame(pd.DataFrame({"label": y, "score": s, "prediction": (s > 0.6).astype(int)}))
    got = K.binary_metrics(df).first().roc_auc
    assert abs(got - _auc_brute(y, s)) < 1e-12


def test_average_precision_step_rule(spark):
    # scores .9 .8 .7 .6 .5 with labels 1 0 1 1 0: AP = (1/3)(1) + (1/3)(2/3) + (1/3)(3/4)
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (1, 0.6), (0, 0.5)], "label int, score double")
    ap = K.average_precision(df).first().average_precision
    assert abs(ap - (1 + 2 / 3 + 3 / 4) / 3) < 1e-12


def test_ks_statistic_brute_force(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(0, 1, 300).round(2), rng.normal(0.3, 1, 200).round(2)
    ref = spark.createDataFrame(pd.DataFrame({"x": a}))
    cur = spark.createDataFrame(pd.DataFrame({"x": b}))
    d = J.ks_drift(ref, cur, ["x"]).first()
    grid = np.union1d(a, b)
    brute = max(abs((a <= v).mean() - (b <= v).mean()) for v in grid)
    assert abs(d.ks_statistic - brute) < 1e-12
    assert 0 <= d.p_value <= 1 and d.drift_detected == (d.p_value < 0.1)


def test_chi2_yates_2x2(spark):
    # table [[10, 20], [30, 5]]: scipy-style Yates correction by hand
    rows = [("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 30 + [("b", "y")] * 5
    df = spark.createDataFrame(rows, "u string, v string")
    t = S.chi2_tables(S.contingency(df, [("u", "v")])).first()
    o = np.array([[10, 20], [30, 5]], float)
    e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
    d = np.abs(o - e)
    want = (((d - np.minimum(0.5, d)) ** 2) / e).sum()
    assert abs(t.chi2 - want) < 1e-9 and abs(t.phi - np.sqrt(want / 65)) < 1e-12


def test_chi2_general_with_empty_cells(spark):
    rows = [("a", "x")] * 5 + [("b", "y")] * 7 + [("c", "z")] * 3 + [("a", "y")] * 2
    df = spark.createDataFrame(rows, "u string, v string")
    t = S.chi2_tables(S.contingency(df, [("u", "v")])).first()
    o = pd.crosstab(pd.Series([r[0] for r in rows]), pd.Series([r[1] for r in rows])).to_numpy(float)
    e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
    assert abs(t.chi2 - ((o - e) ** 2 / e).sum()) < 1e-9


def test_anova_p_value(spark):
    rows = [("a", x) for x in (1.0, 2.0, 3.0)] + [("b", x) for x in (2.0, 4.0, 6.0)]
    a = S.anova(spark.createDataFrame(rows, "g string, v double"), "g", ["v"]).first()
    # SSB = 6, SSW = 10 -> F = (6/1)/(10/4) = 2.4 with (1, 4) df; tail p = 0.19626 (numeric integration)
    assert abs(a.f_statistic - 2.4) < 1e-12 and abs(a.p_value - 0.19626) < 1e-4


def test_group_bias_ignores_single_group(spark):
    df = spark.createDataFrame([(1, 1, "m", "x"), (0, 1, "f", "x"), (1, 1, "f", "x")],
                               "label int, prediction int, sex string, region string")
    g = J.group_bias(df, ["sex", "region"]).collect()
    assert {r.attribute for r in g} == {"sex"}


def test_kde_peak_matches_numpy(spark):
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(0, 1, 300), rng.normal(4, 0.5, 200)]).round(3)
    got = S.kde_peak(spark.createDataFrame(pd.DataFrame({"x": x})), ["x"], bins=None).first()
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 1000)
    dens = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
    assert abs(got.peak - grid[dens.argmax()]) < 1e-9 and abs(got.peak_density - dens.max()) < 1e-9
