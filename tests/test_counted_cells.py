"""Trees of large tables are grown on counted cells of equal rows (K1-K4)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from riskframe.operators import ml as ML


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    n = 1_200
    age, kind, far = rng.integers(18, 40, n), rng.integers(0, 3, n), rng.lognormal(size=n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(age - 29) / 3 - (kind == 1)))).astype(float)
    t = pd.DataFrame({"age": age, "far": far, "c": pd.Series(list("xyz"))[kind].to_numpy(), "label": y, "w": np.where(y == 1, 1.5, 0.5)})
    t.loc[:9, "c"] = None
    return spark.createDataFrame(t).withColumn("far", F.when(F.col("far") > 0.2, F.col("far"))).repartition(4).persist()


def probabilities(model, df):
    return [r["score"] for r in ML.score(model, df, "m").collect()]


def test_boosted_trees_of_cells_are_those_of_rows(data):
    pipe = ML.build_pipeline("gradient_boosting", ["age"], ["c"], weight="w", maxIter=4, maxDepth=3)
    cells = ML.counted_cells(data, 1_200, ["age"], ["c"], "label", "w")
    assert cells.count() < 200 and cells.agg(F.sum("_rows")).first()[0] == 1_200
    on_cells = ML.fit_on_cells(pipe, data, cells, "label", "w")
    assert probabilities(on_cells, data) == pytest.approx(probabilities(pipe.fit(data), data), abs=1e-9)


def test_rows_fall_where_their_cells_fall(data):
    near = ML._nearest(data, ["age", "far"], "label", "w")
    assert len(near["age"]) == 22 and 25 < len(near["far"]) <= ML.BINS
    cells = ML.counted_cells(data, 1_200 * ML.CELL_SHARE, ["age", "far"], [], "label", None)
    assert cells.agg(F.sum("_rows")).first()[0] == 1_200
    model = ML.fit_on_cells(ML.build_pipeline("gradient_boosting", ["age", "far"], maxIter=3, maxDepth=4), data, cells, "label", None)
    count = lambda v: sorted((round(k, 9), n) for k, n in pd.Series(v).groupby(pd.Series(v).round(9)).count().items())
    rows = probabilities(model, data)
    many = ML.score(model, cells, "m", keep=["_rows"]).toPandas()
    assert count(rows) == count(np.repeat(many["score"], many["_rows"]).reset_index(drop=True))


def test_forest_of_cells(spark, data, tmp_path):
    rare = data.withColumn("label", F.when((F.col("age") == 39) & (F.col("far") > 3), 1.0).otherwise(0.0))
    assert 0 < rare.where("label = 1").count() < 12
    for df in (data, rare):   # a tree's sample may hold no row of the rare class
        cells = ML.counted_cells(df, 1_200, ["age"], ["c"], "label", None)
        pipe = ML.build_pipeline("random_forest", ["age"], ["c"], numTrees=24, maxDepth=4)
        model = ML.fit_on_cells(pipe, df, cells, "label", None)
        forest = model.stages[-1]
        assert forest.getNumTrees == 24 and forest.numClasses == 2
        assert df is rare or len({t.toDebugString.split("\n", 1)[1] for t in forest.trees}) > 1
        got = probabilities(model, df)
        assert np.abs(np.array(got) - probabilities(pipe.fit(df), df)).mean() < 0.06
        assert got == probabilities(ML.fit_on_cells(pipe, df, cells.repartition(3), "label", None), df)  # whatever the places of the cells
    assert ML.feature_importance(model, df).keys() == {"age", "c"}
    model.write().overwrite().save(str(tmp_path / "m"))
    assert probabilities(PipelineModel.load(str(tmp_path / "m")), df) == got


def test_draws_are_poisson():
    rows, keys = pd.Series([1, 40, 10**7] * 2), pd.Series([5, 2**62, -7] * 2)
    d = ML._draws(rows, keys, 4_000)
    assert (d[0] == d[3]).all() and (d[2] == d[5]).all()
    for r, x in zip(rows, d):
        assert abs(x.mean() / r - 1) < 5 / np.sqrt(4_000 * r) and abs(x.var() / r - 1) < 0.15


def test_large_tables_are_fitted_on_cells(data, monkeypatch):
    seen, fit = [], RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: seen.append(df.count()) or fit(self, df))
    monkeypatch.setattr(ML, "CELL_ROWS", 1_000)
    monkeypatch.setattr(ML, "RF_TREES", 3)
    models, errors = ML.train_models(data.drop("w"), ["age"], ["c"], kinds=("random_forest",), balanced=True)
    assert not errors and len(seen) == 3 and max(seen) < 200
    seen.clear()
    models, errors = ML.train_models(data.drop("w").withColumn("a", F.rand(1)).withColumn("b", F.rand(2)), ["age", "a", "b"], kinds=("random_forest",))
    assert not errors and seen == [1_200]   # nearly as many cells as rows
