"""Grid search through the run table: all points, resumed runs, failed points."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import ml as ML


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(160, 2))
    rows = [(float(a), float(b), float(a + 0.5 * rng.normal() > 0), int(i % 2)) for i, (a, b) in enumerate(x)]
    return spark.createDataFrame(rows, "a double, b double, label double, fold int")


def test_search_resumes_and_ranks(spark, data, tmp_path):
    path = f"{tmp_path}/runs"
    grid = {"maxDepth": [1, 3], "numTrees": [2, 6], "minInstancesPerNode": [1]}
    first = ML.tune(data, "random_forest", ["a", "b"], path, grid={**grid, "numTrees": [2]})
    assert first.count() == 2 and spark.read.parquet(path).count() == 4
    results = ML.tune(data, "random_forest", ["a", "b"], path, grid=grid)
    assert spark.read.parquet(path).count() == 8  # four points on two folds, four of them from before
    rows = results.orderBy("rank").collect()
    assert [r["rank"] for r in rows] == [1, 2, 3, 4] and all(r["folds"] == 2 and r["error"] is None and 0.5 < r["mean_auc"] <= 1 for r in rows)
    assert [r["mean_auc"] for r in rows] == sorted((r["mean_auc"] for r in rows), reverse=True)
    best = ML.best_point(results)
    assert {k: str(v) for k, v in best.items()} == rows[0]["params"]
    # the mean over the folds, fitted again by hand
    again = []
    for f in (0, 1):
        m = ML.build_pipeline("random_forest", ["a", "b"], **best).fit(data.where(F.col("fold") != f))
        again.append(ML.binary_metrics(ML.score(m, data.where(F.col("fold") == f), "m"), ["model"]).first()["roc_auc"])
    assert abs(np.mean(again) - rows[0]["mean_auc"]) < 1e-9
    # one value of minInstancesPerNode: it makes no difference
    importance = {r["param"]: r["importance"] for r in ML.param_importance(results).collect()}
    assert set(importance) == set(grid) and importance["minInstancesPerNode"] == 0


def test_failed_points_are_rows_and_are_tried_again(spark, data, tmp_path):
    path = f"{tmp_path}/runs"
    results = ML.tune(data, "gradient_boosting", ["a", "b"], path, grid={"maxIter": [2], "stepSize": [0.1, -1.0]}).orderBy("rank").collect()
    assert results[0]["error"] is None and results[0]["folds"] == 2
    assert results[1]["mean_auc"] is None and results[1]["folds"] == 0 and "stepSize" in results[1]["error"]
    ML.tune(data, "gradient_boosting", ["a", "b"], path, grid={"maxIter": [2], "stepSize": [0.1, -1.0]})
    assert spark.read.parquet(path).count() == 2 + 2 + 2
    with pytest.raises(RuntimeError):
        ML.best_point(ML.tune(data, "gradient_boosting", ["a", "b"], f"{tmp_path}/bad", grid={"stepSize": [-1.0]}))


def test_documented_grids():
    sizes = {k: len(ML.grid_points(g)) for k, g in ML.GRIDS.items()}
    assert sizes == {"logistic_regression": 3, "random_forest": 8, "random_forest_wide": 27, "gradient_boosting": 8}
    assert ML.grid_points({"a": [1, 2], "b": [3, 4]}) == [{"a": 1, "b": 3}, {"a": 1, "b": 4}, {"a": 2, "b": 3}, {"a": 2, "b": 4}]
