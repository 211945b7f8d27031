"""Fits of many passes use all cores; a grid's points share their fold's features."""

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from riskframe.operators import cleaning as C
from riskframe.operators import ml as ML


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=240)
    rows = [(float(a), "xyz"[i % 3], float(a + rng.normal() > 0), int(i % 2)) for i, a in enumerate(x)]
    return spark.createDataFrame(rows, "a double, c string, label double, fold int").repartition(6)


def test_weights_leave_rows_where_they_are(spark, data):
    plain = {tuple(r) for r in C.with_class_weights(data, "label").select("a", "weight").collect()}
    weighted = C.with_class_weights(data, "label", classes=2)
    assert {tuple(r) for r in weighted.select("a", "weight").collect()} == plain
    assert weighted.select(F.spark_partition_id().alias("p")).distinct().count() == 6  # by class there would be two


def test_few_tasks_are_dealt_to_all_cores(spark, data, monkeypatch):
    monkeypatch.setattr(ML, "TASK_ROWS", 10)
    cores = spark.sparkContext.defaultParallelism
    wide = ML.spread(data.coalesce(1), 240)
    assert wide.rdd.getNumPartitions() == min(cores, 24) and wide.count() == 240
    assert ML.spread(data.coalesce(1), 9).rdd.getNumPartitions() == 1


def test_points_share_the_features_of_a_fold(spark, data, monkeypatch):
    fits, fit = [], StringIndexer._fit
    monkeypatch.setattr(StringIndexer, "_fit", lambda self, df: fits.append(1) or fit(self, df))
    best, results = ML.grid_search(data, "logistic_regression", ["a"], ["c"], grid={"C": [0.01, 1.0, 100.0]})
    assert len(fits) == 2 + 1  # a fold each, and the best point on all rows
    rows = results.collect()
    assert len(rows) == 3 and best.stages[-1].getRegParam() == float(max(rows, key=lambda r: r["mean_auc"])["params"]["regParam"])
    for r in rows:  # each point fitted again by hand on the whole pipeline
        c = 1 / (float(r["params"]["regParam"]) * 240)
        again = []
        for f in (0, 1):
            m = ML.build_pipeline("logistic_regression", ["a"], ["c"], n=240, C=c).fit(data.where(F.col("fold") != f))
            again.append(ML.binary_metrics(ML.score(m, data.where(F.col("fold") == f), "m"), ["model"]).first()["roc_auc"])
        assert abs(np.mean(again) - r["mean_auc"]) < 1e-6


def test_a_fold_without_rows_is_refused(spark, data):
    with pytest.raises(ValueError):
        ML.grid_search(data.withColumn("fold", F.col("fold") * 2), "logistic_regression", ["a"], grid={"C": [1.0]})
