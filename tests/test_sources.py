"""Scans and sinks round trips."""

import pytest
from pyspark.sql import functions as F

from riskframe.operators import ml as ML
from riskframe.sources import files as S


def test_csv_parquet_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, "a"), (2, None, None)], "id long, x double, s string")
    S.write_table(df, str(tmp_path / "t.csv"), fmt="csv")
    S.write_table(df, str(tmp_path / "t.parquet"))
    back_csv = S.read_table(spark, str(tmp_path / "t.csv"))
    back_pq = S.read_table(spark, str(tmp_path / "t.parquet"))
    assert back_csv.count() == 2 and back_csv.where("x IS NULL").count() == 1
    assert sorted(back_pq.collect()) == sorted(df.collect())
    with pytest.raises(ValueError):
        S.read_table(spark, str(tmp_path / "t.xlsx"))


def test_reports_summaries_and_metadata(spark, tmp_path):
    rep = spark.createDataFrame([("drift", 0.03)], "check string, value double")
    S.write_json_report(rep, str(tmp_path / "reports"))
    assert spark.read.json(str(tmp_path / "reports")).count() == 1
    names = S.write_summaries({"a_very_long_summary_name_over_thirty_one_chars": rep}, str(tmp_path / "sum"))
    assert names == ["a_very_long_summary_name_over_t"]
    tagged = S.with_feature_info(rep, {"value": "KS statistic"}, target="check")
    S.write_table(tagged, str(tmp_path / "meta"))
    info = S.feature_info(spark.read.parquet(str(tmp_path / "meta")))
    assert info["value"]["description"] == "KS statistic" and info["check"]["role"] == "target"


def test_model_directories(spark, tmp_path):
    df = spark.range(60).select((F.col("id") % 7).cast("double").alias("x"),
                                (F.col("id") % 2).cast("double").alias("label"))
    m = ML.build_pipeline("logistic_regression", ["x"], [], n=60).fit(df)
    saved = S.save_models({"Best Tuned LR": m, "failed": None, "scaler": m}, str(tmp_path / "models"))
    assert saved == ["best_tuned_lr", "scaler"]
    loaded = S.load_models(spark, str(tmp_path / "models"))
    assert list(loaded) == ["best_tuned_lr"]
    assert S.pick_model(spark, str(tmp_path / "models")).endswith("best_tuned_lr")
    assert loaded["best_tuned_lr"].transform(df).count() == 60
