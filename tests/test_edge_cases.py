"""Edge cases: expected values are worked out by hand or taken from tables,
never computed by the formula under test."""

import datetime as dt
import math
import shutil

import pytest
from pyspark.sql import functions as F

from riskframe.operators import cleaning, metrics, ml, monitor, profile, quality, sampling, schema_ops, stats
from riskframe.sources import files
from riskframe.streaming import monitors


def test_kolmogorov_p_values(spark):
    # tabulated: Q(0.5) = 0.9639452, Q(1) = 0.2699997, Q(1.36) = 0.0494858 (the 5 % point 1.358)
    n = 4e12
    rows = [(0.5, 0.9639452), (1.0, 0.2699997), (1.36, 0.0494858), (0.1, 1.0), (0.001, 1.0)]
    df = spark.createDataFrame(rows, "lam double, want double")
    root = math.sqrt(n / 2)
    p = monitor.kolmogorov_pvalue(F.col("lam") / (root + 0.12 + 0.11 / root), F.lit(n), F.lit(n))
    for r in df.withColumn("p", p).collect():
        assert abs(r.p - r.want) < 1e-6, r


def test_one_changed_row_is_no_drift(spark):
    a = spark.range(20_000).select(F.col("id").cast("double").alias("x"))
    b = a.select(F.when(F.col("x") == 7, -1.0).otherwise(F.col("x")).alias("x"))
    r = monitor.ks_drift(a, b, ["x"]).first()
    assert r.p_value > 0.999 and not r.drift_detected


def test_null_strata_and_groups_stay(spark):
    df = spark.range(100).select("id", F.when(F.col("id") % 10 != 0, (F.col("id") % 2).cast("int")).alias("target"))
    split = sampling.stratified_split(df, ["id"], "target", 0.2)
    assert split.count() == 100 and split.where("target IS NULL AND split = 'test'").count() == 2
    assert sampling.stratified_folds(df, ["id"], "target", 5).count() == 100
    scored = spark.createDataFrame([("a", 1, 0.9), ("a", 0, 0.1), (None, 1, 0.8), (None, 0, 0.9)], "m string, label int, score double")
    roc = metrics.roc_curve(scored, ["m"]).where("m IS NULL").orderBy("fpr", "tpr").collect()
    assert [(r.fpr, r.tpr) for r in roc] == [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]
    assert metrics.pr_curve(scored, ["m"]).where("m IS NULL").count() == 3
    assert {r.m: r.roc_auc for r in metrics.roc_auc(scored, ["m"]).collect()} == {"a": 1.0, None: 0.0}


def test_infinite_scores(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1, inf), (0, -inf), (1, 0.5), (0, 0.4), (0, inf)] * 3, "label int, score double")
    # of six positive-negative pairs: inf ties with inf, beats two; 0.5 loses to inf, beats two
    assert metrics.roc_auc(df).first().roc_auc == pytest.approx(4.5 / 6)


def test_stream_reads_a_folder_table(spark, tmp_path):
    src = "/root/testdata/sf0.001/events.parquet"
    one = f"{tmp_path}/file"
    spark.read.parquet(src).repartition(3).write.parquet(f"{tmp_path}/folder/events.parquet")
    import os
    os.makedirs(one)
    shutil.copy(src, f"{one}/events.parquet")
    n = spark.read.parquet(src).count()
    for place in (f"{tmp_path}/folder", one):
        got = monitors.run_to_table(monitors.read_table_stream(spark, place, "events").groupBy().count(), spark)
        assert got.first()["count"] == n


def test_hold_needs_windows_without_a_gap(spark):
    t0 = dt.datetime(2024, 1, 1, 12, 0)
    at = [t0 + dt.timedelta(minutes=m) for m in (0, 1, 2, 10, 12, 13)] + [dt.datetime(2024, 1, 5)]
    counts = spark.createDataFrame([((t, t), 100, 90, 5.0) for t in at],
                                   "w struct<start:timestamp,end:timestamp>, requests long, errors long, p95_ms double")
    got = {r.window_start[11:16] + r.window_start[8:10]: r.high_error_rate_firing for r in monitors.alert_windows(counts).collect()}
    assert got == {"12:0001": False, "12:0101": False, "12:0201": True, "12:1001": False, "12:1201": False, "12:1301": False, "00:0005": False}


def test_chi2_with_margins_beyond_a_long(spark):
    big = 5_000_000_000
    counts = spark.createDataFrame([("a", "b", x, y, big) for x in "pqr" for y in "st"], "var1 string, var2 string, cat1 string, cat2 string, n long")
    assert stats.chi2_tables(counts).first().chi2 == pytest.approx(0.0)


def test_missing_totals(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x"), (4, "y")], "a int, b string")
    r = quality.missing_totals(df).first()
    assert (r.total_missing, r.total_missing_pct) == (3, 37.5)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "a int, b string, c double")
    assert {r.null_pct for r in profile.profile(df).collect()} == {None}
    assert {r.critical for r in quality.check_missing(df).collect()} == {False}
    assert quality.check_categorical(df).first().n_distinct == 0
    assert quality.quality_report(df).first().duplicate_rows == 0
    assert quality.missing_totals(df).first().total_missing == 0
    assert schema_ops.find_target_column(df) is None


def test_anova_without_spread(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 1.0), ("y", 2.0), ("y", 2.0)], "g string, v double")
    r = stats.anova(df, "g", ["v"]).collect()
    assert len(r) == 1 and (r[0].f_statistic is None or math.isnan(r[0].f_statistic))


def test_one_numeric_column(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "x double, s string")
    assert stats.correlations(df).count() == 0 and stats.pair_density(df).count() == 0 and stats.pearson_pairs(df).count() == 0


def test_importance_has_the_columns_names(spark):
    df = spark.range(200).select((F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 2 + F.rand(1)).alias("x"),
                                 F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")).alias("kind"))
    model = ml.build_pipeline("random_forest", ["x"], ["kind"], numTrees=5, maxDepth=3).fit(df)
    got = ml.feature_importance(model, df)
    assert set(got) == {"x", "kind"} and got["x"] > got["kind"] and sum(got.values()) == pytest.approx(1.0)


def test_one_hot_of_null_is_zero(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert sorted(r.k_b for r in cleaning.one_hot_drop_first(df, ["k"]).collect()) == [0.0, 0.0, 1.0]
    assert cleaning.one_hot_drop_first(df, ["k"], categories={"k": ["b", "a"]}).columns == ["k", "k_a"]


def test_target_null_rows_are_no_group(spark):
    df = spark.createDataFrame([("x", 1), ("x", None), ("y", 0)] * 5, "k string, target int")
    assert {r.target for r in profile.categorical_vs_target(df, "target", ["k"]).collect()} == {0, 1}


def test_target_names(spark):
    frame = lambda *names: spark.createDataFrame([], ", ".join(f"`{n}` int" for n in names))
    assert schema_ops.find_target_column(frame("a", "y", "Loan Status")) == "Loan Status"
    assert schema_ops.find_target_column(frame("a", "was_Charged", "z")) == "was_Charged"
    assert schema_ops.find_target_column(frame("default.payment.next.month", "target"), short=True) == "default.payment.next.month"
    binary = spark.createDataFrame([(1, 5), (2, 6), (3, 5)], "a int, b int")
    assert schema_ops.find_target_column(binary) == "b"
    assert [schema_ops.normalized_name(n) for n in (" A  b--C_", "__x__", "é1")] == ["a_b_c", "x", "1"]


def test_many_copies_of_a_row(spark):
    df = spark.range(25_001).select(F.lit(1).alias("a")).union(spark.range(3).select(F.col("id").cast("int") + 5))
    assert cleaning.duplicate_rows(df).count() == 25_000


def test_colliding_summaries_raise(spark, tmp_path):
    df = spark.range(1)
    with pytest.raises(ValueError):
        files.write_summaries({"n" * 31 + "1": df, "n" * 31 + "2": df}, str(tmp_path))


def test_prediction_log_appends_by_date(spark, tmp_path):
    from riskframe.operators import scoring
    rows = [("a", dt.datetime(2024, 1, 1, 5), 1, 0.9, 12.0), ("b", dt.datetime(2024, 1, 2, 5), 0, 0.2, 8.0)]
    df = spark.createDataFrame(rows, "request_id string, ts timestamp, prediction int, score double, processing_ms double")
    for _ in range(2):
        scoring.append_prediction_log(df, f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    assert log.count() == 4 and log.where("log_date = '2024-01-01'").count() == 2
    assert {r.probability for r in log.collect()} == {0.9, 0.2}
    r = scoring.prediction_stats(log).first()
    assert (r.total_predictions, r.approval_rate, r.avg_processing_ms, r.last_24h) == (4, 0.5, 10.0, 4)


def test_pay_status_cast(spark):
    from riskframe.functions import labels
    df = spark.createDataFrame([("-1",), ("2.0",), (None,)], "p string").select(labels.pay_status_cast(F.col("p").cast("double")).alias("v"))
    assert [r.v for r in df.collect()] == [-1, 2, None]
