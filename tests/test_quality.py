"""Quality monitor and expectations."""

import pytest
from pyspark.sql import functions as F

from riskframe.operators import quality as Q
from riskframe.operators import schema_ops as B


def _f8(spark):
    return spark.range(100).select(
        (F.col("id") * 1.0).alias("feature1"), F.when(F.col("id") < 70, None).otherwise(F.lit(1.0)).alias("high_missing"),
        F.lit("a").alias("feature3"), (F.col("id") % 2).alias("target"))


def test_high_missing_is_critical(spark):
    m = {r.column: r for r in Q.check_missing(_f8(spark)).collect()}
    assert m["high_missing"].critical and m["high_missing"].missing_pct == 70.0 and not m["feature1"].critical


def test_drop_high_missing(spark):
    kept, dropped = B.drop_high_missing(_f8(spark), 0.6)
    assert dropped == ["high_missing"] and "high_missing" not in kept.columns


def test_quality_report_score(spark):
    r = Q.quality_report(_f8(spark)).first()
    # one missing-critical column (-5), constant feature3 and high_missing (-2 each)
    assert r.quality_score == 100 - 5 - 2 * 2 and r.passed


def test_expectations_missing_column_and_gate(spark):
    df = spark.createDataFrame([(5000.0, 30, 0, 1), (20000.0, 17, 1, 3)], "LIMIT_BAL double, AGE int, target int, SEX int")
    res = {r.idx: r for r in Q.run_expectations(df).collect()}
    assert res[5].unexpected_count == 1 and not res[5].success       # AGE 17 < 18
    assert res[8].unexpected_count == 1                               # SEX 3
    df2 = df.drop("AGE")
    res2 = {r.idx: r for r in Q.run_expectations(df2).collect()}
    assert not res2[1].success and not res2[5].success and res2[5].unexpected_count is None
    with pytest.raises(Q.QualityGateError):
        Q.quality_gate(df)


def test_normalize_names_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int")
    with pytest.raises(ValueError):
        B.normalize_column_names(df)
    assert B.normalize_column_names(spark.createDataFrame([(1,)], "`default.payment.next.month` int")).columns == \
        ["default_payment_next_month"]
