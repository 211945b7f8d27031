"""Exact sampling and splits (sizes asserted by the reference's tests)."""

import pytest
from pyspark.sql import functions as F

from riskframe.operators import sampling as D


def test_sample_sizes(spark):
    assert D.sample_exact(spark.range(1000), ["id"], 0.2).count() == 200
    assert D.sample_exact(spark.range(100), ["id"], 0.5).count() == 50
    a = {r.id for r in D.sample_exact(spark.range(1000), ["id"], 0.2, seed=7).collect()}
    b = {r.id for r in D.sample_exact(spark.range(1000), ["id"], 0.2, seed=7).collect()}
    assert a == b


def test_split_conserves_rows_and_shares(spark):
    df = spark.range(1000).withColumn("target", (F.col("id") % 10 < 3).cast("int"))
    s = D.stratified_split(df, ["id"], "target", 0.2)
    assert s.count() == 1000 and s.where("split = 'test'").count() == 200
    shares = {r.split: r.bad_pct for r in D.split_class_shares(s).collect()}
    assert abs(shares["train"] - shares["test"]) < 10


def test_split_single_class_falls_back(spark):
    df = spark.range(100).withColumn("target", F.lit(0))
    assert D.stratified_split(df, ["id"], "target", 0.2).where("split = 'test'").count() == 20


def test_folds_balanced(spark):
    df = spark.range(1000).withColumn("target", (F.col("id") % 4 == 0).cast("int"))
    f = D.stratified_folds(df, ["id"], "target", k=5).groupBy("fold", "target").count().collect()
    by_class = {}
    for r in f:
        by_class.setdefault(r.target, []).append(r["count"])
    assert all(max(v) - min(v) <= 1 and len(v) == 5 for v in by_class.values())


@pytest.mark.parametrize("frac", [0.0, 0.1, 0.5, 1.0])
def test_samples_are_the_first_by_rank_without_an_exchange_of_rows(spark, frac):
    """The cut gives the rows that the full ranking gives, null and tiny strata included."""
    from riskframe.operators.core import hash_rank
    df = spark.range(3000).select("id", F.when(F.col("id") % 7 == 0, None).when(F.col("id") == 5, "one").otherwise((F.col("id") % 3).cast("string")).alias("s"),
                                  F.repeat(F.lit("payload"), 3).alias("_h"))
    ranked = hash_rank(df.drop("_h"), ["id"], 7, ["s"])
    want = {r["id"] for r in ranked.where(F.col("_rank") <= F.bround(F.lit(frac) * F.col("_stratum_n"), 0)).collect()}
    split = D.stratified_split(df, ["id"], "s", frac, seed=7)
    assert {r["id"] for r in split.where("split = 'test'").collect()} == want and split.count() == 3000
    assert split.columns == ["id", "s", "_h", "split"]
    sample = D.sample_exact(df, ["id"], frac, seed=7)
    whole = hash_rank(df.drop("_h"), ["id"], 7)
    assert {r["id"] for r in sample.collect()} == {r["id"] for r in whole.where(F.col("_rank") <= round(frac * 3000)).collect()}
    for plan in (df_plan(split), df_plan(sample)):
        assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan and "Window" not in plan


def df_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_samples_of_an_empty_table(spark):
    none = spark.createDataFrame([], "id long, s string")
    assert D.sample_exact(none, ["id"], 0.5).count() == 0 and D.stratified_split(none, ["id"], "s").count() == 0
