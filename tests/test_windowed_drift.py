"""Windowed drift: the stream's counts give the batch drift of the same days; leakage counts."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from riskframe.operators import monitor as J
from riskframe.operators import profile as P
from riskframe.streaming import drift as W

SCHEMA = "ts timestamp, a double, b int"
DAY0 = dt.datetime(2024, 5, 1)


def rows(seed, days, n=60, shift=0.0):
    rng = np.random.default_rng(seed)
    return [(DAY0 + dt.timedelta(days=int(d), minutes=i), None if i % 17 == 0 else float(round(rng.normal() + shift * d, 2)), int(rng.integers(0, 9)))
            for d in days for i in range(n)]


def plain(df):
    return {r["feature"]: tuple(round(v, 8) if isinstance(v, float) else v for v in r) for r in df.collect()}


def test_trailing_drift_is_the_batch_drift_of_the_same_days(spark, tmp_path):
    """Three files, the last with late rows of an earlier day; a second run adds nothing."""
    batches = [rows(1, range(0, 8)), rows(2, range(8, 13), shift=0.1), rows(3, (13, 9, 2))]
    for i, b in enumerate(batches):
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = lambda: (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in"))
    for _ in range(2):
        W.keep_counts(stream(), str(tmp_path), ["a", "b"])
    counts = W.kept_counts(spark, str(tmp_path))
    every = spark.createDataFrame([r for b in batches for r in b], SCHEMA)
    reference = spark.createDataFrame(rows(9, range(5)), SCHEMA).select("a", "b")
    assert counts.agg(F.sum("n")).first()[0] == every.agg(F.count("a") + F.count("b")).first()[0]
    for last in (13, 10):
        recent = every.where((F.to_date("ts") > F.lit(DAY0 + dt.timedelta(days=last - 7)).cast("date")) & (F.to_date("ts") <= F.lit(DAY0 + dt.timedelta(days=last)).cast("date")))
        as_of = None if last == 13 else (DAY0 + dt.timedelta(days=last)).date()
        got = W.trailing_drift(counts, W.value_counts(reference, ["a", "b"]), as_of=as_of)
        want = J.ks_drift(reference, recent.select("a", "b"))
        assert plain(got) == plain(want) and set(plain(got)) == {"a", "b"}


def test_few_samples_give_no_verdict(spark):
    counts = W.value_counts(spark.createDataFrame(rows(4, [0], n=50), SCHEMA).withColumn("day", F.to_date("ts")), ["a", "b"], ["day"])
    reference = W.value_counts(spark.createDataFrame(rows(5, [0]), SCHEMA), ["a", "b"])
    assert W.trailing_drift(counts, reference).count() == 0
    assert {r["feature"] for r in W.trailing_drift(counts, reference, least=48).collect()} == {"b"}


def test_leakage_report_counts_past_the_top_ten(spark):
    df = spark.range(200).select((F.col("id") % 2).cast("int").alias("target"), *[((F.col("id") % 2) * i + F.col("id") * 1e-4).alias(f"v{i}") for i in range(1, 16)])
    got = {r["check"]: r["count"] for r in P.leakage_report(df).collect()}
    assert got["high_correlation"] == 15 and P.leakage_correlation(df).count() == 10
