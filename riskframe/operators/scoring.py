"""Batch scoring of application tables (L1–L6) and validation (C4).

The reference scores one request at a time; here every function takes a
table of applications and returns a table, all as one codegen'd
projection (no Python on the row path).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import applications as A
from .core import col


def validate_applications(df: DataFrame) -> DataFrame:
    """Add ``reasons`` (array of failed rules) and ``is_valid``."""
    return df.withColumn("reasons", A.rejection_reasons()).withColumn(
        "is_valid", F.size("reasons") == 0)


def split_applications(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows and the quarantine (rows with their rejection reasons)."""
    v = validate_applications(df)
    return v.where("is_valid").drop("reasons", "is_valid"), v.where(~F.col("is_valid"))


def validate_card_applications(df: DataFrame) -> DataFrame:
    """``rejection`` = first failed card rule (null when valid)."""
    return df.withColumn("rejection", A.card_rejection())


def validate_feedback(df: DataFrame, outcome: str = "actual_outcome") -> DataFrame:
    """Feedback rows whose outcome is 0 or 1."""
    return df.where(col(outcome).isin(0, 1))


def score_by_scorecard(df: DataFrame) -> DataFrame:
    """L1 over valid applications (defaults filled first)."""
    return A.scorecard(A.fill_defaults(df))


def scorecard_summary(apps: DataFrame, by: str = "segment") -> DataFrame:
    """Flagship: validate → scorecard on the valid rows → per-group totals.

    One scan, one projection, one hash aggregate (partial aggregation
    map-side, so a hot group costs one row per task before the shuffle).
    """
    v = validate_applications(apps)
    scored = A.scorecard(A.fill_defaults(v))
    valid = F.col("is_valid")
    approved = valid & (F.col("prediction") == 0)
    return scored.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_applications"),
        F.count_if(valid).alias("n_valid"),
        F.count_if(approved).alias("n_approved"),
        F.round(F.try_divide(F.count_if(approved), F.count_if(valid)), 6).alias("approval_rate"),
        F.round(F.avg(F.when(valid, F.col("score"))), 6).alias("avg_score"),
        F.round(F.sum(F.when(approved, F.col("recommended_amount"))), 2).alias("recommended_total"),
        F.count_if(valid & (F.col("confidence") == "low")).alias("n_low_confidence"),
    )


def append_prediction_log(scored: DataFrame, path: str, ts: str = "ts", request: str = "request_id",
                          prediction: str = "prediction", probability: str = "score", ms: str = "processing_ms") -> None:
    """Append request, prediction, probability and milliseconds to the log at
    ``path``, in folders by date; the log reads back with ``spark.read.parquet``."""
    (scored.select(col(request).cast("string").alias("request_id"), col(ts).cast("timestamp").alias("ts"),
                   col(prediction).cast("int").alias("prediction"), col(probability).cast("double").alias("probability"),
                   col(ms).cast("double").alias("processing_ms"), F.to_date(col(ts)).alias("log_date"))
     .write.mode("append").partitionBy("log_date").parquet(path))


def prediction_stats(log: DataFrame, ts: str = "ts", prediction: str = "prediction",
                     ms: str = "processing_ms") -> DataFrame:
    """L4: total, approval rate, mean processing ms, rows in the last 24 h of the log."""
    # scalar subquery: evaluated once, used as a literal in the aggregate
    last = log.select(F.max(col(ts))).scalar()
    return log.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.round(F.avg((col(prediction) == 0).cast("double")), 6).alias("approval_rate"),
        F.round(F.avg(col(ms)), 6).alias("avg_processing_ms"),
        F.count_if(col(ts) >= last - F.expr("INTERVAL 24 HOURS")).alias("last_24h"),
    )


def feedback_performance(log: DataFrame, feedback: DataFrame, key: str = "request_id") -> DataFrame:
    """Predictions labelled by their feedback (inner join on the request id)."""
    return log.join(validate_feedback(feedback), on=key, how="inner")
