"""Drift over the trailing days of a stream (M7).

Each micro-batch is reduced to counts of (day, feature, value) and written to a
folder of its own, which a repeated batch overwrites, so every row counts once
however often a batch is tried.  The table of counts grows with the distinct
values of a day, not with the requests, and answers for any trailing window:
late rows go to the day they belong to.  Days before the window can be removed
by their folder of ``day``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.core import col, melt
from ..operators.monitor import drift_from_counts

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
LOOK_BACK_DAYS = 7
LEAST_SAMPLES = 100

COUNTS = "column string, value double, n long, day date"


def value_counts(rows: DataFrame, features: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys…, column, value, n) of the features' values, NaN and null left out."""
    long = melt(rows, keys, features).where(~F.isnan("value"))
    return long.groupBy(*[col(k) for k in keys], "column", "value").agg(F.count(F.lit(1)).alias("n"))


def keep_counts(stream: DataFrame, path: str, features: Sequence[str], ts: str = "ts") -> None:
    """Run ``stream`` over all there is and keep its value counts under ``path``."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        counts = value_counts(batch.where(col(ts).isNotNull()).withColumn("day", F.to_date(col(ts))), features, ["day"])
        counts.write.mode("overwrite").partitionBy("day").parquet(f"{path}/counts/batch={batch_id}")

    query = (stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start())
    query.awaitTermination()


def kept_counts(spark: SparkSession, path: str) -> DataFrame:
    """(column, value, n, day) of all batches."""
    return spark.read.schema(COUNTS + ", batch long").option("basePath", f"{path}/counts").option("recursiveFileLookup", "false").parquet(f"{path}/counts").drop("batch")


def trailing_drift(counts: DataFrame, reference: DataFrame, days: int = LOOK_BACK_DAYS, least: int = LEAST_SAMPLES, as_of=None) -> DataFrame:
    """J1 of the ``days`` up to ``as_of`` (the last day kept) against ``reference``
    (column, value, n): as ``ks_drift``, and days' first and last; features with
    fewer than ``least`` values in the window are left out."""
    end = F.lit(as_of).cast("date") if as_of is not None else counts.select(F.max("day")).scalar()
    recent = counts.where((F.col("day") <= end) & (F.col("day") > F.date_sub(end, days))).groupBy("column", "value").agg(F.sum("n").alias("n"))
    return drift_from_counts(reference, recent).where(F.col("current_n") >= least)
