"""Windowed prediction-log monitors (M1–M6), batch and Structured Streaming.

Metrics are one transformation for a table and for a ``readStream`` source:
tumbling or sliding ``window()`` aggregates keyed by time, with a watermark on
the stream so state for closed windows is dropped.  The exact p95 and the
wide table of alerts are for tables; alert rules on a stream, with their hold
timers, are in ``alerts``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import applications as A
from ..operators.core import col
from ..operators.scoring import validate_applications
from ..session import ensure_checkpoint_dir
from .alerts import gauge_windows

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
ERROR_RATE_PER_SEC = 0.1      # 5xx per second over 5 min
LATENCY_P95_MS = 1000.0       # p95 over 5 min
FAILURES_IN_5MIN = 5          # failed predictions over 5 min
CPU_PCT, MEMORY_PCT = 80.0, 85.0


def prediction_metrics(log: DataFrame, ts: str = "ts", window: str = "1 hour") -> DataFrame:
    """M1: per tumbling window: total, approval / rejection rate, mean ms, error rate."""
    w = F.window(col(ts), window)
    return log.groupBy(w.alias("w")).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("prediction") == 0).alias("approved"),
        F.count_if(F.col("prediction") == 1).alias("rejected"),
        F.avg("processing_ms").alias("avg_processing_ms"),
        F.count_if("is_error").alias("errors"))


def look_back(log: DataFrame, hours: int = 24, ts: str = "ts") -> DataFrame:
    """The log's last ``hours`` (1 to 168), counted from its newest row."""
    if not 1 <= hours <= 168:
        raise ValueError(f"hours must be between 1 and 168, not {hours}")
    last = log.select(F.max(col(ts))).scalar()  # one number, found by Spark as a subquery
    return log.where(col(ts) >= last - F.make_interval(hours=F.lit(hours)))


def finish_metrics(agg: DataFrame) -> DataFrame:
    """Flatten the window struct to a text start and derive the rates."""
    return agg.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "total",
                      F.round(F.col("approved") / F.col("total"), 6).alias("approval_rate"),
                      F.round(F.col("rejected") / F.col("total"), 6).alias("rejection_rate"),
                      F.round("avg_processing_ms", 6).alias("avg_processing_ms"),
                      F.round(F.col("errors") / F.col("total"), 6).alias("error_rate"))


def sliding_counts(log: DataFrame, ts: str = "ts", length: str = "5 minutes", slide: str = "1 minute",
                   exact_p95: bool = True) -> DataFrame:
    """Per sliding window: requests, errors and the p95 latency
    (exact percentile in batch; ``exact_p95=False`` for streams)."""
    w = F.window(col(ts), length, slide)
    p95 = F.percentile("processing_ms", 0.95) if exact_p95 else F.percentile_approx("processing_ms", 0.95, 10000)
    return log.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("requests"),
                                         F.count_if("is_error").alias("errors"), p95.alias("p95_ms"))


#: consecutive true evaluations, at a slide of one minute, before each alert fires
HOLD_WINDOWS = {"high_error_rate": 3, "high_latency": 3, "prediction_failures": 2}


def alert_windows(counts: DataFrame, hold_windows: dict[str, int] = HOLD_WINDOWS, window_seconds: int = 300, slide_seconds: int = 60,
                  error_rate: float = ERROR_RATE_PER_SEC, p95_ms: float = LATENCY_P95_MS,
                  failures: int = FAILURES_IN_5MIN) -> DataFrame:
    """M2–M4 on sliding-window counts: each condition per window and whether
    it held for its number of consecutive window starts (2 min for errors and
    latency, 1 min for failures at a 1 min slide): each true window counts
    towards its own start and the next ones, and a start fires when all of
    them arrived, so a gap in the windows ends the hold and no task sees all
    windows."""
    base = counts.select(F.col("w.start").alias("_s"), "requests", "errors", "p95_ms").withColumns({
        "high_error_rate": (F.col("errors") / window_seconds) > error_rate,
        "high_latency": F.col("p95_ms") > p95_ms,
        "prediction_failures": F.col("errors") > failures})
    ahead = F.explode(F.sequence(F.lit(0), F.lit(max(hold_windows.values()) - 1))).alias("_k")
    votes = base.select("_s", *hold_windows, ahead).select(
        F.timestamp_seconds(F.unix_timestamp(F.col("_s").cast("timestamp")) + F.col("_k") * slide_seconds).alias("_t"),
        *[(F.col(c) & (F.col("_k") < n)).alias(c) for c, n in hold_windows.items()])
    votes = votes.groupBy("_t").agg(*[F.count_if(F.col(c)).alias(f"_{c}") for c in hold_windows])
    held = {f"{c}_firing": F.coalesce(F.col(f"_{c}") == n, F.lit(False)) for c, n in hold_windows.items()}
    return base.join(votes, F.col("_s").cast("timestamp") == F.col("_t"), "left").withColumns(held).select(
        F.date_format("_s", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "requests", "errors",
        F.round("p95_ms", 6).alias("p95_ms"), *hold_windows, *held.keys())


def gauge_over_threshold(gauges: DataFrame, name: str, threshold: float, ts: str = "ts",
                         length: str = "5 minutes", slide: str = "1 minute", step_seconds: int = 60) -> DataFrame:
    """M5: a gauge is over its threshold for a window when its minimum there
    exceeds the threshold and the window is fully covered by samples
    (one sample per ``step_seconds`` at least)."""
    w = gauge_windows(gauges.where(F.col("name") == name), threshold, ts, (), length, slide, f"{step_seconds} seconds")
    return w.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "min_value", "firing")


# ---------------------------------------------------------------------------
# streaming drivers
# ---------------------------------------------------------------------------

def read_table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A file stream over one driver table (new parquet files = new rows)."""
    path = f"{sf_dir}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory():
        return stream.parquet(path)  # a table written as a folder of part files
    return stream.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def prediction_log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table_stream(spark, sf_dir, "events")
    et = F.col("event_type")
    return ev.select(F.col("event_id").alias("request_id"), F.col("ts").cast("timestamp").alias("ts"),
                     F.col("user_id"), et.alias("event_type"),
                     F.when(et.isin("purchase", "view"), 0).otherwise(1).cast("int").alias("prediction"),
                     (et == "error").alias("is_error"), F.col("value").alias("processing_ms"))


def run_to_table(agg: DataFrame, spark: SparkSession, mode: str = "complete") -> DataFrame:
    """Run a streaming aggregate to completion (availableNow) into a memory
    table and return it.  Window aggregates are bounded by the number of
    windows, so the memory sink is safe here; the checkpoint lives under
    the session's shared checkpoint folder."""
    name = f"rf_stream_{uuid.uuid4().hex[:12]}"
    ckpt = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    q = (agg.writeStream.outputMode(mode).format("memory").queryName(name)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.table(name)


def run_to_files(rows: DataFrame, spark: SparkSession) -> DataFrame:
    """Run an appending stream over all there is (availableNow) into a table under
    the session's shared checkpoint folder and return it: rows stay off the driver."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rf_stream_{uuid.uuid4().hex[:12]}"
    q = (rows.writeStream.outputMode("append").format("parquet").option("path", f"{base}/rows")
         .option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{base}/rows")


def prediction_metrics_stream(spark: SparkSession, sf_dir: str, window: str = "1 hour",
                              watermark: str = "10 minutes") -> DataFrame:
    """M1 on the event stream: watermark + tumbling windows, complete output."""
    log = prediction_log_stream(spark, sf_dir).withWatermark("ts", watermark)
    return finish_metrics(run_to_table(prediction_metrics(log, "ts", window), spark))


def application_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan applications as a stream: new order files joined (stream-static,
    broadcast-free equi-join) to the customer table."""
    from ..plans import inputs as I
    orders = read_table_stream(spark, sf_dir, "orders")
    return I.applications_from(orders, I.table(spark, sf_dir, "customer"))


def scorecard_summary_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 end to end: application stream → validation → scorecard → per-segment
    totals (complete mode; bounded by the number of segments)."""
    from ..operators.scoring import scorecard_summary
    return run_to_table(scorecard_summary(application_stream(spark, sf_dir), by="segment"), spark)


def score_stream(apps_stream: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M6: stateless scorecard over an application stream → (scored valid, quarantine)."""
    v = validate_applications(apps_stream)
    scored = A.scorecard(A.fill_defaults(v.where("is_valid").drop("reasons", "is_valid"))).withColumn(
        "features_importance", F.create_map(*[x for k, w in A.SCORECARD_IMPORTANCE.items() for x in (F.lit(k), F.lit(w))]))
    return scored, v.where(~F.col("is_valid")).drop("is_valid")


def scored_streams(apps_stream: DataFrame, spark: SparkSession, scorer) -> tuple[DataFrame, DataFrame]:
    """Run both sides of ``scorer`` (stream → scored, quarantined) over all there is
    into tables: two appending queries with a checkpoint each."""
    return tuple(run_to_files(side, spark) for side in scorer(apps_stream))
