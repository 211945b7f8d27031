"""Queries for alert rules with hold timers and gauges, batch and stream (M2–M5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import alerts as A
from ..streaming import monitors as M
from . import inputs as I
from .catalog import register

#: the log holds a few requests an hour: hours instead of minutes, thresholds to match
LENGTH, SLIDE, LATE = "1 hour", "10 minutes", "10 minutes"
HOURLY = (A.Rule("high_error_rate", "errors_per_second", 0.001, 1200, "warning"),
          A.Rule("high_latency", "p95_ms", 40.0, 1200, "warning"),
          A.Rule("prediction_failures", "errors", 4, 600, "critical"))


def _le(i: int) -> str:
    return f"le[{i}]" if i else "0"


BOUNDS = A.LATENCY_BOUNDS_MS
QUANTILE_SQL = "CASE WHEN n = 0 THEN NULL " + " ".join(
    f"WHEN {_le(i + 1)} >= 0.95 * n THEN {BOUNDS[i - 1] if i else 0} + {BOUNDS[i] - (BOUNDS[i - 1] if i else 0)} "
    f"* coalesce((0.95 * n - {_le(i)}) / nullif({_le(i + 1)} - {_le(i)}, 0), 1.0)" for i in range(len(BOUNDS))) + f" ELSE {BOUNDS[-1]} END"

ALERT_ROWS_SQL = I.with_ctes(I.PREDICTION_LOG_SQL) + """
, w AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts) - INTERVAL (10 * k) MINUTE AS s, is_error, processing_ms AS ms FROM prediction_log, range(0, 6) r(k)),
c AS (SELECT s, count(*) FILTER (WHERE is_error) AS errors, count(ms) AS n,
             [""" + ", ".join(f"count(*) FILTER (WHERE ms <= {b})" for b in BOUNDS) + """] AS le FROM w GROUP BY s),
m AS (SELECT s, errors, """ + QUANTILE_SQL + """ AS p95 FROM c),
e AS (""" + " UNION ALL ".join(
    f"SELECT s, '{r.alert}' AS alert, '{r.severity}' AS severity, CAST({x} AS DOUBLE) AS value, coalesce({x} > {r.threshold}, false) AS active, {r.hold_seconds} AS hold FROM m"
    for r, x in zip(HOURLY, ("errors / 3600.0", "p95", "errors"))) + """),
f AS (SELECT *, sum(CASE WHEN active THEN 0 ELSE 1 END) OVER (PARTITION BY alert ORDER BY s) AS run,
             s - lag(s) OVER (PARTITION BY alert ORDER BY s) > INTERVAL 10 MINUTE AS gap FROM e),
g AS (SELECT *, sum(CASE WHEN gap THEN 1 ELSE 0 END) OVER (PARTITION BY alert ORDER BY s) AS part FROM f),
h AS (SELECT *, min(s) FILTER (WHERE active) OVER (PARTITION BY alert, run, part) AS since FROM g)
SELECT alert, severity, round(value, 6) AS value, active, active AND epoch(s) - epoch(since) >= hold AS firing,
       strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start
FROM h"""
CLOSED_SQL = " WHERE s + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events)"


@register("alert_holds_log", ALERT_ROWS_SQL)
def alert_holds_log(spark, sf_dir):
    """M2–M4 in batch: hourly windows sliding by 10 minutes, one row for each rule."""
    windows = A.measures(I.prediction_log(spark, sf_dir), length=LENGTH, slide=SLIDE)
    return A.shown(A.held(A.evaluations(windows, HOURLY), SLIDE))


@register("alert_holds_stream", ALERT_ROWS_SQL + CLOSED_SQL)
def alert_holds_stream(spark, sf_dir):
    """M2–M4 on the event stream, with keyed hold timers: the windows that the
    watermark has closed."""
    log = M.prediction_log_stream(spark, sf_dir).withWatermark("ts", LATE)
    rows = A.held_stream(A.evaluations(A.measures(log, length=LENGTH, slide=SLIDE), HOURLY), LENGTH, SLIDE)
    with A.rocksdb_state(spark):
        return A.shown(M.run_to_files(rows, spark))


@register("gauge_stream", """
WITH w AS (SELECT event_type AS name, time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL (k) HOUR AS s, date_trunc('hour', ts) AS step, value FROM events, range(0, 6) r(k))
SELECT name, strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, min(value) AS min_value, coalesce(min(value) > 5 AND count(DISTINCT step) >= 6, false) AS firing
FROM w GROUP BY name, s HAVING s + INTERVAL 6 HOUR <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events)""")
def gauge_stream(spark, sf_dir):
    """M5 on the event stream: values as gauges named by event type, six hours with
    a sample in each, threshold 5."""
    gauges = M.prediction_log_stream(spark, sf_dir).select("ts", F.col("event_type").alias("name"), F.col("processing_ms").alias("value")).withWatermark("ts", LATE)
    windows = A.gauge_windows(gauges, 5.0, length="6 hours", slide="1 hour", step="1 hour")
    flat = windows.select("name", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "min_value", "firing")
    return M.run_to_files(flat, spark)
