"""Queries for time series and windowed monitors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import series as H
from ..operators import stl as S
from ..streaming import monitors as M
from . import inputs as I
from .catalog import register


def _r(c, d=6):
    return F.round(c, d).alias(c)


@register("datetime_parts_events", """
SELECT event_id, year(ts) AS year, month(ts) AS month, day(ts) AS day, hour(ts) AS hour,
       CAST(isodow(ts) - 1 AS INTEGER) AS weekday FROM events""")
def datetime_parts_events(spark, sf_dir):
    """E12 over the event log (weekday: Monday = 0)."""
    ev = I.table(spark, sf_dir, "events")
    return H.datetime_parts(ev, "ts").select("event_id", "year", "month", "day", "hour", "weekday")


@register("datetime_counts_orders", """
WITH long AS (
  SELECT 'year' AS attribute, year(o_orderdate) AS value FROM orders UNION ALL
  SELECT 'month', month(o_orderdate) FROM orders UNION ALL
  SELECT 'day', day(o_orderdate) FROM orders UNION ALL
  SELECT 'hour', hour(o_orderdate) FROM orders),
c AS (SELECT attribute, CAST(value AS INTEGER) AS value, count(*) AS count FROM long GROUP BY ALL)
SELECT * FROM c WHERE attribute IN (SELECT attribute FROM c GROUP BY attribute HAVING count(*) > 1)""")
def datetime_counts_orders(spark, sf_dir):
    """H1 over order dates (the constant hour attribute is skipped)."""
    return H.datetime_attribute_counts(I.table(spark, sf_dir, "orders"), "o_orderdate")


@register("seasonality_hour_events", """
SELECT year(ts) AS year, """ + ", ".join(
    f'round(avg(value) FILTER (WHERE hour(ts) = {h}), 6) AS "{h}"' for h in range(24)) + """
FROM events GROUP BY year(ts)""")
def seasonality_hour_events(spark, sf_dir):
    """H5 year × hour mean of event values."""
    p = H.seasonality_pivot(I.table(spark, sf_dir, "events"), "hour", "ts", "value")
    return p.select("year", *[F.round(F.col(str(h)), 6).alias(str(h)) for h in range(24)])


@register("seasonality_month_orders", """
SELECT year(o_orderdate) AS year, """ + ", ".join(
    f'round(avg(o_totalprice) FILTER (WHERE month(o_orderdate) = {m}), 6) AS "{m}"' for m in range(1, 13)) + """
FROM orders GROUP BY year(o_orderdate)""")
def seasonality_month_orders(spark, sf_dir):
    """H5 year × month mean order value."""
    p = H.seasonality_pivot(I.table(spark, sf_dir, "orders"), "month", "o_orderdate", "o_totalprice")
    return p.select("year", *[F.round(F.col(str(m)), 6).alias(str(m)) for m in range(1, 13)])


@register("ordered_series_events", "SELECT ts, value FROM events")
def ordered_series_events(spark, sf_dir):
    """H6 (sorted output; the oracle compares as a multiset)."""
    return H.ordered_series(I.table(spark, sf_dir, "events"), "ts", "value")


@register("acf_events", """
WITH s AS (SELECT value - avg(value) OVER () AS d, row_number() OVER (ORDER BY ts, event_id) AS i FROM events),
p AS (SELECT l.lag, sum(a.d * b.d) AS num FROM s a, range(0, 51) l(lag), s b WHERE b.i = a.i + l.lag GROUP BY l.lag)
SELECT CAST(lag AS INTEGER) AS lag, round(num / (SELECT num FROM p WHERE lag = 0), 6) AS acf FROM p""")
def acf_events(spark, sf_dir):
    """H3 autocorrelation of event values in time order, lags 0..50."""
    a = H.acf(I.table(spark, sf_dir, "events"), ["ts", "event_id"], "value", lags=50)
    return a.select(F.col("lag").cast("int").alias("lag"), _r("acf"))


@register("pacf_events")
def pacf_events(spark, sf_dir):
    """H3 partial autocorrelation (Yule–Walker adjusted, Levinson–Durbin on the
    51 autocorrelations; the only driver work is on those scalars)."""
    ev = I.table(spark, sf_dir, "events")
    a = sorted((r["lag"], r["acf"]) for r in H.acf(ev, ["ts", "event_id"], "value", lags=50).collect())
    n = ev.where(F.col("value").isNotNull()).count()
    vals = H.pacf_from_acf([v for _, v in a], n, 50)
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "lag int, pacf double")


@register("adf_events")
def adf_events(spark, sf_dir):
    """H4 augmented Dickey–Fuller test of event values in time order."""
    return H.adf(I.table(spark, sf_dir, "events"), ["ts", "event_id"], "value")


@register("decompose_hourly_events", """
WITH b AS (SELECT date_trunc('hour', ts) AS t, avg(value) AS x FROM events GROUP BY 1),
i AS (SELECT *, row_number() OVER (ORDER BY t) - 1 AS i, count(*) OVER () AS n FROM b),
tr AS (SELECT *, CASE WHEN i >= 6 AND i < n - 6 THEN
          (sum(x) OVER (ORDER BY t ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)
           - 0.5 * (lag(x, 6) OVER (ORDER BY t) + lead(x, 6) OVER (ORDER BY t))) / 12 END AS trend FROM i),
ph AS (SELECT i % 12 AS phase, avg(x - trend) AS pm FROM tr GROUP BY 1),
se AS (SELECT phase, pm - avg(pm) OVER () AS seasonal FROM ph),
d AS (SELECT trend, seasonal, x - trend - seasonal AS resid FROM tr JOIN se ON tr.i % 12 = se.phase)
SELECT round(avg(trend), 6) AS trend_mean, round(stddev_samp(trend), 6) AS trend_std, round(min(trend), 6) AS trend_min,
       round(max(trend), 6) AS trend_max, round(avg(seasonal), 6) AS seasonal_mean, round(stddev_samp(seasonal), 6) AS seasonal_std,
       round(min(seasonal), 6) AS seasonal_min, round(max(seasonal), 6) AS seasonal_max, round(avg(resid), 6) AS resid_mean,
       round(stddev_samp(resid), 6) AS resid_std, round(min(resid), 6) AS resid_min, round(max(resid), 6) AS resid_max
FROM d""")
def decompose_hourly_events(spark, sf_dir):
    """H2 classical additive decomposition (period 12) of hourly mean event values."""
    d = H.decomposition_summary(H.classical_decompose(I.table(spark, sf_dir, "events"), "ts", "value"))
    return d.select(*[_r(c) for c in d.columns])


@register("stl_events")
def stl_events(spark, sf_dir):
    """H2 (STL, period 12) of event values in time order, summed up."""
    d = H.decomposition_summary(S.stl(I.table(spark, sf_dir, "events"), ["ts", "event_id"], "value"))
    return d.select(*[_r(c) for c in d.columns])


METRICS_SQL = I.with_ctes(I.PREDICTION_LOG_SQL) + """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS total,
       round(count(*) FILTER (WHERE prediction = 0) * 1.0 / count(*), 6) AS approval_rate,
       round(count(*) FILTER (WHERE prediction = 1) * 1.0 / count(*), 6) AS rejection_rate,
       round(avg(processing_ms), 6) AS avg_processing_ms,
       round(count(*) FILTER (WHERE is_error) * 1.0 / count(*), 6) AS error_rate
FROM prediction_log GROUP BY 1"""


@register("prediction_metrics_hourly", METRICS_SQL)
def prediction_metrics_hourly(spark, sf_dir):
    """M1 in batch: hourly tumbling windows over the prediction log."""
    log = I.prediction_log(spark, sf_dir)
    return M.finish_metrics(M.prediction_metrics(log, "ts", "1 hour"))


@register("prediction_metrics_last_days", METRICS_SQL.replace(
    "FROM prediction_log GROUP BY 1", "FROM prediction_log WHERE ts >= (SELECT max(ts) FROM prediction_log) - INTERVAL 48 HOUR GROUP BY 1"))
def prediction_metrics_last_days(spark, sf_dir):
    """M1 with a look-back of 48 hours."""
    log = M.look_back(I.prediction_log(spark, sf_dir), 48)
    return M.finish_metrics(M.prediction_metrics(log, "ts", "1 hour"))


@register("prediction_metrics_stream", METRICS_SQL)
def prediction_metrics_stream(spark, sf_dir):
    """M1 as Structured Streaming (watermark 10 min, availableNow); equals batch
    because the log file arrives in time order."""
    return M.prediction_metrics_stream(spark, sf_dir)


ALERT_SQL = I.with_ctes(I.PREDICTION_LOG_SQL) + """
, w AS (SELECT date_trunc('minute', ts) - INTERVAL (k) MINUTE AS s, is_error, processing_ms
        FROM prediction_log, range(0, 5) r(k)),
c AS (SELECT s, count(*) AS requests, count(*) FILTER (WHERE is_error) AS errors,
             quantile_cont(processing_ms, 0.95) AS p95 FROM w GROUP BY s),
f AS (SELECT *, errors / 300.0 > 0.1 AS e, p95 > 1000 AS l, errors > 5 AS p FROM c)
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, requests, errors, round(p95, 6) AS p95_ms,
       e AS high_error_rate, l AS high_latency, p AS prediction_failures,
       min(CAST(e AS INTEGER)) OVER x = 1 AND count(*) OVER x = 3 AS high_error_rate_firing,
       min(CAST(l AS INTEGER)) OVER x = 1 AND count(*) OVER x = 3 AS high_latency_firing,
       min(CAST(p AS INTEGER)) OVER y = 1 AND count(*) OVER y = 2 AS prediction_failures_firing
FROM f WINDOW x AS (ORDER BY s RANGE BETWEEN INTERVAL 2 MINUTE PRECEDING AND CURRENT ROW),
              y AS (ORDER BY s RANGE BETWEEN INTERVAL 1 MINUTE PRECEDING AND CURRENT ROW)"""


@register("alert_windows_log", ALERT_SQL)
def alert_windows_log(spark, sf_dir):
    """M2–M4: 5-minute windows sliding by 1 minute, held for 2, 2 and 1 minutes."""
    return M.alert_windows(M.sliding_counts(I.prediction_log(spark, sf_dir)))


@register("gauge_windows_events", """
WITH g AS (SELECT ts, value FROM events WHERE event_type = 'click'),
w AS (SELECT date_trunc('minute', ts) - INTERVAL (k) MINUTE AS s, ts, value FROM g, range(0, 5) r(k))
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, min(value) AS min_value,
       min(value) > 5 AND count(DISTINCT date_trunc('minute', ts)) >= 5 AS firing
FROM w GROUP BY s""")
def gauge_windows_events(spark, sf_dir):
    """M5 with click values as the gauge (threshold 5)."""
    ev = I.table(spark, sf_dir, "events").select("ts", F.col("event_type").alias("name"), "value")
    return M.gauge_over_threshold(ev, "click", 5.0)
