"""Alert rules with hold timers over a request log (M2–M5), batch and Structured Streaming.

``measures`` counts requests in sliding windows (latencies in a histogram of
fixed bounds, so a window's state has a fixed size), ``evaluations`` applies
the rules: one row for each window and rule.  A rule fires at a window when
it has been true at every evaluation since ``hold_seconds`` before; a window
without rows ends the hold.

* ``held`` answers that for a table: each true evaluation votes for the ones
  it would still hold at, so no task sees all windows of a rule.
* ``held_stream`` answers it for a stream: windows arrive once the watermark
  has closed them; a keyed state per rule (and series) keeps when the rule
  became true and the last evaluation, and an event-time timer drops the
  state when the next window has closed without rows.

Rows later than the watermark are dropped from their windows, as Structured
Streaming does; on the rows that count both give the same answer.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.core import col


@dataclass(frozen=True)
class Rule:
    """Fires once ``measure`` > ``threshold`` has held for ``hold_seconds``."""
    alert: str
    measure: str
    threshold: float
    hold_seconds: int
    severity: str


# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
RULES = (
    Rule("high_error_rate", "errors_per_second", 0.1, 120, "warning"),
    Rule("high_latency", "p95_ms", 1000.0, 120, "warning"),
    Rule("prediction_failures", "errors", 5, 60, "critical"),
)

#: upper bounds of the latency buckets in milliseconds; a last one is open
LATENCY_BOUNDS_MS = (5, 10, 25, 50, 75, 100, 250, 500, 750, 1000, 2500, 5000, 7500, 10000)

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def seconds(interval: str) -> int:
    """Seconds of an interval such as '5 minutes'."""
    number, unit = interval.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def histogram_quantile(counts: Sequence[Column], total: Column, q: float, bounds: Sequence[float]) -> Column:
    """The q-quantile from cumulative bucket counts (at or below each bound):
    linear inside the bucket that holds it, the last bound in the open bucket,
    null without rows."""
    place = total * q
    value = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        low = float(bounds[i - 1]) if i else 0.0
        below = counts[i - 1] if i else F.lit(0)
        inside = low + (float(bounds[i]) - low) * F.coalesce(F.try_divide(place - below, counts[i] - below), F.lit(1.0))
        value = F.when(counts[i] >= place, inside).otherwise(value)
    return F.when(total > 0, value)


def measures(log: DataFrame, ts: str = "ts", length: str = "5 minutes", slide: str = "1 minute", keys: Sequence[str] = (),
             error: str = "is_error", latency: str = "processing_ms", bounds: Sequence[float] = LATENCY_BOUNDS_MS) -> DataFrame:
    """keys, w (window), requests, errors, errors_per_second and p95_ms of each
    sliding window with rows (p95 of the rows that have a latency)."""
    counted = log.groupBy(*[col(k) for k in keys], F.window(col(ts), length, slide).alias("w")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(col(error)).alias("errors"), F.count(col(latency)).alias("_n"),
        *[F.count_if(col(latency) <= b).alias(f"_le{i}") for i, b in enumerate(bounds)])
    p95 = histogram_quantile([F.col(f"_le{i}") for i in range(len(bounds))], F.col("_n"), 0.95, bounds)
    return counted.select(*[col(k) for k in keys], "w", "requests", "errors", (F.col("errors") / seconds(length)).alias("errors_per_second"), p95.alias("p95_ms"))


def evaluations(windows: DataFrame, rules: Sequence[Rule] = RULES, keys: Sequence[str] = ()) -> DataFrame:
    """keys, alert, severity, evaluated_at (window start, epoch seconds),
    closed_at (event time of the window), value, active, hold_seconds."""
    row = lambda r: F.struct(F.lit(r.alert).alias("alert"), F.lit(r.severity).alias("severity"), col(r.measure).cast("double").alias("value"),
                             F.coalesce(col(r.measure) > r.threshold, F.lit(False)).alias("active"), F.lit(r.hold_seconds).alias("hold_seconds"))
    exploded = windows.select(*[col(k) for k in keys], "w", F.explode(F.array(*[row(r) for r in rules])).alias("r"))
    # the window's own end rather than window_time(), which a table of windows has no metadata for
    return exploded.select(*[col(k) for k in keys], "r.alert", "r.severity", F.unix_timestamp(F.col("w.start").cast("timestamp")).alias("evaluated_at"),
                           "r.value", "r.active", "r.hold_seconds")


def held(rows: DataFrame, slide: str = "1 minute", keys: Sequence[str] = ()) -> DataFrame:
    """``rows`` of ``evaluations`` plus firing, for a table.  Every true one votes
    for itself and those up to its hold later; all votes in means it fires."""
    step, place = seconds(slide), [*keys, "alert"]
    ahead = F.explode(F.sequence(F.lit(0), F.floor(F.col("hold_seconds") / step).cast("int"))).alias("_k")
    votes = rows.where("active").select(*[col(k) for k in place], "evaluated_at", ahead).select(
        *[col(k).alias(f"_v{i}") for i, k in enumerate(place)], (F.col("evaluated_at") + F.col("_k") * step).alias("_at"))
    votes = votes.groupBy(*[f"_v{i}" for i in range(len(place))], "_at").agg(F.count(F.lit(1)).alias("_votes"))
    on = [rows[f"`{k}`"].eqNullSafe(votes[f"_v{i}"]) for i, k in enumerate(place)] + [rows["evaluated_at"] == votes["_at"]]
    fires = F.col("active") & (F.coalesce("_votes", F.lit(0)) == F.floor(F.col("hold_seconds") / step) + 1)
    return rows.join(votes, on, "left").withColumn("firing", fires).select(*[col(k) for k in keys], *_OUT)


_OUT = ("alert", "severity", "evaluated_at", "value", "active", "firing")


class HoldTimer(StatefulProcessor):
    """State of one rule (of one series): since when it is true, and its last evaluation."""

    def __init__(self, key_names: Sequence[str], length_seconds: int, slide_seconds: int):
        self.key_names, self.length, self.slide = list(key_names), length_seconds, slide_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.hold = handle.getValueState("hold", "since long, last long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        since, last = self.hold.get() if self.hold.exists() else (None, None)
        new = pd.concat(rows).sort_values("evaluated_at", kind="stable")
        firing = []
        for at, active, hold in zip(new["evaluated_at"].tolist(), new["active"].tolist(), new["hold_seconds"].tolist()):
            if not active:
                since = None
            elif since is None or at - last > self.slide:  # a window without rows lies between
                since = at
            firing.append(bool(active and at - since >= hold))
            last = at
        self.hold.update((since, last))
        self.handle.registerTimer(self._silent_after(last))
        yield new.assign(firing=firing)[[*self.key_names, "severity", "evaluated_at", "value", "active", "firing"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # timers of evaluations that others followed find a younger state and leave it
        if self.hold.exists() and self._silent_after(self.hold.get()[1]) <= expiredTimerInfo.getExpiryTimeInMs():
            self.hold.clear()
        yield from ()

    def _silent_after(self, last: int) -> int:
        """Milliseconds at which the window after ``last`` has closed."""
        return (last + self.slide + self.length) * 1000

    def close(self) -> None:
        pass


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB (timers need it)."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def held_stream(rows: DataFrame, length: str = "5 minutes", slide: str = "1 minute", keys: Sequence[str] = ()) -> DataFrame:
    """``held`` for a streaming ``rows``; start the query inside ``rocksdb_state``."""
    names = [*keys, "alert"]
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    out = ", ".join(f"`{c}` {types.get(c, 'boolean')}" for c in (*names, "severity", "evaluated_at", "value", "active", "firing"))
    timed = rows.groupBy(*[col(k) for k in names]).transformWithStateInPandas(
        HoldTimer(names, seconds(length), seconds(slide)), out, "append", "EventTime")
    return timed.select(*[col(k) for k in keys], *_OUT)


def shown(rows: DataFrame) -> DataFrame:
    """``rows`` with the window start as text and the value rounded."""
    return rows.withColumn("window_start", F.date_format(F.timestamp_seconds("evaluated_at"), "yyyy-MM-dd HH:mm:ss")).withColumn(
        "value", F.round("value", 6)).drop("evaluated_at")


def gauge_windows(gauges: DataFrame, threshold: float, ts: str = "ts", keys: Sequence[str] = ("name",), length: str = "5 minutes",
                  slide: str = "1 minute", step: str = "1 minute") -> DataFrame:
    """M5 for a table or a stream: keys, w, min_value and firing: over the threshold
    throughout the window, with a sample in every ``step`` of it.

    The steps seen are bits of one number (a window has 64 steps at most), so
    the state of a window is a minimum and a number."""
    need = seconds(length) // seconds(step)
    if need > 64:
        raise ValueError(f"{length} has more than 64 steps of {step}")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.floor(F.unix_timestamp(col(ts).cast("timestamp")) / seconds(step)), F.lit(64)).cast("int"))
    w = gauges.groupBy(*[col(k) for k in keys], F.window(col(ts), length, slide).alias("w")).agg(F.min("value").alias("min_value"), F.bit_or(bit).alias("_steps"))
    firing = (F.col("min_value") > threshold) & (F.bit_count("_steps") >= need)
    return w.select(*[col(k) for k in keys], "w", "min_value", F.coalesce(firing, F.lit(False)).alias("firing"))
