"""Alert holds and gauges: batch against a serial model, stream against batch, late rows included."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.streaming import alerts as A
from riskframe.streaming import monitors as M

T0 = dt.datetime(2024, 3, 1, 8, 0, 0)
LOG = "ts timestamp, host string, is_error boolean, processing_ms double"


def minute_rows(minutes, host, errors, ms, n=40):
    return [(T0 + dt.timedelta(minutes=m, seconds=(i * 59) // n), host, i < errors, float(ms)) for m in minutes for i in range(n)]


#: errors for 12 minutes, then a silence; later a short burst, and slow requests on another host
ROWS = (minute_rows(range(0, 12), "a", 31, 20) + minute_rows(range(30, 34), "a", 0, 20) + minute_rows([34], "a", 9, 20)
        + minute_rows(range(35, 50), "a", 0, 20) + minute_rows(range(0, 40), "b", 0, 4000))


def serial(rows, rules=A.RULES, length=300, slide=60):
    """(host, alert, window start) -> firing, rule by rule and window by window."""
    out = {}
    for host in sorted({r[1] for r in rows}):
        own = [(int((r[0] - T0).total_seconds()), r[2], r[3]) for r in rows if r[1] == host]
        for rule in rules:
            since = last = None
            for at in range(-length, 4000, slide):
                inside = [r for r in own if at <= r[0] < at + length]
                if not inside:
                    continue
                errors = sum(r[1] for r in inside)
                slow = sorted(r[2] for r in inside)[int(0.95 * len(inside)) - 1]
                active = {"errors": errors, "errors_per_second": errors / length, "p95_ms": slow}[rule.measure] > rule.threshold
                if not active:
                    since = None
                elif since is None or at - last > slide:
                    since = at
                out[host, rule.alert, at] = (active, active and at - since >= rule.hold_seconds)
                last = at
    return out


def found(df):
    base = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    return {(r["host"], r["alert"], r["evaluated_at"] - base): (r["active"], r["firing"]) for r in df.collect()}


def test_batch_holds_are_the_serial_ones(spark):
    got = found(A.held(A.evaluations(A.measures(spark.createDataFrame(ROWS, LOG), keys=["host"]), keys=["host"]), keys=["host"]))
    want = serial(ROWS)
    assert got == want
    fired = {(h, a) for (h, a, _), (_, f) in want.items() if f}
    assert fired == {("a", "high_error_rate"), ("a", "prediction_failures"), ("b", "high_latency")}
    # the burst is true for five windows: failures fire, a minute after the first of them
    burst = [at for (h, a, at), (_, f) in want.items() if (h, a) == ("a", "prediction_failures") and f and at > 1500]
    assert burst == [31 * 60, 32 * 60, 33 * 60, 34 * 60]


def stream(spark, folder, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(f"{folder}/{i}")
    # the files of a folder each, in order of their names
    log = (spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))
           .withWatermark("ts", "10 minutes"))
    rows = A.held_stream(A.evaluations(A.measures(log, keys=["host"]), keys=["host"]), keys=["host"])
    with A.rocksdb_state(spark):
        return found(M.run_to_files(rows, spark))


@pytest.mark.parametrize("late", [False, True])
def test_stream_holds_equal_batch(spark, tmp_path, late):
    """Rows in five files by time; with ``late``, some come up to eight minutes
    late (they count) and some an hour late (they do not)."""
    rows = sorted(ROWS)
    cut = [T0 + dt.timedelta(minutes=m) for m in (9, 18, 33, 41, 99)]
    batches = [[r for r in rows if (cut[i - 1] if i else T0) <= r[0] < c] for i, c in enumerate(cut)]
    if late:
        moved = [r for r in batches[0] if r[0] >= T0 + dt.timedelta(minutes=4) and r[1] == "b"][::7]
        batches[0] = [r for r in batches[0] if r not in moved]
        batches[1] = batches[1] + moved
        batches[4] = batches[4] + minute_rows([2, 3], "a", 40, 9000)
    got = stream(spark, tmp_path, batches)
    newest = int((max(r[0] for r in rows) - T0).total_seconds())
    want = {k: v for k, v in serial(rows).items() if k[2] + 300 <= newest - 600}
    assert got == want and any(f for _, f in got.values())


def test_hold_state_is_dropped_when_windows_stop():
    class Value:
        def __init__(self):
            self.kept = None
        exists = lambda self: self.kept is not None
        get = lambda self: self.kept

        def update(self, v):
            self.kept = v

        def clear(self):
            self.kept = None

    class Handle:
        timers: list = []
        getValueState = lambda self, *a: Value()
        registerTimer = lambda self, t: self.timers.append(t)

    class Expired:
        def __init__(self, t):
            self.getExpiryTimeInMs = lambda: t

    import pandas as pd
    timer, handle = A.HoldTimer(["alert"], 300, 60), Handle()
    timer.init(handle)
    feed = lambda *at: list(timer.handleInputRows(("x",), iter([pd.DataFrame({"alert": "x", "severity": "s", "evaluated_at": at, "value": 1.0, "active": True, "hold_seconds": 60})]), None))
    assert feed(0)[0]["firing"].tolist() == [False] and feed(120, 60)[0]["firing"].tolist() == [True, True]
    assert handle.timers == [360_000, 480_000]
    list(timer.handleExpiredTimer(("x",), None, Expired(360_000)))
    assert timer.hold.exists()  # a later evaluation followed
    list(timer.handleExpiredTimer(("x",), None, Expired(480_000)))
    assert not timer.hold.exists()


def test_histogram_quantile(spark):
    rng = np.random.default_rng(1)
    ms = [float(x) for x in rng.uniform(0, 1000, 4000)] + [None] * 9
    log = spark.createDataFrame([(T0, "a", False, x) for x in ms], LOG)
    p95 = A.measures(log).select("p95_ms").first()[0]
    assert abs(p95 - np.quantile([x for x in ms if x is not None], 0.95)) < 15
    assert A.measures(log.where("processing_ms IS NULL")).select("p95_ms").first()[0] is None
    assert A.measures(log.withColumn("processing_ms", F.lit(1e9))).select("p95_ms").first()[0] == 10_000


def test_gauges_need_a_sample_in_every_step(spark):
    rows = [(T0 + dt.timedelta(minutes=m), "cpu", 90.0) for m in (*range(5), 10, 11, 11, 13, 14)]
    got = A.gauge_windows(spark.createDataFrame(rows, "ts timestamp, name string, value double"), 80.0)
    firing = [r[0] for r in got.where("firing").select(F.date_format("w.start", "HH:mm")).collect()]
    assert firing == ["08:00"]
    with pytest.raises(ValueError):
        A.gauge_windows(got, 1.0, length="2 hours")


def test_look_back_keeps_its_hours(spark):
    log = spark.createDataFrame([(T0 + dt.timedelta(hours=h), "a", False, 1.0) for h in range(50)], LOG)
    assert M.look_back(log, 1).count() == 2 and M.look_back(log, 168).count() == 50
    assert M.look_back(log.limit(0)).count() == 0
    for hours in (0, 169):
        with pytest.raises(ValueError):
            M.look_back(log, hours)
