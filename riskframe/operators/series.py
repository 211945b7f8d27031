"""Time-series operators (H1–H6) over (series_key?, ts, value) tables.

Ordering only ever happens inside a key or inside a bounded time-bucketed
series; a global row index (needed by the autocorrelation) is built with
the bucketed ``row_index`` instead of an un-partitioned window.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .core import col, keyed_join, range_buckets

PARTS = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour}
# pivot columns per frequency (fixed, so the pivot needs no extra distinct job)
PIVOT_VALUES = {"month": list(range(1, 13)), "dayofweek": list(range(7)), "hour": list(range(24))}


def datetime_parts(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Year, month, day, hour, weekday (Monday = 0)."""
    t = col(ts)
    return df.withColumns({"year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t),
                           "hour": F.hour(t), "weekday": F.weekday(t)})


def datetime_attribute_counts(df: DataFrame, ts: str = "ts") -> DataFrame:
    """H1: (attribute, value, count) for year / month / day / hour; attributes
    with at most one distinct value are skipped."""
    t = col(ts)
    arr = F.array(*[F.struct(F.lit(k).alias("attribute"), fn(t).alias("value")) for k, fn in PARTS.items()])
    long = df.where(t.isNotNull()).select(F.inline(arr))
    counts = long.groupBy("attribute", "value").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("attribute")   # at most 31 rows per attribute
    return counts.withColumn("_k", F.count(F.lit(1)).over(w)).where("_k > 1").drop("_k")


def seasonality_pivot(df: DataFrame, freq: str = "month", ts: str = "ts", value: str = "value") -> DataFrame:
    """H5: mean of ``value`` by year × month | dayofweek (Monday = 0) | hour."""
    if freq not in PIVOT_VALUES:
        raise ValueError(f"unsupported frequency {freq!r}: use month, dayofweek or hour")
    t = col(ts)
    part = {"month": F.month(t), "dayofweek": F.weekday(t), "hour": F.hour(t)}[freq]
    return (df.select(F.year(t).alias("year"), part.alias("_p"), col(value).alias("_v"))
              .groupBy("year").pivot("_p", PIVOT_VALUES[freq]).agg(F.avg("_v")))


def ordered_series(df: DataFrame, ts: str = "ts", value: str = "value") -> DataFrame:
    """H6: (ts, value) sorted by time (a distributed range-partitioned sort)."""
    return df.select(col(ts), col(value)).where(col(ts).isNotNull()).orderBy(col(ts))


def row_index(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), buckets: int | None = None,
              out: str = "_idx") -> DataFrame:
    """Consecutive 0-based position of every row within ``keys`` by ``order``.
    Range partitions + per-bucket offsets + a window per (key, bucket): no
    window ever holds a whole large key or the table."""
    keys = list(keys)
    b = range_buckets(df, [F.asc(f"`{c}`") for c in [*keys, *order]], buckets)
    counts = b.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_c"))
    wo = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy("_bucket") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(*keys, "_bucket", F.coalesce(F.sum("_c").over(wo), F.lit(0)).alias("_off"))
    j = keyed_join(b, offs, [*keys, "_bucket"])
    w = Window.partitionBy(*keys, "_bucket").orderBy(*[col(c) for c in order])
    return j.withColumn(out, F.col("_off") + F.row_number().over(w) - 1).drop("_bucket", "_off")


#: rows of a time block (more where a halo asks for it)
BLOCK_ROWS = 32_768


def halo_blocks(indexed: DataFrame, width: int, keys: Sequence[str] = (), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``indexed`` (with a position _idx from 0 within ``keys``) plus _block: rows in
    blocks of consecutive positions, each with the ``width`` rows before it as
    well (a block is at least four times as long).  Grouped by (keys, _block),
    a block sees all lags up to ``width`` of its own rows: those with _own."""
    size = max(block_rows, 4 * width)
    block, place = F.floor(F.col("_idx") / size), F.col("_idx") % size
    own = F.struct(block.alias("_block"), F.lit(True).alias("_own"))
    ahead = F.struct((block + 1).alias("_block"), F.lit(False).alias("_own"))
    copies = F.when(place >= size - width, F.array(own, ahead)).otherwise(F.array(own))
    return indexed.withColumn("_c", F.explode(copies)).select(*indexed.columns, "_c._block", "_c._own")


def _lag_sums(keys: Sequence[str], lags: int):
    def lag_sums(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_idx")
        d, own = rows["d"].to_numpy(), rows["_own"].to_numpy(zero_copy_only=False)
        first = int(own.argmax()) if own.any() else len(d)
        sums = [float(d[max(first, k):] @ d[max(first, k) - k:len(d) - k]) if len(d) > k else 0.0 for k in range(lags + 1)]
        heads = [pa.array([rows[k][0].as_py()] * (lags + 1), rows.schema.field(k).type) for k in keys]
        return pa.table([*heads, pa.array(range(lags + 1), pa.int32()), pa.array(sums)], names=[*keys, "lag", "_s"])
    return lag_sums


def acf(df: DataFrame, order: Sequence[str], value: str = "value", lags: int = 50,
        keys: Sequence[str] = ()) -> DataFrame:
    """H3 autocorrelation (overall mean, denominator n) for lags 0..``lags``: time
    blocks with a halo of ``lags`` rows, one shuffle of about the rows themselves,
    and one small row for each block and lag.  Null for a constant series."""
    keys = list(keys)
    base = row_index(df.where(col(value).isNotNull()), order, keys).select(*[col(k) for k in keys], "_idx", col(value).cast("double").alias("x"))
    if keys:
        centred = keyed_join(base, base.groupBy(*keys).agg(F.avg("x").alias("_m")), keys).withColumn("d", F.col("x") - F.col("_m"))
    else:
        # the series mean is one scalar subquery
        centred = base.withColumn("d", F.col("x") - base.select(F.avg("x")).scalar())
    blocks = halo_blocks(centred.select(*keys, "_idx", "d"), lags, keys)
    types = "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)
    parts = blocks.groupBy(*keys, "_block").applyInArrow(_lag_sums(keys, lags), types + "lag int, _s double")
    num = parts.groupBy(*keys, "lag").agg(F.sum("_s").alias("_s"))
    c0 = F.sum(F.when(F.col("lag") == 0, F.col("_s"))).over(
        Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0)))   # lags+1 rows per key
    return num.select(*keys, "lag", F.try_divide("_s", c0).alias("acf"))


# --------------------------------------------------------------------------- H4

# Response surfaces of the Dickey-Fuller distribution with a constant.
# p-values (MacKinnon 1994): below DF_STAR the first polynomial, above it the second.
DF_MIN, DF_STAR, DF_MAX = -18.83, -1.61, 2.74
DF_SMALL = (2.1659, 1.4412, 0.038269)
DF_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
# critical values (MacKinnon 2010): powers of one over the observations
DF_CRITICAL = {"1%": (-3.43035, -6.5393, -16.786, -79.433), "5%": (-2.86154, -2.8903, -4.234, -40.04), "10%": (-2.56677, -1.5384, -2.809, 0.0)}


def dickey_fuller_p(statistic: float) -> float:
    """P-value of an (augmented) Dickey-Fuller statistic, regression with a constant."""
    if statistic > DF_MAX:
        return 1.0
    if statistic < DF_MIN:
        return 0.0
    powers = DF_SMALL if statistic <= DF_STAR else DF_LARGE
    return NormalDist().cdf(sum(c * statistic ** i for i, c in enumerate(powers)))


def _lagged(x: np.ndarray, first: int, lags: int) -> np.ndarray:
    """Rows (1, x[t-1], dx[t-1], …, dx[t-lags], dx[t]) for t from ``first`` on."""
    dx, t = np.diff(x), np.arange(first, len(x))
    return np.column_stack([np.ones(len(t)), x[t - 1], *[dx[t - 1 - k] for k in range(1, lags + 1)], dx[t - 1]])


def _normal_equations(lags: int, mean: float, spread: float):
    def normal_equations(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_idx")
        x = (rows["x"].to_numpy() - mean) / spread
        own = rows["_own"].to_numpy(zero_copy_only=False)
        # the first block has no rows before it: its lags begin after ``lags`` + 1 rows
        first = max(int(own.argmax()), lags + 1)
        m = _lagged(x, first, lags) if own.any() and len(x) > first else np.zeros((0, lags + 3))
        return pa.table({"i": pa.array(np.arange(lags + 3), pa.int32()), "g": pa.array(list(m.T @ m))})
    return normal_equations


def _regression(gram: np.ndarray, n: int, lags: int) -> tuple[float, float]:
    """(residual sum of squares, t of the level) of dx on a constant, the level and the
    first ``lags`` lagged differences, from normal equations whose last row is dx."""
    k = lags + 2
    scale = np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
    g = gram / np.outer(scale, scale)
    inverse = np.linalg.pinv(g[:k, :k], hermitian=True)
    beta = inverse @ g[:k, -1]
    rss = max(0.0, float(g[-1, -1] - g[:k, -1] @ beta)) * scale[-1] ** 2
    error = np.sqrt(rss / scale[-1] ** 2 / (n - k) * inverse[1, 1]) if n > k else 0.0
    return rss, float(beta[1] / error) if error > 0 else float("nan")


def adf(df: DataFrame, order: Sequence[str], value: str = "value", max_lag: int | None = None) -> DataFrame:
    """H4 augmented Dickey-Fuller test with a constant: one row of statistic, p_value,
    used_lag, n_obs, crit_1, crit_5, crit_10 and stationary (p < 0.05).

    The lag is that of the least AIC among 0 .. max_lag (12 (n/100)^(1/4), rounded
    up), all compared on the same rows; the test is then run on every row that
    the chosen lag allows.  Time blocks with a halo return their lagged normal
    equations, which are summed: one matrix serves all lags, and its size (the
    number of lags squared) is what the driver gets, besides the first rows.
    Null results for a constant series or one of fewer than eight values."""
    spark = df.sparkSession
    schema = "statistic double, p_value double, used_lag int, n_obs long, crit_1 double, crit_5 double, crit_10 double, stationary boolean"
    series = df.where(col(value).isNotNull() & ~F.isnan(col(value).cast("double")))
    n, mean, spread = series.agg(F.count(F.lit(1)), F.avg(col(value).cast("double")), F.stddev_pop(col(value).cast("double"))).first()
    if n < 8 or not spread:
        return spark.createDataFrame([(None,) * 8], schema)
    lags = int(np.ceil(12 * (n / 100) ** 0.25)) if max_lag is None else max_lag
    lags = max(0, min(lags, n // 2 - 2))
    indexed = written(row_index(series, order).select("_idx", col(value).cast("double").alias("x")))
    parts = halo_blocks(indexed, lags + 1).groupBy("_block").applyInArrow(_normal_equations(lags, mean, spread), "i int, g array<double>")
    summed = parts.select("i", F.posexplode("g").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    gram = np.zeros((lags + 3, lags + 3))
    gram[summed["i"], summed["j"]] = summed["v"]
    rows = n - 1 - lags
    aic = [rows * np.log(max(_regression(gram[np.ix_(keep, keep)], rows, k)[0], 1e-300) / rows) + 2 * (k + 2)
           for k in range(lags + 1) for keep in [[*range(k + 2), lags + 2]]]
    used = int(np.argmin(aic))
    # rows that the chosen lag allows besides: all among the first of the series
    head = indexed.where(F.col("_idx") <= lags).orderBy("_idx").toPandas()["x"].to_numpy()
    more = _lagged((head - mean) / spread, used + 1, used)
    keep = [*range(used + 2), lags + 2]
    final, rows = gram[np.ix_(keep, keep)] + more.T @ more, n - 1 - used
    statistic = _regression(final, rows, used)[1]
    if not np.isfinite(statistic):
        return spark.createDataFrame([(None,) * 8], schema)
    p = dickey_fuller_p(statistic)
    critical = [sum(c / rows ** i for i, c in enumerate(powers)) for powers in DF_CRITICAL.values()]
    return spark.createDataFrame([(statistic, p, used, rows, *critical, p < 0.05)], schema)


def pacf_from_acf(acf_values: Sequence[float], n: int, lags: int) -> list[float]:
    """H3 partial autocorrelation, Yule–Walker with 'adjusted' autocovariances
    (divide by n − k), solved by Levinson–Durbin over ``lags`` scalars."""
    r = np.asarray(acf_values[: lags + 1], dtype=float)
    # acf uses denominator n; rescale to the adjusted (n - k) autocovariance ratios
    k = np.arange(len(r))
    r = r * n / (n - k)
    r = r / r[0]
    out = [1.0]
    phi = np.zeros(lags + 1)
    v = r[0]
    prev = np.zeros(lags + 1)
    for m in range(1, lags + 1):
        a = (r[m] - np.dot(prev[1:m], r[1:m][::-1])) / v
        phi[:] = prev
        phi[m] = a
        phi[1:m] = prev[1:m] - a * prev[1:m][::-1]
        v = v * (1 - a * a)
        prev = phi.copy()
        out.append(float(a))
    return out


def classical_decompose(df: DataFrame, ts: str = "ts", value: str = "value", bucket: str = "1 hour",
                        period: int = 12, keys: Sequence[str] = ()) -> DataFrame:
    """H2 (classical additive): bucket the series to ``bucket`` means, trend =
    centred 2×``period`` moving average, seasonal = phase means of the
    detrended series (centred), residual = rest.  Windows run per key over
    the bucketed series only (bounded by time range / bucket)."""
    keys = list(keys)
    half = period // 2
    b = df.groupBy(*keys, F.date_trunc("hour", col(ts)).alias("_t") if bucket == "1 hour"
                   else F.window(col(ts), bucket).start.alias("_t")).agg(F.avg(col(value)).alias("x"))
    wi = Window.partitionBy(*keys).orderBy("_t") if keys else Window.partitionBy(F.lit(0)).orderBy("_t")
    b = b.withColumn("_i", F.row_number().over(wi) - 1)
    n = b.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    b = b.join(n, keys) if keys else b.withColumn("_n", F.lit(n.first()["_n"]))
    full = F.sum("x").over(wi.rowsBetween(-half, half))
    ends = F.lag("x", half).over(wi) + F.lead("x", half).over(wi)
    trend = F.when((F.col("_i") >= half) & (F.col("_i") < F.col("_n") - half),
                   (full - 0.5 * ends) / period)
    b = b.withColumn("trend", trend).withColumn("detr", F.col("x") - F.col("trend")).withColumn(
        "_phase", F.col("_i") % period)
    ph = b.groupBy(*keys, "_phase").agg(F.avg("detr").alias("_pm"))
    wk = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    ph = ph.withColumn("seasonal", F.col("_pm") - F.avg("_pm").over(wk))
    out = b.join(ph, [*keys, "_phase"]).withColumn("resid", F.col("x") - F.col("trend") - F.col("seasonal"))
    return out.select(*keys, F.col("_t").alias("bucket_start"), "x", "trend", "seasonal", "resid")


def decomposition_summary(dec: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """H2 summary: mean, std (sample), min, max of trend / seasonal / residual."""
    aggs = []
    for c in ("trend", "seasonal", "resid"):
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"),
                 F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return dec.groupBy(*keys).agg(*aggs)
