"""H2: seasonal-trend decomposition by local regression (STL) of long series.

Every step of the decomposition is a local filter, so what a row gets depends
only on rows within ``reach`` of it.  The series is cut into blocks of
consecutive rows with that many rows of their neighbours on both sides; each
block is decomposed by itself and keeps the results of its own rows, which are
those of the whole series at once: one shuffle of about the rows themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .core import col
from .series import BLOCK_ROWS, row_index


def _next_odd(x: float) -> int:
    n = int(np.ceil(x))
    return n + 1 - n % 2


def spans(period: int, seasonal: int = 7) -> tuple[int, int, int]:
    """Widths of the seasonal, low-pass and trend regressions of a period."""
    return seasonal, _next_odd(period + 1), _next_odd(1.5 * period / (1 - 1.5 / seasonal))


def reach(period: int, seasonal: int = 7, rounds: int = 5) -> int:
    """Rows on either side that a row's result can depend on: whole windows of every
    filter, as windows lie on one side only at an end of the series."""
    s, low, trend = spans(period, seasonal)
    return rounds * (period * (s - 1) + 2 * period + (low - 1) + (trend - 1))


def line_weights(at: int, points: int, width: int) -> np.ndarray:
    """Weights of ``points`` equidistant values for the value at ``at`` (it may lie
    outside) of a straight line fitted with tricube weights."""
    place = np.arange(points, dtype=float)
    far = max(at, points - 1 - at) + max(0, width - points) // 2
    share = np.abs(place - at) / far if far else np.zeros(points)
    w = np.where(share <= 0.999, (1 - share ** 3) ** 3, 0.0)
    if not w.any():
        w[np.argmin(share)] = 1.0
    w /= w.sum()
    centre = w @ place
    spread = w @ (place - centre) ** 2
    return w * (1 + (at - centre) * (place - centre) / spread) if spread > 1e-9 else w


def local_lines(y: np.ndarray, width: int, beyond: int = 0) -> np.ndarray:
    """Local regression of an equidistant series on its ``width`` nearest values, at
    every place and at ``beyond`` places before and after it."""
    n, m, half = len(y), min(width, len(y)), (width - 1) // 2
    if n <= width:
        places = range(-beyond, n + beyond)
        return np.array([line_weights(i, n, width) @ y for i in places])
    head = [line_weights(i, m, width) @ y[:m] for i in range(-beyond, half)]
    tail = [line_weights(i, m, width) @ y[n - m:] for i in range(m - half, m + beyond)]
    inner = np.lib.stride_tricks.sliding_window_view(y, width) @ line_weights(half, width, width)
    return np.concatenate([head, inner, tail])


def _moving_mean(y: np.ndarray, width: int) -> np.ndarray:
    return np.convolve(y, np.full(width, 1.0 / width), mode="valid")


def decompose(x: np.ndarray, period: int, seasonal: int = 7, rounds: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(trend, season) of a series of at least two periods."""
    season_width, low_width, trend_width = spans(period, seasonal)
    n = len(x)
    trend = np.zeros(n)
    season = np.zeros(n)
    for _ in range(rounds):
        cycles = np.empty(n + 2 * period)  # one period more on either side
        for phase in range(period):
            cycles[phase::period] = local_lines((x - trend)[phase::period], season_width, beyond=1)
        low = _moving_mean(_moving_mean(_moving_mean(cycles, period), period), 3)
        season = cycles[period:period + n] - local_lines(low, low_width)
        trend = local_lines(x - season, trend_width)
    return trend, season


def _block(keys: Sequence[str], period: int, seasonal: int, rounds: int):
    def block(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_idx")
        x, own = rows["x"].to_numpy(), rows["_own"].to_numpy(zero_copy_only=False)
        if len(x) >= 2 * period:
            # centred, so that a far level costs no digits
            middle = x.mean()
            trend, season = decompose(x - middle, period, seasonal, rounds)
            trend = trend + middle
            parts = [pa.array(v[own]) for v in (trend, season, x - trend - season)]
        else:
            parts = [pa.nulls(int(own.sum()), pa.float64())] * 3
        kept = rows.filter(pa.array(own))
        return pa.table([*[kept[k] for k in keys], kept["_idx"], kept["x"], *parts], names=[*keys, "_idx", "x", "trend", "seasonal", "resid"])
    return block


def stl(df: DataFrame, order: Sequence[str], value: str = "value", period: int = 12, seasonal: int = 7, rounds: int = 5,
        keys: Sequence[str] = (), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """H2 (STL, straight lines, no robustness rounds): ``keys``, position _idx by
    ``order``, x, trend, seasonal and resid of every row with a value; the sum of
    the three is x.  ``seasonal`` is the odd width of the seasonal regression.

    Rows with a null or NaN value are left out; equal times need a further order
    column to be repeatable; a series under two periods gets null parts, an
    empty one no rows.  Summed up by ``series.decomposition_summary``."""
    if period < 2 or seasonal < 3 or seasonal % 2 == 0:
        raise ValueError("the period is 2 or more, the seasonal width odd and 3 or more")
    keys = list(keys)
    names = [f"_k{i}" for i in range(len(keys))]
    number = col(value).cast("double")
    rows = df.where(number.isNotNull() & ~F.isnan(number)).select(
        *[col(k).alias(n) for k, n in zip(keys, names)], *[col(c).alias(f"_o{i}") for i, c in enumerate(order)], number.alias("x"))
    series = row_index(rows, [f"_o{i}" for i in range(len(order))], names).select(*names, "_idx", "x")
    halo = reach(period, seasonal, rounds)
    size = max(block_rows, 4 * halo)
    here, place = F.floor(F.col("_idx") / size), F.col("_idx") % size
    copies = F.filter(F.array(F.struct(here.alias("_block"), F.lit(True).alias("_own")),
                              F.when(place >= size - halo, F.struct((here + 1).alias("_block"), F.lit(False).alias("_own"))),
                              F.when((place < halo) & (here > 0), F.struct((here - 1).alias("_block"), F.lit(False).alias("_own")))),
                      lambda c: c.isNotNull())
    blocks = series.withColumn("_c", F.explode(copies)).select(*names, "_idx", "x", "_c._block", "_c._own")
    types = "".join(f"{n} {df.schema[k].dataType.simpleString()}, " for k, n in zip(keys, names))
    parts = blocks.groupBy(*names, "_block").applyInArrow(
        _block(names, period, seasonal, rounds), types + "_idx long, x double, trend double, seasonal double, resid double")
    return parts.withColumnsRenamed(dict(zip(names, keys)))
