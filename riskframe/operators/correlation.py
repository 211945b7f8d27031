"""Correlation of many numeric columns at once.

Pearson: every task multiplies its row blocks with themselves (Gram matrices of
the centred values and of the masks of present ones) and returns one small row
for each pair of columns; their sums give n and the moments of every pair over
the rows where both are present.  The data are read once, in one stage, however
many columns there are.

Spearman: ranks of all columns come from one count of (column, value) and one
running total over it.  Columns with few distinct values look their ranks up in
place; the others get theirs by one join on (column, value) and one regrouping
by row: two shuffles of the values, whatever the number of columns; AQE splits a
value that many rows share.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, written
from .core import col, numeric_columns, running_totals

#: of a pair's second moment, what rounding may leave of a constant's variance
ROUNDING = 1e-12
#: distinct values of all looked-up columns together (16 bytes each)
LOOKUP = 500_000
_MOMENTS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def as_doubles(df: DataFrame, columns: Sequence[str], complete: bool) -> DataFrame:
    """The columns as doubles c0, c1, … with NaN as null; rows with a null are left
    out where only ``complete`` rows count."""
    values = df.select(*[F.nullif(col(c).cast("double"), F.lit(float("nan"))).alias(f"c{i}") for i, c in enumerate(columns)])
    return values.dropna() if complete else values


def _centres(values: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and population standard deviation of each column (four numbers a
    column); a constant column is centred on its value, and all its products are 0."""
    row = values.agg(*[f(c) for c in values.columns for f in (F.avg, F.stddev_pop, F.min, F.max)]).first()
    mean, spread, low, high = (np.array([np.nan if v is None else v for v in row[k::4]], float) for k in range(4))
    mean = np.where(low == high, low, mean)
    return np.where(np.isfinite(mean), mean, 0.0), np.where(np.isfinite(spread) & (spread > 0) & (low < high), spread, 1.0)


def _products(mean: np.ndarray, spread: np.ndarray):
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            there = ~np.isnan(x)
            if there.all():  # sums over all rows serve every pair
                x = (x - mean) / spread
                ones = np.ones_like(mean)
                s, q = x.sum(axis=0), (x * x).sum(axis=0)
                now = np.stack([np.outer(ones, ones) * len(x), np.outer(s, ones), np.outer(ones, s), np.outer(q, ones), np.outer(ones, q), x.T @ x])
            else:
                x, m = np.where(there, (x - mean) / spread, 0.0), there.astype(np.float64)
                s, q = x.T @ m, (x * x).T @ m
                now = np.stack([m.T @ m, s, s.T, q, q.T, x.T @ x])
            total = now if total is None else total + now
        if total is not None:
            i, j = np.triu_indices(len(mean), 1)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(t[i, j]) for t in total]],
                                             names=["i", "j", *_MOMENTS])
    return products


def _correlation(values: DataFrame, columns: Sequence[str], centres: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """(var1, var2, r): null where a side is constant on the pair's rows."""
    mean, spread = centres or _centres(values)
    parts = values.mapInArrow(_products(mean, spread), "i int, j int, " + ", ".join(f"{m} double" for m in _MOMENTS))
    s = parts.groupBy("i", "j").agg(*[F.sum(m).alias(m) for m in _MOMENTS])
    vx, vy = (F.col("n") * F.col(f"s{v}{v}") - F.col(f"s{v}") ** 2 for v in "xy")
    varies = (vx > ROUNDING * F.col("n") * F.col("sxx")) & (vy > ROUNDING * F.col("n") * F.col("syy"))
    r = (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / (F.sqrt(vx) * F.sqrt(vy))
    names = F.array(*[F.lit(c) for c in columns])
    return s.select(F.get(names, F.col("i")).alias("var1"), F.get(names, F.col("j")).alias("var2"), F.when(varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("r"))


def _none(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], "var1 string, var2 string, r double")


def _long(values: DataFrame, names: Sequence[str], *more) -> DataFrame:
    """(…more, j, v): the named columns of complete rows, one under the other."""
    return values.select(*more, F.inline(F.array(*[F.struct(F.lit(int(c[1:])).alias("j"), F.col(c).alias("v")) for c in names])))


def _looked_up(tables: dict[str, tuple[np.ndarray, np.ndarray]], names: Sequence[str]):
    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for c in names:
                x = batch.column(c).to_numpy(zero_copy_only=False)
                out.append(pa.array(tables[c][1][np.searchsorted(tables[c][0], x)] if c in tables else x))
            yield pa.RecordBatch.from_arrays(out, names=list(names))
    return looked_up


def _rank_centres(ranks: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``_centres`` of the ranks, from the table of distinct values: the mean is that of 1 … n."""
    mean, spread = np.zeros(width), np.ones(width)
    off = (F.col("rank") - (F.col("n") + 1) / 2) / F.col("n")  # under 1: squares of whole ranks would lose digits
    sized = ranks.join(F.broadcast(ranks.groupBy("j").agg(F.sum("_n").alias("n"))), "j")  # a row a column
    for r in sized.groupBy("j").agg(F.first("n").alias("n"), F.sum(F.col("_n") * off * off).alias("s"), F.count(F.lit(1)).alias("levels")).collect():
        mean[r["j"]] = (r["n"] + 1) / 2
        if r["levels"] > 1:
            spread[r["j"]] = max(1e-9, math.sqrt(r["s"] / r["n"])) * r["n"]
    return mean, spread


def ranked(values: DataFrame) -> tuple[DataFrame, tuple[np.ndarray, np.ndarray]]:
    """``values`` (complete rows of c0, c1, …) with each value as its tie-averaged rank in its column,
    and the ranks' mean and standard deviation.

    Columns of few distinct values (``LOOKUP`` in all) are looked up in their
    small rank tables where the rows are; the others go through the two shuffles."""
    names = values.columns
    counts = written(_long(values, names).groupBy("j", "v").agg(F.count(F.lit(1)).alias("_n")))
    sizes = sorted((r["count"], f"c{r['j']}") for r in counts.groupBy("j").count().collect())  # a row a column
    few, total = set(), 0
    for size, c in sizes:
        total += size
        if total <= LOOKUP:
            few.add(c)
    ranks = written(running_totals(counts, ["j"], "v", ["_n"]).select("j", "v", "_n", (F.col("cum__n") - (F.col("_n") - 1) / 2.0).alias("rank")))
    small = ranks.where(F.col("j").isin([int(c[1:]) for c in few])).toPandas() if few else None  # at most LOOKUP rows
    tables = {}
    for c in few:
        own = small[small["j"] == int(c[1:])].sort_values("v")
        tables[c] = (own["v"].to_numpy(), own["rank"].to_numpy())
    many = [c for c in names if c not in few]
    kept = [c for c in names if c in few]
    if many:
        rows = written(values.select(F.monotonically_increasing_id().alias("row"), *names))  # fixes the row numbers
        first = int(many[0][1:])
        # the values that are looked up travel with one of the others
        long = _long(rows, many, "row", *kept).select("row", "j", "v", *[F.when(F.col("j") == first, F.col(c)).alias(c) for c in kept])
        back = long.join(ranks.select("j", "v", "rank"), ["j", "v"]).groupBy("row").agg(
            *[F.max(F.when(F.col("j") == int(c[1:]), F.col("rank"))).alias(c) for c in many], *[F.max(c).alias(c) for c in kept])
        values = back.select(*names)
    return values.mapInArrow(_looked_up(tables, names), ", ".join(f"{c} double" for c in names)), _rank_centres(ranks, len(names))


def correlation_matrix(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """(var1, var2, r) of every unordered pair over complete-case rows."""
    if method not in ("pearson", "spearman"):
        raise ValueError(f"unsupported method {method!r}")
    if len(columns) < 2:
        return _none(df)
    values = as_doubles(df, columns, complete=True)
    if method == "pearson":
        return _correlation(values, columns)
    # the ranks of the rows are read once, for their products
    ranks, centres = ranked(values)
    return _correlation(ranks, columns, centres)


def pearson_pairs(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pairwise-complete Pearson r of every unordered pair."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    return _correlation(as_doubles(df, cols, complete=False), cols) if len(cols) > 1 else _none(df)


# --------------------------------------------------------------------------- G3

def kendall_tau_b(df: DataFrame, x: str, y: str, digits: int | None = None) -> DataFrame:
    """tau_b, n, concordant, discordant, ties_x, ties_y of two columns' complete rows.

    Rows are counted by (x, y).  Discordant pairs are counted as merges do: each
    cell gets the ranks i of its x and j of its y among the distinct values; a
    pair of cells with i < k and j > l separates at exactly one level of the
    halving of the x ranks, where the two lie in the halves of one block.  At
    each level one running total by (block, j) gives every right cell the left
    cells above it, so the work is cells times levels, with no pairs of rows.
    """
    both = df.select(col(x).cast("double").alias("x"), col(y).cast("double").alias("y")).dropna()
    ensure_checkpoint_dir(df.sparkSession)
    cells = both.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    one = F.lit(1).cast("long")
    places = {c: running_totals(cells.select(c).distinct().withColumn("one", one), [], c, ["one"]).select(
        F.col(c).alias(f"_{c}"), (F.col("cum_one") - 1).alias(p)) for c, p in (("x", "i"), ("y", "j"))}
    placed = cells.join(places["x"], F.col("x") == F.col("_x")).join(places["y"], F.col("y") == F.col("_y")).select("i", "j", "n").checkpoint()
    sums = placed.agg(F.sum("n").cast("decimal(38,0)"), F.max("i"), F.sum(F.col("n").cast("decimal(38,0)") * (F.col("n") - 1) / 2)).first()
    if sums[0] is None:
        return df.sparkSession.createDataFrame([], "tau_b double, n long, concordant decimal(38,0), discordant decimal(38,0), ties_x decimal(38,0), ties_y decimal(38,0)")
    levels = max(1, int(sums[1]).bit_length())  # grows with the logarithm of the distinct values
    level = F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level")
    spread = placed.select("j", "n", level, "i").select(
        "level", F.expr("shiftright(i, level + 1)").alias("block"), "j", "n", (F.expr("shiftright(i, level)") % 2 == 1).alias("right"))
    # cells of one y and block together: equal y is no disorder
    lines = spread.groupBy("level", "block", "j").agg(F.sum(F.when(F.col("right"), 0).otherwise(F.col("n"))).alias("left"),
                                                      F.sum(F.when(F.col("right"), F.col("n")).otherwise(0)).alias("right"))
    above = running_totals(lines, ["level", "block"], "j", ["left"], descending=True)
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    discordant = above.agg(F.sum(wide("right") * (wide("cum_left") - wide("left"))).cast("decimal(38,0)").alias("discordant"))
    ties = [placed.groupBy(k).agg(F.sum("n").alias("m")).agg(F.sum(wide("m") * (wide("m") - 1) / 2).cast("decimal(38,0)").alias(f"ties_{c}")) for c, k in (("x", "i"), ("y", "j"))]
    n = int(sums[0])
    pairs, same = F.lit(n * (n - 1) // 2).cast("decimal(38,0)"), F.lit(int(sums[2])).cast("decimal(38,0)")
    # three tables of one row
    got = discordant.join(ties[0], how="cross").join(ties[1], how="cross")
    concordant = (pairs - F.col("ties_x") - F.col("ties_y") + same - F.col("discordant")).cast("decimal(38,0)")
    dbl = lambda c: c.cast("double")
    tau = F.try_divide(dbl(concordant - F.col("discordant")), F.sqrt(dbl(pairs - F.col("ties_x"))) * F.sqrt(dbl(pairs - F.col("ties_y"))))
    return got.select((F.round(tau, digits) if digits is not None else tau).alias("tau_b"), F.lit(n).cast("long").alias("n"), concordant.alias("concordant"), "discordant", "ties_x", "ties_y")
