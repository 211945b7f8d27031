"""The correlation coefficient phi_K of every pair of columns (Baak et al., 2018).

Numeric columns are cut into equal-width bins, other columns go by their
values.  Tasks count the cells of all pairs' contingency tables in their
batches and return one small row for each cell that occurs; one sum over these
rows gives the tables.  Columns of many levels have no codes: the cells of their
pairs are counted, and their chi-squares summed, by exchanges of cells, and no
task or driver holds a table.  For each pair the chi-square of its table is then
compared with that of a bivariate normal distribution over the same number of
rows and columns: phi_K is the normal distribution's correlation.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import labels as L
from ..session import written
from .core import col, is_numeric, one_pass

#: the normal distribution is cut into equal steps from -RANGE to RANGE
RANGE = 5.0
#: text of more levels goes by its values through exchanges instead of by codes in batches
CODED_LEVELS = 1_000
#: cells of a table that are worked on at a time
CELLS = 1 << 14
#: steps in which the normal distribution is integrated where a table has more: that moves
#: phi_K by 2e-6 at the most up to 0.99999 (the table itself and its limits stay whole)
STEPS = 2_048
_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(64)


def _mass(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Standard normal share of each step from ``low`` to ``high``."""
    half = (high - low) / 2
    return half * (np.exp(-((low + half)[:, None] + half[:, None] * _NODES) ** 2 / 2) @ _WEIGHTS) / math.sqrt(2 * math.pi)


def _edge(i: np.ndarray, steps: int) -> np.ndarray:
    return i * (2 * RANGE / steps) - RANGE


def _normal(rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of ``rows`` steps and the standard normal share of each."""
    edges = _edge(np.arange(rows + 1), rows)
    return edges, _mass(edges[:-1], edges[1:])


def _diagonal_chi2(rows: int, columns: int) -> float:
    """``normal_chi2`` at 1: all mass lies on the diagonal, which crosses no more than
    ``rows + columns`` cells; they are worked on ``CELLS`` rows at a time."""
    rows, columns = max(rows, columns), min(rows, columns)
    inside, total = math.erf(RANGE / math.sqrt(2)), 0.0
    for first in range(0, rows, CELLS):
        x = _edge(np.arange(first, min(first + CELLS, rows) + 1), rows)
        near = (x[[0, -1]] + RANGE) / (2 * RANGE) * columns
        y = _edge(np.arange(math.floor(near[0]), math.ceil(near[1]) + 1), columns)
        cuts = np.unique(np.concatenate([x, y[(y > x[0]) & (y < x[-1])]]))
        middle = (cuts[1:] + cuts[:-1]) / 2
        i, j = (np.clip(np.floor((middle + RANGE) / (2 * RANGE) * k), 0, k - 1) for k in (rows, columns))
        share = _mass(cuts[:-1], cuts[1:])
        total += float((share ** 2 / (_mass(_edge(i, rows), _edge(i + 1, rows)) * _mass(_edge(j, columns), _edge(j + 1, columns)))).sum())
    # the other cells add what is expected of them
    return total - 2 * inside + inside ** 2


def normal_chi2(rho: float, rows: int, columns: int) -> float:
    """Chi-square of one record, against independence, of a bivariate normal
    distribution with correlation ``rho`` in ``rows`` by ``columns`` steps.

    A cell's share grows with rho by the density at its corners (Plackett), so
    its excess over independence is an integral over the correlation, taken in
    the angle whose sine it is.  At 1 the mass lies on the diagonal.  Under 1 the
    sum tends to an integral as steps narrow and is taken in ``STEPS`` at the most."""
    if rho >= 1.0:
        return _diagonal_chi2(rows, columns)
    rows, columns = min(rows, STEPS), min(columns, STEPS)
    (x, px), (y, py) = _normal(rows), _normal(columns)
    top = math.asin(rho)
    angle, weight = (_NODES + 1) * top / 2, _WEIGHTS * top / 2
    sine, cosine2 = np.sin(angle), np.cos(angle) ** 2
    total, step = 0.0, max(1, CELLS // (columns + 1))
    for first in range(0, rows, step):
        u = x[first:first + step + 1, None, None]
        v = y[None, :, None]
        corners = np.exp(-(u * u + v * v - 2 * u * v * sine) / (2 * cosine2)) @ weight / (2 * math.pi)
        excess = np.diff(np.diff(corners, axis=0), axis=1)
        total += float((excess ** 2 / np.outer(px[first:first + step], py)).sum())
    return total


def from_chi2(chi2: float, n: int, rows: int, columns: int) -> float | None:
    """phi_K of a table with this chi-square: 0 at or under what chance alone gives
    (the degrees of freedom), 1 at the largest that is possible."""
    if rows < 2 or columns < 2:
        return None
    chance, most = (rows - 1) * (columns - 1), n * (min(rows, columns) - 1)
    if chi2 <= chance:
        return 0.0
    if chi2 >= most * (1 - 1e-12):
        return 1.0
    wanted = (chi2 - chance) / (most - chance) * normal_chi2(1.0, rows, columns)
    low, high = 0.0, 1.0
    while high - low > 1e-7:
        middle = (low + high) / 2
        low, high = (middle, high) if normal_chi2(middle, rows, columns) < wanted else (low, middle)
    return (low + high) / 2


def _cells(codes: list[tuple[int, int]], levels: dict[int, pa.Array]):
    """Counts of the cells of all pairs in each batch; a text value's code is its
    place in its column's list of levels (-1: no value)."""
    def code_of(i: int, values: pa.Array) -> np.ndarray:
        places = pc.index_in(values.cast(pa.string()), levels[i]) if i in levels else values
        return pc.fill_null(places, -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = [code_of(i, c) for i, c in enumerate(batch.columns)]
            out = []
            for i, j, width in pairs:
                both = (code[i] >= 0) & (code[j] >= 0)
                cell, n = np.unique(code[i][both] * width + code[j][both], return_counts=True)
                out.append((np.full(len(cell), i), np.full(len(cell), j), cell // width, cell % width, n))
            if out:
                columns = [np.concatenate(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
                                                 names=["i", "j", "a", "b", "n"])
    sizes = dict(codes)
    pairs = [(i, j, sizes[j]) for i, j in combinations(sorted(sizes), 2)]
    return cells


def _solved(table: pd.DataFrame) -> pd.DataFrame:
    n = int(table["n"].sum())
    row, column = table.groupby("a")["n"].sum(), table.groupby("b")["n"].sum()
    expected = table["a"].map(row) * (table["b"].map(column) / n)
    # a cell that does not occur adds what is expected of it
    chi2 = float(((table["n"] - expected) ** 2 / expected).sum() + n - expected.sum())
    return pd.DataFrame({"i": [table["i"].iloc[0]], "j": [table["j"].iloc[0]], "rows": [n], "levels1": [len(row)], "levels2": [len(column)],
                         "phi_k": [from_chi2(chi2, n, len(row), len(column))]})


def _solved_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        phi = [from_chi2(*r) for r in zip(b["chi2"], b["rows"], b["levels1"], b["levels2"])]
        yield b.drop(columns="chi2").assign(phi_k=pd.array(phi, "Float64"))


def _by_exchange(values: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(i, j, rows, levels1, levels2, phi_k) of the ``pairs`` of the text columns c0, c1, ..., whatever
    their numbers of levels: cells, their rows and their columns are each counted by an exchange."""
    cell = F.array(*[F.struct(F.lit(int(a[1:])).alias("i"), F.lit(int(b[1:])).alias("j"), F.col(a).alias("a"), F.col(b).alias("b")) for a, b in pairs])
    counted = values.select(F.inline(cell)).where("a IS NOT NULL AND b IS NOT NULL").groupBy("i", "j", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    cells = written(counted)  # read three times
    row, column = (cells.groupBy("i", "j", side).agg(F.sum("n").alias(f"n_{side}")) for side in ("a", "b"))
    row, column = written(row), written(column)
    # a row a pair
    size = F.broadcast(row.groupBy("i", "j").agg(F.sum("n_a").alias("rows"), F.count(F.lit(1)).alias("levels1"))
                       .join(column.groupBy("i", "j").agg(F.count(F.lit(1)).alias("levels2")), ["i", "j"]))
    expected = F.col("n_a") * (F.col("n_b") / F.col("rows"))
    chi2 = cells.join(row, ["i", "j", "a"]).join(column, ["i", "j", "b"]).join(size, ["i", "j"]).withColumn("e", expected).groupBy("i", "j").agg(
        F.first("rows").alias("rows"), F.first("levels1").alias("levels1"), F.first("levels2").alias("levels2"),
        # a cell that does not occur adds what is expected of it
        (F.sum((F.col("n") - F.col("e")) ** 2 / F.col("e")) + F.first("rows") - F.sum("e")).alias("chi2"))
    tasks = min(len(pairs), values.sparkSession.sparkContext.defaultParallelism)
    return chi2.repartition(tasks).mapInPandas(_solved_sums, "i int, j int, rows long, levels1 long, levels2 long, phi_k double")


def phik_matrix(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 10, most_levels: int | None = None) -> DataFrame:
    """(var1, var2, rows, levels1, levels2, phi_k) of every pair of columns, by default all.

    Numeric columns go into ``bins`` equal steps from least to largest value (the
    empty ones do not count as levels), others by their text; a null, a NaN or
    an infinity takes a row out of its pairs.  phi_k is null where a side has one level.  All
    pairs are compared, however many levels their columns have, unless the caller gives
    ``most_levels``: pairs with text of more values are not counted then (rows and
    levels are null there too).  A pair without common rows is
    null likewise; the empty table gives such pairs."""
    columns = list(columns) if columns is not None else df.columns
    spark = df.sparkSession
    names = [f"c{i}" for i in range(len(columns))]
    numeric = {n for n, c in zip(names, columns) if is_numeric(df.schema[c].dataType)}

    def finite(c: str):
        v = col(c).cast("double")
        return F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)

    rows = df.select(*[(finite(c) if n in numeric else col(c).cast("string")).alias(n) for n, c in zip(names, columns)])
    text = [n for n in names if n not in numeric]
    coded = CODED_LEVELS if most_levels is None else most_levels
    few = {r["column"] for r in one_pass(rows, text, {"n": lambda c: F.approx_count_distinct(c, 0.02)}).where(F.col("n") <= 1.2 * coded).collect()} if text else set()
    # at most about 1.2 times ``coded`` values of each column
    found: dict[str, list[str]] = {n: [] for n in text if n in few}
    if found:
        values = rows.select(F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in found])))
        for r in values.where("value IS NOT NULL").distinct().collect():
            found[r["name"]].append(r["value"])
    levels = {n: sorted(v) for n, v in found.items() if len(v) <= coded}
    used = [n for n in names if n in numeric or n in levels]
    many = set() if most_levels is not None else set(text) - set(levels)
    ends = rows.agg(*[f(n) for n in names if n in numeric for f in (F.min, F.max)]).first() if numeric else ()
    low = dict(zip([n for n in names if n in numeric], zip(ends[::2], ends[1::2])))

    def bin_of(n: str):
        least, largest = low[n]
        if least is None or largest <= least:
            return F.when(F.col(n).isNotNull(), F.lit(0)).cast("int").alias(n)
        # halves, so that the width of far ends is finite
        share = (F.col(n) / 2 - least / 2) / (largest / 2 - least / 2)
        return F.when(F.col(n).isNotNull(), F.least(F.floor(share * bins), F.lit(bins - 1))).cast("int").alias(n)

    every = spark.createDataFrame([(i, j) for i, j in combinations(range(len(columns)), 2)], "i int, j int")
    name = F.array(*[F.lit(c) for c in columns]) if columns else F.array().cast("array<string>")
    head = [F.get(name, F.col("i")).alias("var1"), F.get(name, F.col("j")).alias("var2")]
    schema = "i int, j int, rows long, levels1 int, levels2 int, phi_k double"
    binned = rows.select(*[bin_of(n) if n in numeric else F.col(n) for n in names])
    parts = []
    if len(used) >= 2:
        at = {n: k for k, n in enumerate(used)}
        size = [(at[n], bins if n in numeric else max(1, len(levels[n]))) for n in used]
        # coded and counted in one Python worker a task: two would hold their libraries and batches twice
        counted = _cells(size, {at[n]: pa.array(v, pa.string()) for n, v in levels.items()})
        tables = binned.select(*used).mapInArrow(counted, "i int, j int, a int, b int, n long").groupBy("i", "j", "a", "b").agg(F.sum("n").alias("n"))
        solved = tables.groupBy("i", "j").applyInPandas(_solved, schema)
        place = F.array(*[F.lit(int(n[1:])) for n in used])
        parts.append(solved.select(F.get(place, F.col("i")).alias("i"), F.get(place, F.col("j")).alias("j"), "rows", "levels1", "levels2", "phi_k"))
    pairs = [(a, b) for a, b in combinations(names, 2) if a in many or b in many]
    if pairs:
        parts.append(_by_exchange(binned.select(*[F.col(n).cast("string") for n in names]), pairs).select(
            "i", "j", "rows", F.col("levels1").cast("int").alias("levels1"), F.col("levels2").cast("int").alias("levels2"), "phi_k"))
    if not parts:
        return every.select(*head, *[F.lit(None).cast(t).alias(c) for c, t in (("rows", "long"), ("levels1", "int"), ("levels2", "int"), ("phi_k", "double"))])
    solved = written(reduce(DataFrame.unionByName, parts))
    return every.join(solved, ["i", "j"], "left").select(*head, "rows", "levels1", "levels2", "phi_k")


def phik(df: DataFrame, threshold: float = 0.5, columns: Sequence[str] | None = None, bins: int = 10, most_levels: int | None = None) -> DataFrame:
    """Pairs with phi_K of ``threshold`` or more, rounded to two digits, with their label, the
    strongest first; then pairs that were not compared, for want of common rows (or for more than ``most_levels``)."""
    m = phik_matrix(df, columns, bins, most_levels)
    kept = m.where((F.col("phi_k") >= threshold) | F.col("rows").isNull())
    return kept.select("var1", "var2", F.round("phi_k", 2).alias("phi_k"),
                       F.coalesce(L.phik_label(F.col("phi_k")), F.lit("not compared")).alias("label")).orderBy(F.desc_nulls_last("phi_k"), "var1", "var2")
