"""Filters, dedup, imputation, scaling and encoding.

Fit-then-apply operators compute their statistics in one aggregate job
(result size = number of columns) and apply them as literals, so the
apply step is a plain codegen'd projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .core import col, melt, numeric_columns, small_join, string_columns, value_quantiles

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
MISSING_CATEGORY = "missing"          # E1: categorical column without a mode
UNKNOWN_TEXT = "неизвестно"           # E2: fill for non-numeric columns


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    """C1."""
    return df.dropna(subset=[target])


def complete_cases(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without any null (in ``columns`` or all columns)."""
    return df.dropna(how="any", subset=list(columns) if columns else None)


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Full-row dedup; nulls compare equal."""
    return df.dropDuplicates()


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Every row after the first occurrence of its value (count-1 copies).

    Grouping is partial-aggregated map-side, so a heavily repeated row is
    one row per task before the shuffle; the copies are re-expanded only
    for the output, in chunks that are dealt out again.
    """
    cols = [col(c) for c in df.columns]
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    step = 10_000
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 2) / step).cast("long")))
    g = g.withColumn("_chunk", chunks)
    g = g.withColumn("_m", F.least(F.lit(step).cast("long"), F.col("_n") - 1 - F.col("_chunk") * step))
    g = g.repartition(*cols, F.col("_chunk"))
    return g.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_m")))).drop("_n", "_m", "_chunk", "_copy")


def is_binary_01(df: DataFrame, c: str) -> DataFrame:
    """One row ``is_subset`` = non-null values ⊆ {0, 1}."""
    return df.agg(F.coalesce(F.bool_and(col(c).isin(0, 1)), F.lit(True)).alias("is_subset"))


def _stats_row(df: DataFrame, exprs: dict) -> dict:
    if not exprs:
        return {}
    row = df.agg(*[e.alias(k) for k, e in exprs.items()]).first()
    return row.asDict()


def _medians(df: DataFrame, columns: Sequence[str], exact: bool = True) -> dict:
    """{column: median}, one row per column on the driver; all-null columns are absent."""
    if not columns:
        return {}
    if exact:
        return {r["column"]: r["q"][0] for r in value_quantiles(df, columns, [0.5]).collect()}
    row = _stats_row(df, {f"n_{i}": F.percentile_approx(col(c), 0.5, 10000).cast("double") for i, c in enumerate(columns)})
    return {c: row[f"n_{i}"] for i, c in enumerate(columns) if row[f"n_{i}"] is not None}


def _modes(df: DataFrame, columns: Sequence[str]) -> dict:
    """{column: most frequent value, the lowest on ties} from the value counts."""
    if not columns:
        return {}
    counts = melt(df, [], columns, value_type="string").groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
    top = counts.groupBy("column").agg(F.min(F.struct((-F.col("_n")).alias("_o"), "value")).alias("_t"))
    return {r["column"]: r["value"] for r in top.select("column", "_t.value").collect()}


def impute(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
           fit_on: DataFrame | None = None, exact: bool = True) -> DataFrame:
    """Numeric -> median (as double), categorical -> mode (lowest on ties),
    ``'missing'`` when a column has no mode.  Statistics come from ``fit_on``
    (the training split; the reference fits on the whole table before the
    split, which leaks test rows — not copied)."""
    src = fit_on if fit_on is not None else df
    medians, modes = _medians(src, numeric, exact), _modes(src, categorical)
    fills = {c: F.coalesce(col(c).cast("double"), F.lit(medians.get(c)).cast("double")) for c in numeric}
    fills |= {c: F.coalesce(col(c), F.lit(modes.get(c, MISSING_CATEGORY))) for c in categorical}
    return df.withColumns(fills) if fills else df


def fill_by_type(df: DataFrame) -> DataFrame:
    """Numeric -> median (0 when the column is all null); other -> 'неизвестно'."""
    numeric = numeric_columns(df)
    medians = _medians(df, numeric)
    fills = {c: F.coalesce(col(c).cast("double"), F.lit(medians.get(c, 0.0)).cast("double")) for c in numeric}
    fills.update({c: F.coalesce(col(c).cast("string"), F.lit(UNKNOWN_TEXT))
                  for c in df.columns if c not in numeric})
    return df.withColumns(fills)


def standard_scale(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None,
                   suffix: str = "") -> DataFrame:
    """(x - mean) / population std; a zero (or undefined) std divides by 1."""
    src = fit_on if fit_on is not None else df
    exprs = {}
    for i, c in enumerate(columns):
        exprs[f"m_{i}"] = F.avg(col(c))
        exprs[f"s_{i}"] = F.stddev_pop(col(c))
    st = _stats_row(src, exprs)
    out = {}
    for i, c in enumerate(columns):
        m, s = st[f"m_{i}"], st[f"s_{i}"]
        s = 1.0 if not s else s
        out[c + suffix] = (col(c) - F.lit(m if m is not None else 0.0)) / F.lit(s)
    return df.withColumns(out)


def scale_each_numeric(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Z-score every numeric column that has more than one distinct value."""
    numeric = numeric_columns(df, exclude=exclude)
    if not numeric:
        return df
    varies = _stats_row(df, {f"d_{i}": F.min(col(c)) != F.max(col(c)) for i, c in enumerate(numeric)})
    keep = [c for i, c in enumerate(numeric) if varies[f"d_{i}"]]
    return standard_scale(df, keep)


def one_hot_drop_first(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None,
                       max_categories: int = 1000, categories: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """E5: indicator columns ``<col>_<value>`` for every category but the first
    (sorted); unseen and null values get all zeros.  ``categories`` names the
    list of a column; else it is read from the data.  The list becomes the
    output schema: beyond ``max_categories`` name it or use the ML encoder."""
    src = fit_on if fit_on is not None else df
    out = df
    for c in columns:
        cats = list((categories or {}).get(c, ()))
        if not cats:
            found = src.select(col(c).cast("string").alias("v")).where("v IS NOT NULL").distinct().limit(max_categories + 1).collect()
            cats = sorted(r["v"] for r in found)
            if len(cats) > max_categories:
                raise ValueError(f"{c} has more than {max_categories} categories: name them in ``categories``")
        out = out.withColumns({f"{c}_{v}": F.coalesce(col(c).cast("string") == F.lit(v), F.lit(False)).cast("double")
                               for v in cats[1:]})
    return out


def class_weights(df: DataFrame, target: str = "target") -> DataFrame:
    """Per class ``n`` , ``weight = N / (2 * n_c)`` and ``ratio`` = n0/n1."""
    counts = df.groupBy(col(target).alias(target)).agg(F.count(F.lit(1)).alias("n"))
    total = df.select(F.count(F.lit(1))).scalar()
    n0 = df.select(F.count_if(col(target) == 0)).scalar()
    n1 = df.select(F.count_if(col(target) == 1)).scalar()
    return counts.select(target, "n", (total / (2 * F.col("n"))).alias("weight"),
                         F.try_divide(n0.cast("double"), n1).alias("ratio"))


def with_class_weights(df: DataFrame, target: str = "target", out: str = "weight", classes: int | None = None) -> DataFrame:
    """Attach balanced class weights as a column (for ``weightCol``).  Where the
    number of ``classes`` is given the rows stay where they are; an exchange by
    class would leave as many tasks as there are classes."""
    w = class_weights(df, target).select(target, F.col("weight").alias(out))
    # one row per class
    return small_join(df, w, on=target, how="left", known_rows=classes)


def category_union(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("column", "value"),
                   value: str = "share") -> DataFrame:
    """Align two (keys…, value) tables on the union of keys, absent = 0."""
    j = a.withColumnRenamed(value, f"{value}_a").join(
        b.withColumnRenamed(value, f"{value}_b"), on=list(keys), how="full_outer")
    return j.fillna(0.0, subset=[f"{value}_a", f"{value}_b"])

