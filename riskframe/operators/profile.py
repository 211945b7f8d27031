"""Profiling aggregations.

Every operator returns a long table (one row per column, per
(column, value) or per pair) built by a bounded number of aggregate jobs:
wide statistics by ``one_pass``; value-level statistics by melting the
columns to ``(column, value)`` and grouping, which partial-aggregates
map-side so a hot value costs one row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .core import col, melt, numeric_columns, one_pass, safe_corr, small_join, string_columns

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
DATE_PATTERN = "d.M.yyyy"            # day.month.year strings, leading zeros optional
DATE_LIKE_SHARE = 0.8                # parseable share (of non-null) above which a column is a date
LEAKAGE_NAMES = ["default.payment.next.month", "y", "default", "is_bad", "is_default"]
REPRESENTATIVE_NUMERIC = [(2.0, "good"), (5.0, "fair")]      # rel. diff % < bound
REPRESENTATIVE_CATEGORICAL = [(1.0, "good"), (3.0, "fair")]  # mean abs share diff % < bound


def _dtype(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


# --------------------------------------------------------------------------- F1

def profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """per column nulls, null % (2 dp), dtype, distinct non-null and a
    recommendation (constant / identifier / keep).

    Distinct counts: exact via melt + two-level grouping (no multi-distinct
    Expand of the whole row), or HyperLogLog with ``approx=True``.
    """
    n = F.count(F.lit(1))
    base = one_pass(df, df.columns, {"nulls": lambda c: F.count_if(c.isNull()).cast("long"),
                                     "rows": lambda c: F.count(F.lit(1)).cast("long")})
    if approx:
        distinct = one_pass(df, df.columns, {"distinct": lambda c: F.approx_count_distinct(c).cast("long")})
    else:
        long = melt(df, [], df.columns, value_type="string")
        distinct = (long.groupBy("column", "value").agg(n.alias("_c"))
                    .groupBy("column").agg(F.count(F.lit(1)).alias("distinct")))
    types = df.sparkSession.createDataFrame(list(_dtype(df).items()), "column string, dtype string")
    out = (base.join(distinct, "column", "left").join(F.broadcast(types), "column", "inner")
           .fillna(0, subset=["distinct"]))
    return out.select(
        "column", "dtype", "nulls",
        F.round(F.try_divide(F.col("nulls") * 100.0, F.col("rows")), 2).alias("null_pct"),
        "distinct",
        F.when(F.col("distinct") == 1, "drop_constant")
         .when(F.col("distinct") == F.col("rows"), "drop_identifier")
         .otherwise("keep").alias("recommendation"))


# --------------------------------------------------------------------------- F2/F3

def duplicate_stats(df: DataFrame) -> DataFrame:
    """rows, duplicate rows (after the first occurrence) and their %."""
    g = df.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.sum("_n").cast("long").alias("rows"),
                 F.sum(F.col("_n") - 1).cast("long").alias("duplicate_rows")).select(
        "rows", "duplicate_rows",
        F.round(F.try_divide(F.col("duplicate_rows") * 100.0, F.col("rows")), 2).alias("duplicate_pct"))


def duplicate_columns(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """pairs (left < right in column order) equal on every row, nulls equal,
    same dtype.  Stage 1: one pass of an order-insensitive fingerprint per
    column (xor of hash(row, value)); stage 2 verifies only colliding pairs
    exactly with null-safe equality.  Never builds all c² comparisons."""
    cols = [c for c in df.columns if c not in set(exclude)]
    schema = "left string, right string"
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], schema)
    rowkey = F.xxhash64(*[col(c) for c in df.columns])
    fps = one_pass(df.withColumn("_rk", rowkey), cols,
                   {"fp": lambda c: F.bit_xor(F.xxhash64(F.col("_rk"), c))}).collect()
    types = _dtype(df)
    groups: dict[tuple, list[str]] = {}
    for r in fps:
        groups.setdefault((types[r["column"]], r["fp"]), []).append(r["column"])
    order = {c: i for i, c in enumerate(cols)}
    cands = [(a, b) for g in groups.values() if len(g) > 1
             for i, a in enumerate(sorted(g, key=order.get)) for b in sorted(g, key=order.get)[i + 1:]]
    if not cands:
        return df.sparkSession.createDataFrame([], schema)
    row = df.agg(*[F.bool_and(col(a).eqNullSafe(col(b))).alias(f"p{i}") for i, (a, b) in enumerate(cands)]).first()
    pairs = [(a, b) for i, (a, b) in enumerate(cands) if row[f"p{i}"] in (True, None)]
    return df.sparkSession.createDataFrame(pairs, schema)


# --------------------------------------------------------------------------- F4–F6, F12–F14

def value_counts(df: DataFrame, c: str) -> DataFrame:
    """(value, count) for one column, most frequent first."""
    return df.groupBy(col(c).alias("value")).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"))


def date_like_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """columns whose non-null values parse as d.m.Y in more than 80 % of rows."""
    if not columns:
        return []
    shares = one_pass(df, columns, {"share": lambda c: F.avg(
        F.when(c.isNotNull(), F.try_to_timestamp(c.cast("string"), F.lit(DATE_PATTERN)).isNotNull().cast("double")))})
    return [r["column"] for r in shares.collect() if r["share"] is not None and r["share"] > DATE_LIKE_SHARE]


def date_like_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """F14 as a table: (column, parse_share, is_date_like)."""
    shares = one_pass(df, columns, {"parse_share": lambda c: F.avg(
        F.when(c.isNotNull(), F.try_to_timestamp(c.cast("string"), F.lit(DATE_PATTERN)).isNotNull().cast("double")))})
    return shares.withColumn("is_date_like", F.coalesce(F.col("parse_share") > DATE_LIKE_SHARE, F.lit(False)))


def categorical_columns(df: DataFrame, columns: Sequence[str] | None = None,
                        exclude: Sequence[str] = ()) -> list[str]:
    cols = list(columns) if columns is not None else string_columns(df, exclude)
    dates = set(date_like_columns(df, cols))
    return [c for c in cols if c not in dates]


def categorical_distribution(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, value, count) over non-null values of the categorical columns."""
    cols = categorical_columns(df, columns)
    long = melt(df, [], cols, value_type="string", name_col="feature")
    return long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("count"))


def categorical_vs_target(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, value, target, count); rows without a target are left out."""
    cols = categorical_columns(df, columns, exclude=[target])
    long = melt(df.where(col(target).isNotNull()), [target], cols, value_type="string", name_col="feature")
    return long.groupBy("feature", "value", target).agg(F.count(F.lit(1)).alias("count"))


def rare_categories(df: DataFrame, columns: Sequence[str] | None = None, threshold: float = 0.05) -> DataFrame:
    """(feature, value, count, share) with share of non-null < threshold."""
    dist = categorical_distribution(df, columns)
    totals = dist.groupBy("feature").agg(F.sum("count").alias("_total"))
    # one row per feature: bounded by the column count
    j = small_join(dist, totals, on="feature", how="inner", known_rows=len(categorical_columns(df, columns)))
    return j.select("feature", "value", "count", (F.col("count") / F.col("_total")).alias("share")) \
            .where(F.col("share") < threshold)


def crosstabs(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """counts of every unordered pair of categorical columns, long form
    (var1, cat1, var2, cat2, count).  Rows with a null on either side of a
    pair are skipped, as a contingency table does."""
    cols = categorical_columns(df, columns)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "var1 string, cat1 string, var2 string, cat2 string, count long")
    arr = F.array(*[F.struct(F.lit(a).alias("var1"), col(a).cast("string").alias("cat1"),
                             F.lit(b).alias("var2"), col(b).cast("string").alias("cat2")) for a, b in pairs])
    long = df.select(F.inline(arr)).where("cat1 IS NOT NULL AND cat2 IS NOT NULL")
    return long.groupBy("var1", "cat1", "var2", "cat2").agg(F.count(F.lit(1)).alias("count"))


def crosstab_conclusions(tabs: DataFrame) -> DataFrame:
    """F12 verdict per pair: '1:1' iff every row and column margin equals 1."""
    r = tabs.groupBy("var1", "var2", "cat1").agg(F.sum("count").alias("m"))
    c = tabs.groupBy("var1", "var2", "cat2").agg(F.sum("count").alias("m"))
    rm = r.groupBy("var1", "var2").agg(F.max("m").alias("max_row"))
    cm = c.groupBy("var1", "var2").agg(F.max("m").alias("max_col"))
    return rm.join(cm, ["var1", "var2"]).select(
        "var1", "var2", F.when((F.col("max_row") == 1) & (F.col("max_col") == 1), "1:1")
        .otherwise("ambiguous").alias("conclusion"))


# --------------------------------------------------------------------------- F16

def _representative_label(c, scale, n_a):
    expr = F.when(n_a, "n/a")
    for bound, label in scale:
        expr = expr.when(c < bound, label)
    return expr.otherwise("alarming")


def representativeness_numeric(sample: DataFrame, full: DataFrame,
                               columns: Sequence[str] | None = None) -> DataFrame:
    """Per numeric column: means of both, |Δ|, |Δ|/|mean(sample)|·100 and a
    status (< 2 good, < 5 fair, else alarming; n/a when mean(sample) is 0 or null).
    The denominator is the *first* argument, as in the reference."""
    cols = list(columns) if columns is not None else numeric_columns(sample)
    a = one_pass(sample, cols, {"mean_sample": lambda c: F.avg(c).cast("double")})
    b = one_pass(full, cols, {"mean_full": lambda c: F.avg(c).cast("double")})
    j = a.join(b, "column", "inner")
    diff = F.abs(F.col("mean_sample") - F.col("mean_full"))
    rel = F.when(F.col("mean_sample") != 0, diff / F.abs(F.col("mean_sample")) * 100)
    return j.select("column", F.round("mean_sample", 4).alias("mean_sample"),
                    F.round("mean_full", 4).alias("mean_full"),
                    F.round(diff, 4).alias("abs_diff"), F.round(rel, 4).alias("rel_diff_pct"),
                    _representative_label(rel, REPRESENTATIVE_NUMERIC, rel.isNull()).alias("status"))


def category_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, share) over non-null values."""
    long = melt(df, [], columns, value_type="string")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("column")
    return counts.select("column", "value", (F.col("n") / F.sum("n").over(w)).alias("share"))


def representativeness_categorical(sample: DataFrame, full: DataFrame,
                                   columns: Sequence[str] | None = None) -> DataFrame:
    """Mean over the union of categories of |share_full − share_sample|·100,
    the category count, and a status (< 1 good, < 3 fair, else alarming)."""
    cols = list(columns) if columns is not None else string_columns(sample)
    a = category_shares(sample, cols).withColumnRenamed("share", "share_a")
    b = category_shares(full, cols).withColumnRenamed("share", "share_b")
    j = a.join(b, ["column", "value"], "full_outer").fillna(0.0, subset=["share_a", "share_b"])
    g = j.groupBy("column").agg(F.avg(F.abs(F.col("share_b") - F.col("share_a")) * 100).alias("mean_diff_pct"),
                                F.count(F.lit(1)).alias("categories"))
    return g.select("column", F.round("mean_diff_pct", 4).alias("mean_diff_pct"), "categories",
                    _representative_label(F.col("mean_diff_pct"), REPRESENTATIVE_CATEGORICAL,
                                          F.lit(False)).alias("status"))


def representativeness_verdict(statuses: DataFrame) -> DataFrame:
    """Counts per status, % good and the verdict: the status that
    outnumbers each of the other two, else ambiguous; n/a when empty."""
    s = F.col("status")
    g = statuses.agg(F.count_if(s == "good").alias("good"), F.count_if(s == "fair").alias("fair"),
                     F.count_if(s == "alarming").alias("alarming"))
    g1, g2, g3 = F.col("good"), F.col("fair"), F.col("alarming")
    tot = g1 + g2 + g3
    return g.select("good", "fair", "alarming",
                    F.round(F.coalesce(F.try_divide(F.col("good") * 100.0, tot), F.lit(0.0)), 2).alias("good_pct"),
                    F.when(tot == 0, "n/a")
                     .when((g1 > g2) & (g1 > g3), "representative")
                     .when((g2 > g1) & (g2 > g3), "partly representative")
                     .when((g3 > g1) & (g3 > g2), "not representative")
                     .otherwise("ambiguous").alias("verdict"))


# --------------------------------------------------------------------------- F17–F20

def target_analysis(df: DataFrame, target: str = "target") -> DataFrame:
    """total, counts and % of good (0) and bad (1), warning when a class is missing."""
    t = col(target)
    g = df.where(t.isNotNull()).agg(F.count(F.lit(1)).alias("total"),
                                    F.count_if(t == 0).alias("good"), F.count_if(t == 1).alias("bad"))
    return g.select("total", "good", "bad",
                    F.round(F.try_divide(F.col("good") * 100.0, F.col("total")), 2).alias("good_pct"),
                    F.round(F.try_divide(F.col("bad") * 100.0, F.col("total")), 2).alias("bad_pct"),
                    F.when((F.col("good") == 0) | (F.col("bad") == 0), "one class missing").alias("warning"))


def target_correlations(df: DataFrame, target: str = "target", threshold: float = 0.9) -> DataFrame:
    """(column, abs_corr, high): |pearson(col, target)| of every numeric column
    (pairwise complete; none where a side is constant), high when > threshold."""
    cols = numeric_columns(df, exclude=[target])
    r = one_pass(df, cols, {"abs_corr": lambda c: F.abs(safe_corr(c, col(target)))})
    return r.where(F.col("abs_corr").isNotNull()).withColumn("high", F.col("abs_corr") > threshold)


def leakage_correlation(df: DataFrame, target: str = "target", top: int = 10,
                        threshold: float = 0.9) -> DataFrame:
    """the top ``top`` of ``target_correlations`` by value."""
    return target_correlations(df, target, threshold).orderBy(F.desc("abs_corr"), "column").limit(top)


def leakage_names(df: DataFrame, target: str = "target") -> DataFrame:
    """suspicious-name columns holding exactly two values ⊆ {0,1} (a null fails)."""
    cols = [c for c in df.columns if c in LEAKAGE_NAMES and c != target]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string")
    r = one_pass(df, cols, {
        "distinct": lambda c: F.count_distinct(c).cast("double"),
        "subset": lambda c: F.bool_and(F.coalesce(c.isin(0, 1), F.lit(False))).cast("double")})
    return r.where((F.col("distinct") == 2) & (F.col("subset") == 1)).select("column")


def leakage_report(df: DataFrame, target: str = "target") -> DataFrame:
    """counts of duplicate columns, high correlations (all of them, not the
    top of F18) and suspicious names."""
    dups = duplicate_columns(df, exclude=[target]).count()
    high = target_correlations(df, target).where("high").count()
    names = leakage_names(df, target).count()
    return df.sparkSession.createDataFrame(
        [("duplicate_columns", dups), ("high_correlation", high), ("problematic_columns", names)],
        "check string, count long")

