"""Data-quality monitor and declarative expectations.

Each check is one (or two) aggregate jobs over the table and returns a
tidy per-column table; the report combines their single-row summaries.
Expectation suites compile to a single aggregate of violation counts.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .core import col, melt, numeric_columns, one_pass, small_join, string_columns
from .profile import duplicate_columns, duplicate_stats
from .stats import high_correlation_pairs

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
MISSING_CRITICAL_PCT = 10.0      # column critical when > 10 % missing
OUTLIER_Z = 3.0                  # |z| above this is an outlier
OUTLIER_CRITICAL_PCT = 5.0       # column critical when > 5 % outliers
SKEW_FLAG, KURT_FLAG, LOW_VARIANCE = 2.0, 3.0, 0.01
DISTRIBUTION_MIN_ROWS = 10       # distribution stats need more than 10 values
HIGH_CARDINALITY, LOW_CARDINALITY = 0.5, 0.1
CORRELATION_FLAG = 0.95
SCORE_PENALTY = {"missing_critical": 5, "outlier_critical": 3, "duplicates_over_5pct": 10, "constant": 2}
PASSING_SCORE = 70
# the expectation suite shipped with the reference (card data)
DEFAULT_SUITE = [
    {"expectation_type": "expect_column_to_exist", "kwargs": {"column": "LIMIT_BAL"}},
    {"expectation_type": "expect_column_to_exist", "kwargs": {"column": "AGE"}},
    {"expectation_type": "expect_column_to_exist", "kwargs": {"column": "target"}},
    {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "LIMIT_BAL"}},
    {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "target"}},
    {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "AGE", "min_value": 18, "max_value": 100}},
    {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "LIMIT_BAL", "min_value": 0, "max_value": 1000000}},
    {"expectation_type": "expect_column_values_to_be_in_set", "kwargs": {"column": "target", "value_set": [0, 1]}},
    {"expectation_type": "expect_column_values_to_be_in_set", "kwargs": {"column": "SEX", "value_set": [1, 2]}},
]


class QualityGateError(RuntimeError):
    """Raised when a table fails its expectation suite."""


def check_missing(df: DataFrame) -> DataFrame:
    """I1 per column: missing count, % (2 dp), critical (> 10 %, unrounded)."""
    r = one_pass(df, df.columns, {"missing": lambda c: F.count_if(c.isNull()).cast("long"),
                                  "rows": lambda c: F.count(F.lit(1)).cast("long")})
    pct = F.try_divide(F.col("missing") * 100.0, F.col("rows"))
    return r.select("column", "missing", F.round(pct, 2).alias("missing_pct"),
                    F.coalesce(pct > MISSING_CRITICAL_PCT, F.lit(False)).alias("critical"))


def missing_totals(df: DataFrame) -> DataFrame:
    """I1 totals: missing cells and their % of rows × columns."""
    m = one_pass(df, df.columns, {"missing": lambda c: F.count_if(c.isNull()).cast("long"),
                                  "rows": lambda c: F.count(F.lit(1)).cast("long")})
    return m.agg(F.sum("missing").cast("long").alias("total_missing"),
                 F.round(F.try_divide(F.sum("missing") * 100.0, F.sum("rows")), 2).alias("total_missing_pct"))


def check_outliers(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """I2 per numeric column with values: |z| > 3 count and % of non-null,
    mean and max |z| (population std; zero std -> z undefined, count 0)."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    m = one_pass(df, cols, {"mean": lambda c: F.avg(c).cast("double"),
                            "std": lambda c: F.stddev_pop(c).cast("double")})
    long = small_join(melt(df, [], cols), m, on="column", how="inner", known_rows=len(cols))
    z = F.when(F.col("std") > 0, F.abs((F.col("value") - F.col("mean")) / F.col("std")))
    g = long.groupBy("column").agg(F.count(F.lit(1)).alias("non_null"),
                                   F.count_if(z > OUTLIER_Z).alias("outliers"),
                                   F.avg(z).alias("mean_abs_z"), F.max(z).alias("max_abs_z"))
    pct = F.col("outliers") * 100.0 / F.col("non_null")
    return g.select("column", "outliers", F.round(pct, 2).alias("outlier_pct"),
                    F.round("mean_abs_z", 2).alias("mean_abs_z"), F.round("max_abs_z", 2).alias("max_abs_z"),
                    (pct > OUTLIER_CRITICAL_PCT).alias("critical"))


def check_distribution(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """I3 per numeric column with more than 10 values: mean, std, min, max, skew,
    excess kurtosis, sample variance (4 dp) and flags (on the rounded values)."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    r = one_pass(df, cols, {
        "n": lambda c: F.count(c).cast("double"), "mean": lambda c: F.avg(c).cast("double"),
        "std": lambda c: F.stddev_samp(c).cast("double"), "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"), "skewness": lambda c: F.skewness(c).cast("double"),
        "kurtosis": lambda c: F.kurtosis(c).cast("double"), "variance": lambda c: F.var_samp(c).cast("double")})
    rounded = r.where(F.col("n") > DISTRIBUTION_MIN_ROWS).select(
        "column", *[F.round(k, 4).alias(k) for k in ("mean", "std", "min", "max", "skewness", "kurtosis", "variance")])
    return rounded.withColumns({
        "high_skew": F.coalesce(F.abs("skewness") > SKEW_FLAG, F.lit(False)),
        "high_kurtosis": F.coalesce(F.abs("kurtosis") > KURT_FLAG, F.lit(False)),
        "low_variance": F.coalesce(F.col("variance") < LOW_VARIANCE, F.lit(False))})


def constant_columns(df: DataFrame) -> DataFrame:
    """I4: columns with at most one distinct non-null value (all-null included)."""
    r = one_pass(df, df.columns, {"constant": lambda c: F.coalesce(F.min(c) == F.max(c), F.lit(True))})
    return r.where("constant").select("column")


def check_integrity(df: DataFrame) -> DataFrame:
    """I4 summary row: duplicate rows and %, duplicate-column pairs, constant
    columns and highly correlated pairs (|r| > 0.95, pairwise complete)."""
    dup = duplicate_stats(df)
    n_dup_cols = duplicate_columns(df).count()
    n_const = constant_columns(df).count()
    n_corr = high_correlation_pairs(df, threshold=CORRELATION_FLAG).count()
    return dup.select("duplicate_rows", F.col("duplicate_pct").alias("duplicate_pct"),
                      F.lit(n_dup_cols).cast("long").alias("duplicate_column_pairs"),
                      F.lit(n_const).cast("long").alias("constant_columns"),
                      F.lit(n_corr).cast("long").alias("highly_correlated_pairs"))


def check_categorical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """I5 per string column: distinct count, distinct/rows (4 dp), mode (lowest
    value on ties) and its count, high (> .5) / low (< .1) cardinality flags."""
    cols = list(columns) if columns is not None else string_columns(df)
    rows = one_pass(df, cols, {"rows": lambda c: F.count(F.lit(1)).cast("long")})
    # distinct count and mode from the value counts: no value list in one reducer
    counts = melt(df, [], cols, value_type="string").groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
    top = counts.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"),
                                       F.min(F.struct((-F.col("_n")).alias("_o"), "value")).alias("_top"))
    j = rows.join(top, "column", "left").select(
        "column", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"), "rows", F.col("_top.value").alias("most_common"),
        F.coalesce(-F.col("_top._o"), F.lit(0)).alias("most_common_count"))
    ratio = F.try_divide(F.col("n_distinct"), F.col("rows"))
    return j.select("column", "n_distinct", F.round(ratio, 4).alias("unique_ratio"), "most_common",
                    "most_common_count", F.coalesce(ratio > HIGH_CARDINALITY, F.lit(False)).alias("high_cardinality"),
                    F.coalesce(ratio < LOW_CARDINALITY, F.lit(False)).alias("low_cardinality"))


def quality_report(df: DataFrame) -> DataFrame:
    """One row — score = 100 − 5·missing-critical − 3·outlier-critical
    − 10 (duplicates > 5 %) − 2·constant, floored at 0; ``passed`` when > 70."""
    miss = check_missing(df).agg(F.count_if("critical").alias("missing_critical"))
    outl = check_outliers(df).agg(F.count_if("critical").alias("outlier_critical"))
    integ = check_integrity(df)
    # three single-row summaries: combined on the driver as scalars
    m = miss.first()["missing_critical"]
    o = outl.first()["outlier_critical"]
    i = integ.first()
    score = 100 - SCORE_PENALTY["missing_critical"] * m - SCORE_PENALTY["outlier_critical"] * o \
        - (SCORE_PENALTY["duplicates_over_5pct"] if (i["duplicate_pct"] or 0) > 5 else 0) \
        - SCORE_PENALTY["constant"] * i["constant_columns"]
    score = max(0, score)
    return df.sparkSession.createDataFrame(
        [(float(score), int(m), int(o), int(i["duplicate_rows"] or 0), float(i["duplicate_pct"] or 0.0),
          int(i["constant_columns"]), int(i["highly_correlated_pairs"]), score > PASSING_SCORE)],
        "quality_score double, missing_critical long, outlier_critical long, duplicate_rows long, "
        "duplicate_pct double, constant_columns long, highly_correlated_pairs long, passed boolean")


# --------------------------------------------------------------------------- I7–I9

def _violation(exp: dict, df: DataFrame):
    """(kind, column, violation-count expression or None when not a value check)."""
    t, kw = exp["expectation_type"], exp.get("kwargs", {})
    c = kw.get("column")
    if t == "expect_column_to_exist":
        return None
    if c not in df.columns:
        return None
    x = col(c)
    if t == "expect_column_values_to_not_be_null":
        return F.count_if(x.isNull())
    if t == "expect_column_values_to_be_between":
        lo, hi = kw.get("min_value"), kw.get("max_value")
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (x < lo)
        if hi is not None:
            bad = bad | (x > hi)
        return F.count_if(x.isNotNull() & bad)
    if t == "expect_column_values_to_be_in_set":
        return F.count_if(x.isNotNull() & ~x.isin(*kw["value_set"]))
    if t == "expect_table_row_count_to_be_between":
        return None
    raise ValueError(f"unsupported expectation {t}")


def run_expectations(df: DataFrame, suite: Sequence[dict] | str = DEFAULT_SUITE) -> DataFrame:
    """One row per expectation (index, type, column, success, unexpected
    count, message), all value checks in ONE aggregate; values checks ignore
    nulls; a missing column fails that check without failing the job."""
    if isinstance(suite, str):
        suite = json.loads(suite)["expectations"] if suite.strip().startswith("{") else json.load(open(suite))["expectations"]
    exprs, rowcount = {}, None
    for i, e in enumerate(suite):
        v = _violation(e, df)
        if v is not None:
            exprs[f"e{i}"] = v.cast("long")
        if e["expectation_type"] == "expect_table_row_count_to_be_between":
            rowcount = F.count(F.lit(1)).cast("long")
    if rowcount is not None:
        exprs["_rows"] = rowcount
    res = df.agg(*[v.alias(k) for k, v in exprs.items()]).first().asDict() if exprs else {}
    rows = []
    for i, e in enumerate(suite):
        t, kw = e["expectation_type"], e.get("kwargs", {})
        c = kw.get("column")
        if t == "expect_column_to_exist":
            ok, bad = c in df.columns, 0
        elif t == "expect_table_row_count_to_be_between":
            n = res["_rows"]
            ok = (kw.get("min_value") is None or n >= kw["min_value"]) and \
                 (kw.get("max_value") is None or n <= kw["max_value"])
            bad = 0
        elif c not in df.columns:
            ok, bad = False, None
        else:
            bad = res[f"e{i}"]
            ok = bad == 0
        msg = None if ok else (f"column {c} not found" if bad is None and c is not None
                               else f"{t} failed for {c}: {bad} unexpected values")
        rows.append((i, t, c, bool(ok), bad, msg))
    return df.sparkSession.createDataFrame(
        rows, "idx int, expectation_type string, column string, success boolean, unexpected_count long, message string")


def expectation_report(results: DataFrame) -> DataFrame:
    """I8: success, evaluated / successful / unsuccessful counts and the failed list."""
    return results.agg(
        F.coalesce(F.bool_and("success"), F.lit(True)).alias("success"),
        F.count(F.lit(1)).alias("evaluated"), F.count_if("success").alias("successful"),
        F.count_if(~F.col("success")).alias("unsuccessful"),
        F.array_sort(F.collect_list(F.when(~F.col("success"), F.struct("idx", "expectation_type", "column",
                                                                        "message")))).alias("failed"))


def quality_gate(df: DataFrame, suite: Sequence[dict] = DEFAULT_SUITE) -> DataFrame:
    """Raise ``QualityGateError`` unless every expectation passes; returns ``df``."""
    res = expectation_report(run_expectations(df, suite)).first()
    if not res["success"]:
        raise QualityGateError(f"{res['unsuccessful']} of {res['evaluated']} expectations failed: "
                               + "; ".join(r["message"] for r in res["failed"]))
    return df
