"""Numeric distribution statistics and association measures.

Per-column moments/quantiles come from one aggregate job; per-row tests
(outliers, histograms, density grids) join the per-column statistics as a
broadcast table whose size is the column count.  Association statistics
work on long contingency counts, never on c² scans of the data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from .core import col, melt, numeric_columns, one_pass, small_join, value_quantiles
from .correlation import correlation_matrix, pearson_pairs


# --------------------------------------------------------------------------- F7

def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 2,
                    exact: bool = True) -> DataFrame:
    """F7 per numeric column with more than one distinct value: mean, median,
    p25/p75/p99 (linear interpolation), population skewness, excess
    kurtosis, the IQR as text and a skew verdict (|skew| <= .5 normal)."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    probs = (0.25, 0.5, 0.75, 0.99)
    s = one_pass(df, cols, {
        "varies": lambda c: F.coalesce(F.min(c) != F.max(c), F.lit(False)),
        "mean": lambda c: F.avg(c).cast("double"),
        "skew": lambda c: F.skewness(c).cast("double"),
        "kurtosis": lambda c: F.kurtosis(c).cast("double"),
    })
    if exact:
        q = value_quantiles(df, cols, probs)
    else:
        q = one_pass(df, cols, {"q": lambda c: F.percentile_approx(c.cast("double"), list(probs), 10000)})
    s = small_join(s, q, on="column", how="left", known_rows=len(cols)).select(
        "column", "varies", "mean", F.col("q")[0].alias("p25"), F.col("q")[1].alias("median"),
        F.col("q")[2].alias("p75"), F.col("q")[3].alias("p99"), "skew", "kurtosis")
    r = {k: F.round(k, digits).alias(k) for k in ("mean", "median", "p25", "p75", "p99", "skew", "kurtosis")}
    return s.where("varies").select(
        "column", *r.values(),
        F.concat(F.lit("["), F.round("p25", digits).cast("string"), F.lit(", "),
                 F.round("p75", digits).cast("string"), F.lit("]")).alias("iqr"),
        F.when(F.col("skew").between(-0.5, 0.5), "normal").when(F.col("skew") > 0.5, "right-skewed")
         .otherwise("left-skewed").alias("shape"))


# --------------------------------------------------------------------------- F9

def _bounds(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return one_pass(df, cols, {"lo": lambda c: F.min(c).cast("double"), "hi": lambda c: F.max(c).cast("double"),
                               "mean": lambda c: F.avg(c).cast("double"),
                               "std": lambda c: F.stddev_pop(c).cast("double"),
                               "n": lambda c: F.count(c).cast("double")})


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 30) -> DataFrame:
    """equal-width bins (last bin closed) with counts and the count an
    ideal normal (same mean / population std) would put in each bin."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    b = _bounds(df, cols)
    long = melt(df, [], cols)
    j = small_join(long, b, on="column", how="inner", known_rows=len(cols))
    width = F.col("hi") - F.col("lo")
    idx = F.when(width == 0, 1).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / width * bins) + 1, F.lit(bins))).cast("int")
    counts = j.groupBy("column", idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    full = counts.join(F.broadcast(b), "column")
    w = (F.col("hi") - F.col("lo")) / bins
    lower = F.col("lo") + (F.col("bin") - 1) * w
    mid = lower + w / 2
    pdf = F.exp(-0.5 * ((mid - F.col("mean")) / F.col("std")) ** 2) / (F.col("std") * math.sqrt(2 * math.pi))
    return full.select("column", "bin", lower.alias("lower"), (lower + w).alias("upper"), "count",
                       F.when(F.col("std") > 0, pdf * F.col("n") * w).alias("normal_expected"))


# --------------------------------------------------------------------------- F10 / F11

def outliers_iqr(df: DataFrame, columns: Sequence[str] | None = None, k: float = 1.5,
                 exact: bool = True) -> DataFrame:
    """(column, value) rows strictly outside [Q1 − k·IQR, Q3 + k·IQR]."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    if exact:
        q = value_quantiles(df, cols, (0.25, 0.75))
    else:
        q = one_pass(df, cols, {"q": lambda c: F.percentile_approx(c.cast("double"), [0.25, 0.75], 10000)})
    q = q.select("column", F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    q = q.select("column", (F.col("q1") - k * iqr).alias("lower"), (F.col("q3") + k * iqr).alias("upper"))
    j = small_join(melt(df, [], cols), q, on="column", how="inner", known_rows=len(cols))
    return j.where((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))).select(
        "column", "value", "lower", "upper")


def outliers_zscore(df: DataFrame, columns: Sequence[str] | None = None, threshold: float = 3.0) -> DataFrame:
    """(column, value, z) with |z| > threshold (population std; zero std -> none)."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    m = one_pass(df, cols, {"mean": lambda c: F.avg(c).cast("double"),
                            "std": lambda c: F.stddev_pop(c).cast("double")})
    j = small_join(melt(df, [], cols), m, on="column", how="inner", known_rows=len(cols))
    z = (F.col("value") - F.col("mean")) / F.col("std")
    return j.where(F.col("std") > 0).select("column", "value", z.alias("z")).where(F.abs("z") > threshold)


# --------------------------------------------------------------------------- F15

def pair_density(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 10) -> DataFrame:
    """2-D binned counts for every unordered numeric pair (the data behind
    a pair plot); rows with a null on either side of a pair are skipped."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    b = {r["column"]: (r["lo"], r["hi"]) for r in _bounds(df, cols).collect()}

    def bin_of(c: str) -> Column:
        lo, hi = b[c]
        if lo is None:
            return F.lit(None).cast("int")
        if hi == lo:
            return F.lit(1)
        return F.least(F.floor((col(c) - F.lit(lo)) / F.lit(hi - lo) * bins) + 1, F.lit(bins)).cast("int")

    pairs = [(x, y) for i, x in enumerate(cols) for y in cols[i + 1:]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "var1 string, var2 string, bin1 int, bin2 int, count long")
    arr = F.array(*[F.struct(F.lit(x).alias("var1"), F.lit(y).alias("var2"),
                             bin_of(x).alias("bin1"), bin_of(y).alias("bin2")) for x, y in pairs])
    long = df.select(F.inline(arr)).where("bin1 IS NOT NULL AND bin2 IS NOT NULL")
    return long.groupBy("var1", "var2", "bin1", "bin2").agg(F.count(F.lit(1)).alias("count"))


# --------------------------------------------------------------------------- G1 / G2 / G8

def correlations(df: DataFrame, columns: Sequence[str] | None = None, methods: Sequence[str] = ("pearson",),
                 threshold: float = 0.5) -> DataFrame:
    """Every unordered numeric pair on complete-case rows: |r| per method
    (2 dp) and its Cheddock label (from 12 digits: what sums in another order
    leave of a perfect 1 is still perfect); a pair is kept
    when any rounded |r| reaches ``threshold``; sorted by the first method."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    out = None
    for m in methods:
        r = correlation_matrix(df, cols, m).select(
            "var1", "var2", F.round(F.abs("r"), 2).alias(m), L.cheddock(F.round(F.abs("r"), 12)).alias(f"{m}_label"))
        out = r if out is None else out.join(r, ["var1", "var2"])
    keep = None
    for m in methods:
        cond = F.coalesce(F.col(m) >= threshold, F.lit(False))
        keep = cond if keep is None else keep | cond
    return out.where(keep).orderBy(F.desc(methods[0]))


def high_correlation_pairs(df: DataFrame, columns: Sequence[str] | None = None,
                           threshold: float = 0.95) -> DataFrame:
    """Pairs with |pairwise-complete r| > threshold."""
    return pearson_pairs(df, columns).where(F.abs("r") > threshold)


# --------------------------------------------------------------------------- G4 / G5

def contingency(df: DataFrame, pairs: Sequence[tuple[str, str]], round_numeric: bool = False) -> DataFrame:
    """Long contingency counts (var1, var2, cat1, cat2, n) for the given pairs;
    numeric values rounded half-to-even first when ``round_numeric``."""
    def v(c):
        x = col(c)
        return (F.bround(x.cast("double"), 0) if round_numeric else x).cast("string")
    arr = F.array(*[F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), v(a).alias("cat1"),
                             v(b).alias("cat2")) for a, b in pairs])
    long = df.select(F.inline(arr)).where("cat1 IS NOT NULL AND cat2 IS NOT NULL")
    return long.groupBy("var1", "var2", "cat1", "cat2").agg(F.count(F.lit(1)).alias("n"))


def chi2_tables(counts: DataFrame) -> DataFrame:
    """G4/G5 per pair: chi2 (Yates-corrected when the table is 2×2), n, r, c,
    phi (2×2 only) and Cramér's V (null when min(r, c) = 1).

    Zero cells never materialise: for r×c tables Σ over absent cells of
    (0 − e)²/e = n − Σ_present e.  For 2×2 tables the four cells are
    enumerated from the margins (4 rows per pair) to apply the correction.
    """
    k = ["var1", "var2"]
    rm = counts.groupBy(*k, "cat1").agg(F.sum("n").alias("r_n"))
    cm = counts.groupBy(*k, "cat2").agg(F.sum("n").alias("c_n"))
    dims = counts.groupBy(*k).agg(F.sum("n").alias("n"), F.count_distinct("cat1").alias("rows"),
                                  F.count_distinct("cat2").alias("cols"))
    cells = (counts.withColumnRenamed("n", "o").join(rm, [*k, "cat1"]).join(cm, [*k, "cat2"])
             .join(dims, k))
    e = F.col("r_n").cast("double") * F.col("c_n") / F.col("n")  # double: margins multiply beyond a long
    general = cells.groupBy(*k).agg(F.sum((F.col("o") - e) ** 2 / e).alias("_obs"), F.sum(e).alias("_sum_e"),
                                    F.first("n").alias("n"), F.first("rows").alias("rows"),
                                    F.first("cols").alias("cols"))
    chi_general = F.col("_obs") + (F.col("n") - F.col("_sum_e"))
    # 2×2 pairs: all four cells from the margins, observed joined back (absent -> 0)
    two = dims.where("rows = 2 AND cols = 2")
    r2 = rm.join(two.select(*k), k).groupBy(*k).agg(F.sort_array(F.collect_list(F.struct("cat1", "r_n"))).alias("R"))
    c2 = cm.join(two.select(*k), k).groupBy(*k).agg(F.sort_array(F.collect_list(F.struct("cat2", "c_n"))).alias("C"))
    grid = r2.join(c2, k).join(two.select(*k, "n"), k).select(
        *k, "n", F.inline(F.array(*[F.struct(F.col("R")[i]["cat1"].alias("cat1"), F.col("R")[i]["r_n"].alias("r_n"),
                                             F.col("C")[j]["cat2"].alias("cat2"), F.col("C")[j]["c_n"].alias("c_n"))
                                    for i in range(2) for j in range(2)])))
    g = grid.join(counts.withColumnRenamed("n", "o"), [*k, "cat1", "cat2"], "left").fillna(0, subset=["o"])
    e2 = F.col("r_n").cast("double") * F.col("c_n") / F.col("n")
    diff = F.abs(F.col("o") - e2)
    yates = g.groupBy(*k).agg(F.sum((diff - F.least(F.lit(0.5), diff)) ** 2 / e2).alias("chi2_yates"))
    out = general.join(yates, k, "left").select(
        *k, F.coalesce("chi2_yates", chi_general).alias("chi2"), "n", "rows", "cols")
    md = F.least(F.col("rows"), F.col("cols")) - 1
    return out.select(*k, "chi2", "n", "rows", "cols",
                      F.when((F.col("rows") == 2) & (F.col("cols") == 2),
                             F.sqrt(F.col("chi2") / F.col("n"))).alias("phi"),
                      F.when(md > 0, F.sqrt(F.col("chi2") / (F.col("n") * md))).alias("cramers_v"))


def cramers_vs_target(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """G5 (categorical vs target): Cramér's V per column with its label."""
    t = chi2_tables(contingency(df, [(c, target) for c in columns]))
    return t.select(F.col("var1").alias("feature"), "cramers_v",
                    F.when(F.col("cramers_v").isNull(), "none").otherwise(
                        L.cramers_label(F.col("cramers_v"))).alias("label"))


# --------------------------------------------------------------------------- G6

def _betainc(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b) by Lentz's continued fraction."""
    from math import lgamma
    out = np.full(len(x), np.nan)
    for i, (ai, bi, xi) in enumerate(zip(a, b, x)):
        if not (np.isfinite(ai) and np.isfinite(bi) and np.isfinite(xi)) or ai <= 0 or bi <= 0:
            continue
        if xi <= 0:
            out[i] = 0.0
            continue
        if xi >= 1:
            out[i] = 1.0
            continue
        flip = xi > (ai + 1) / (ai + bi + 2)
        aa, bb, xx = (bi, ai, 1 - xi) if flip else (ai, bi, xi)
        lbt = lgamma(aa + bb) - lgamma(aa) - lgamma(bb) + aa * math.log(xx) + bb * math.log(1 - xx)
        tiny = 1e-300
        c, d = 1.0, 1.0 - (aa + bb) * xx / (aa + 1)
        d = 1.0 / (d if abs(d) > tiny else tiny)
        h = d
        for m in range(1, 400):
            m2 = 2 * m
            num = m * (bb - m) * xx / ((aa + m2 - 1) * (aa + m2))
            d = 1 + num * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + num / c if abs(1 + num / c) > tiny else tiny
            h *= d * c
            num = -(aa + m) * (aa + bb + m) * xx / ((aa + m2) * (aa + m2 + 1))
            d = 1 + num * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + num / c if abs(1 + num / c) > tiny else tiny
            delta = d * c
            h *= delta
            if abs(delta - 1) < 1e-15:
                break
        val = math.exp(lbt) * h / aa
        out[i] = 1 - val if flip else val
    return out


def anova(df: DataFrame, group: str, columns: Sequence[str] | None = None, digits: int | None = None) -> DataFrame:
    """G6 one-way ANOVA of each numeric column across the groups of ``group``:
    F statistic from per-group count / mean / centred sum of squares (one
    aggregate of the data), p-value from the F distribution evaluated on the
    per-column result in Arrow batches (mapInPandas)."""
    cols = list(columns) if columns is not None else numeric_columns(df, exclude=[group])
    long = melt(df.where(col(group).isNotNull()), [group], cols)
    g = long.groupBy("column", col(group).alias("_g")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("m"), F.var_pop("value").alias("v"))
    tot = long.groupBy("column").agg(F.avg("value").alias("gm"))
    j = small_join(g, tot, on="column", how="inner", known_rows=len(cols))
    s = j.groupBy("column").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("N"),
        F.sum(F.col("n") * (F.col("m") - F.col("gm")) ** 2).alias("ssb"),
        F.sum(F.col("n") * F.col("v")).alias("ssw")).where("k > 1")
    fstat = F.try_divide(F.col("ssb") / (F.col("k") - 1), F.try_divide(F.col("ssw"), F.col("N") - F.col("k")))
    s = s.select("column", fstat.alias("f_statistic"), (F.col("k") - 1).cast("double").alias("df1"),
                 (F.col("N") - F.col("k")).cast("double").alias("df2"))

    def pvals(it):
        for pdf in it:
            f, d1, d2 = pdf["f_statistic"].to_numpy(float), pdf["df1"].to_numpy(float), pdf["df2"].to_numpy(float)
            x = d2 / (d2 + d1 * f)
            p = _betainc(d2 / 2, d1 / 2, x)
            yield pd.DataFrame({"column": pdf["column"], "f_statistic": f, "p_value": p})

    out = s.mapInPandas(pvals, "column string, f_statistic double, p_value double")
    if digits is not None:
        out = out.select("column", F.round("f_statistic", digits), F.round("p_value", digits + 2))
    return out


# --------------------------------------------------------------------------- F8

def kde_peak(df: DataFrame, columns: Sequence[str] | None = None, grid_points: int = 1000,
             bins: int | None = 4096, cutoff: float = 8.0) -> DataFrame:
    """F8: arg-max of a Gaussian KDE (Scott bandwidth n^(-1/5)·sample std) over
    ``grid_points`` equispaced points from min to max; null when singular.

    Values are compressed to (column, value, count) — exact — or, with
    ``bins``, to fine equal-width bins (bounded work at any scale).  Each
    value/bin contributes only to grid points within ``cutoff`` bandwidths
    (the Gaussian beyond 8h is below e^-32), so no grid × rows product."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    st = one_pass(df, cols, {"n": lambda c: F.count(c).cast("double"), "sd": lambda c: F.stddev_samp(c).cast("double"),
                             "lo": lambda c: F.min(c).cast("double"), "hi": lambda c: F.max(c).cast("double")})
    st = st.withColumn("h", F.col("sd") * F.pow(F.col("n"), -0.2)).where(
        (F.col("n") > 1) & (F.col("sd") > 0) & (F.col("hi") > F.col("lo")))
    long = small_join(melt(df, [], cols), st, on="column", how="inner", known_rows=len(cols))
    if bins:
        w = (F.col("hi") - F.col("lo")) / bins
        b = F.least(F.floor((F.col("value") - F.col("lo")) / w), F.lit(bins - 1))
        pts = long.select("column", (F.col("lo") + (b + 0.5) * w).alias("x"), "lo", "hi", "h", "n")
    else:
        pts = long.select("column", F.col("value").alias("x"), "lo", "hi", "h", "n")
    comp = pts.groupBy("column", "x", "lo", "hi", "h", "n").agg(F.count(F.lit(1)).alias("cnt"))
    step = (F.col("hi") - F.col("lo")) / (grid_points - 1)
    first = F.greatest(F.ceil((F.col("x") - cutoff * F.col("h") - F.col("lo")) / step), F.lit(0)).cast("int")
    last = F.least(F.floor((F.col("x") + cutoff * F.col("h") - F.col("lo")) / step), F.lit(grid_points - 1)).cast("int")
    near = comp.where(first <= last).select("*", F.explode(F.sequence(first, last)).alias("i"))
    g = F.col("lo") + F.col("i") * step
    dens = near.groupBy("column", "i", "lo", "hi", "h", "n").agg(
        F.sum(F.col("cnt") * F.exp(-0.5 * ((g - F.col("x")) / F.col("h")) ** 2)).alias("_s"))
    dens = dens.select("column", g.alias("grid_x"),
                       (F.col("_s") / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))).alias("density"))
    peaks = dens.groupBy("column").agg(F.max_by("grid_x", F.struct("density", F.col("grid_x") * -1)).alias("peak"),
                                       F.max("density").alias("peak_density"))
    return st.select("column").join(peaks, "column", "left")
