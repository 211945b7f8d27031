"""Drift, performance and fairness monitoring.

KS drift compares two tables through their per-(feature, value) counts:
both sides are grouped (partial aggregation), merged on the value, and the
empirical CDFs come from the distributed ``running_totals``.  Only the
counts of distinct values move through the shuffle, never the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .core import col, melt, numeric_columns, one_pass, running_totals
from .metrics import _rates, confusion_counts

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
DRIFT_P_THRESHOLD = 0.1      # per-feature drift: p < 0.1
DRIFT_SCORE_THRESHOLD = 0.1  # overall drift: mean KS statistic > 0.1
BIAS_THRESHOLD = 0.1         # accuracy gap between groups
F1_FLOOR = 0.7               # performance degraded below this f1


def kolmogorov_pvalue(d: Column, n1: Column, n2: Column, terms: int = 100) -> Column:
    """Asymptotic two-sample KS p-value, Q_KS(λ) with Stephens' small-sample
    correction λ = (√nₑ + 0.12 + 0.11/√nₑ)·D.  scipy uses the exact
    distribution below 10 000 rows, so small-sample p-values differ slightly;
    the statistic D is exact."""
    ne = n1 * n2 / (n1 + n2)
    lam = (F.sqrt(ne) + 0.12 + 0.11 / F.sqrt(ne)) * d
    # Σ_k 2(-1)^(k-1) exp(-2 k² λ²) as one higher-order expression (small codegen)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * lam * lam))
    # for small λ that series needs about 1/λ terms; its theta transform,
    # √(2π)/λ Σ_k exp(-(2k-1)² π² / (8 λ²)) = 1 - Q, needs a few
    small = F.aggregate(F.sequence(F.lit(1), F.lit(10)), F.lit(0.0),
                        lambda acc, k: acc + F.exp(-(2 * k - 1) * (2 * k - 1) * math.pi ** 2 / (8.0 * lam * lam)))
    q = F.when(lam < 1.0, 1.0 - math.sqrt(2 * math.pi) / lam * small).otherwise(series)
    return F.when(lam < 0.04, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), q)))


def _ks_statistics(counts: DataFrame) -> DataFrame:
    """(column, tot_ref, tot_cur, ks_statistic) from (column, value, n_ref, n_cur);
    columns with no value on a side are left out."""
    cum = running_totals(counts, ["column"], "value", ["n_ref", "n_cur"])
    tot = counts.groupBy("column").agg(F.sum("n_ref").alias("tot_ref"), F.sum("n_cur").alias("tot_cur"))
    stat = cum.join(tot.where((F.col("tot_ref") > 0) & (F.col("tot_cur") > 0)), "column").groupBy("column", "tot_ref", "tot_cur")
    return stat.agg(F.max(F.abs(F.col("cum_n_ref") / F.col("tot_ref") - F.col("cum_n_cur") / F.col("tot_cur"))).alias("ks_statistic"))


def drift_from_counts(reference: DataFrame, current: DataFrame) -> DataFrame:
    """J1 from value counts (column, value, n), the rows that ``ks_drift`` gives on
    the values themselves."""
    both = reference.select("column", "value", F.col("n").alias("n_ref"), F.lit(0).cast("long").alias("n_cur")).unionByName(
        current.select("column", "value", F.lit(0).cast("long").alias("n_ref"), F.col("n").alias("n_cur")))
    counts = both.groupBy("column", "value").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    stat = _ks_statistics(counts)
    means = counts.groupBy("column").agg(*[F.try_divide(F.sum(F.col("value") * F.col(f"n_{s}")), F.sum(f"n_{s}")).alias(f"m_{s}") for s in ("ref", "cur")])
    # spreads about the means: one row of means for each column
    spread = lambda s: F.sqrt(F.try_divide(F.sum(F.col(f"n_{s}") * (F.col("value") - F.col(f"m_{s}")) ** 2), F.sum(f"n_{s}") - 1))
    moments = counts.join(means, "column").groupBy("column", "m_ref", "m_cur").agg(spread("ref").alias("s_ref"), spread("cur").alias("s_cur"))
    p = kolmogorov_pvalue(F.col("ks_statistic"), F.col("tot_ref").cast("double"), F.col("tot_cur").cast("double"))
    return stat.join(moments, "column").withColumn("p_value", p).select(
        F.col("column").alias("feature"), "ks_statistic", "p_value", (F.col("p_value") < DRIFT_P_THRESHOLD).alias("drift_detected"),
        F.col("m_ref").alias("reference_mean"), F.col("m_cur").alias("current_mean"), F.col("s_ref").alias("reference_std"),
        F.col("s_cur").alias("current_std"), F.col("tot_ref").alias("reference_n"), F.col("tot_cur").alias("current_n"))


def ks_drift(reference: DataFrame, current: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """Per numeric feature present in both tables (nulls dropped; skipped
    when a side has no values): ks_statistic, p_value, drift (p < 0.1),
    both means and sample standard deviations."""
    feats = [c for c in (features if features is not None else numeric_columns(current))
             if c in reference.columns and c in current.columns]
    ref = melt(reference, [], feats).withColumn("_side", F.lit(0))
    cur = melt(current, [], feats).withColumn("_side", F.lit(1))
    both = ref.unionByName(cur)
    counts = both.groupBy("column", "value").agg(F.count_if(F.col("_side") == 0).alias("n_ref"),
                                                 F.count_if(F.col("_side") == 1).alias("n_cur"))
    stat = _ks_statistics(counts)
    moments = both.groupBy("column").agg(
        F.avg(F.when(F.col("_side") == 0, F.col("value"))).alias("reference_mean"),
        F.avg(F.when(F.col("_side") == 1, F.col("value"))).alias("current_mean"),
        F.stddev_samp(F.when(F.col("_side") == 0, F.col("value"))).alias("reference_std"),
        F.stddev_samp(F.when(F.col("_side") == 1, F.col("value"))).alias("current_std"))
    p = kolmogorov_pvalue(F.col("ks_statistic"), F.col("tot_ref").cast("double"), F.col("tot_cur").cast("double"))
    return stat.join(moments, "column").withColumn("p_value", p).select(
        F.col("column").alias("feature"), "ks_statistic", "p_value",
        (F.col("p_value") < DRIFT_P_THRESHOLD).alias("drift_detected"),
        "reference_mean", "current_mean", "reference_std", "current_std",
        F.col("tot_ref").alias("reference_n"), F.col("tot_cur").alias("current_n"))


def drift_score(drift: DataFrame) -> DataFrame:
    """Mean KS statistic and overall drift (> 0.1)."""
    return drift.agg(F.avg("ks_statistic").alias("drift_score"),
                     F.coalesce(F.avg("ks_statistic") > DRIFT_SCORE_THRESHOLD, F.lit(False)).alias("overall_drift"),
                     F.count_if("drift_detected").alias("drifted_features"))


def group_bias(df: DataFrame, attributes: Sequence[str], label: str = "label",
               prediction: str = "prediction") -> DataFrame:
    """J4 per group: accuracy, precision, recall, f1, size for every attribute
    value (null values ignored); attributes with a single group are skipped."""
    long = melt(df, [label, prediction], attributes, value_type="string", name_col="attribute",
                value_col="group")
    c = confusion_counts(long, ["attribute", "group"], label, prediction)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    g = c.select("attribute", "group", *[v.alias(k) for k, v in _rates(tn, fp, fn, tp).items()],
                 (tn + fp + fn + tp).alias("size"))
    from pyspark.sql import Window
    w = Window.partitionBy("attribute")
    return g.withColumn("_groups", F.count(F.lit(1)).over(w)).where("_groups > 1").drop("_groups")


def bias_summary(groups: DataFrame) -> DataFrame:
    """J4 per attribute: max − min accuracy and ``bias_detected`` (> 0.1)."""
    return groups.groupBy("attribute").agg(
        (F.max("accuracy") - F.min("accuracy")).alias("max_accuracy_difference"),
        F.count(F.lit(1)).alias("groups")).withColumn(
        "bias_detected", F.col("max_accuracy_difference") > BIAS_THRESHOLD)


def monitoring_report(drift_summary: DataFrame, perf: DataFrame, bias: DataFrame) -> DataFrame:
    """Alert rows (data_drift high, performance_degradation high,
    prediction_bias medium) plus an ``overall_status`` row."""
    alerts = (drift_summary.where("overall_drift").select(
                  F.lit("data_drift").alias("type"), F.lit("high").alias("severity"),
                  F.lit("data drift detected").alias("message"))
              .unionByName(perf.where("degraded").select(
                  F.lit("performance_degradation").alias("type"), F.lit("high").alias("severity"),
                  F.lit("performance degradation detected").alias("message")))
              .unionByName(bias.agg(F.bool_or("bias_detected").alias("b")).where("b").select(
                  F.lit("prediction_bias").alias("type"), F.lit("medium").alias("severity"),
                  F.lit("prediction bias detected").alias("message"))))
    status = alerts.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("overall_status").alias("type"), F.lit("info").alias("severity"),
        F.when(F.col("n") == 0, "healthy").otherwise("issues_detected").alias("message"))
    return alerts.unionByName(status)

