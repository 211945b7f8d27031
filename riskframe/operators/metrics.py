"""Binary-classification metrics over scored tables.

Input is a long table ``(… by, label, score[, prediction])``; every metric
is computed for all groups (models, folds, attribute values) at once.
Rank-based metrics (AUC, ROC/PR curves, average precision) first compress
to one row per (group, distinct score) and then use the distributed
``running_totals`` — ties are handled exactly (tie-averaged AUC, one
curve point per distinct score) and no window ever sees a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .core import col, keyed_join, running_totals

EPS = 1e-15


def _zdiv(a: Column, b: Column) -> Column:
    """a / b, 0 on a zero denominator (sklearn's zero_division=0)."""
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def confusion_counts(df: DataFrame, by: Sequence[str] = (), label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    y, p = col(label), col(prediction)
    return df.groupBy(*by).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"))


def _rates(tn, fp, fn, tp) -> dict[str, Column]:
    precision = _zdiv(tp, tp + fp)
    recall = _zdiv(tp, tp + fn)
    return {
        "accuracy": _zdiv(tp + tn, tp + tn + fp + fn),
        "precision": precision,
        "recall": recall,
        "f1": _zdiv(2 * precision * recall, precision + recall),
    }


def confusion(df: DataFrame, by: Sequence[str] = (), label: str = "label",
              prediction: str = "prediction") -> DataFrame:
    """K8: tn, fp, fn, tp, specificity, sensitivity, fpr, fnr (0 on zero denominators)."""
    c = confusion_counts(df, by, label, prediction)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    return c.select(*by, "tn", "fp", "fn", "tp",
                    _zdiv(tn, tn + fp).alias("specificity"), _zdiv(tp, tp + fn).alias("sensitivity"),
                    _zdiv(fp, fp + tn).alias("fpr"), _zdiv(fn, fn + tp).alias("fnr"))


def score_counts(df: DataFrame, by: Sequence[str] = (), label: str = "label",
                 score: str = "score") -> DataFrame:
    """One row per (group, distinct score): positives and negatives."""
    y = col(label)
    return df.where(col(score).isNotNull()).groupBy(*by, col(score).alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))


def roc_auc(df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score") -> DataFrame:
    """Tie-averaged ROC AUC per group: Σ pos·(neg below + neg tied/2) / (P·N)."""
    sc = score_counts(df, by, label, score)
    cum = running_totals(sc, by, "score", ["neg"])
    return cum.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / 2.0)),
                     F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"))


def binary_metrics(df: DataFrame, by: Sequence[str] = (), label: str = "label",
                   prediction: str = "prediction", score: str = "score") -> DataFrame:
    """K7: accuracy, precision, recall, f1 (0 on zero division) and roc_auc per group."""
    c = confusion_counts(df, by, label, prediction)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    r = _rates(tn, fp, fn, tp)
    m = c.select(*by, *[v.alias(k) for k, v in r.items()], (tn + fp + fn + tp).alias("n"))
    auc = roc_auc(df, by, label, score)
    return keyed_join(m, auc, list(by), "left") if by else m.join(auc, how="inner")


def performance(df: DataFrame, label: str = "label", prediction: str = "prediction",
                score: str = "score", f1_floor: float = 0.7) -> DataFrame:
    """Binary metrics plus ``degraded`` = f1 below the floor."""
    return binary_metrics(df, (), label, prediction, score).withColumn("degraded", F.col("f1") < f1_floor)


def roc_curve(df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score") -> DataFrame:
    """K9: (threshold, fpr, tpr) per distinct score, descending, with a (0, 0) start row
    (threshold null)."""
    sc = score_counts(df, by, label, score)
    cum = running_totals(sc, by, "score", ["pos", "neg"], descending=True)
    tot = sc.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    j = keyed_join(cum, tot, list(by)) if by else cum.join(tot, how="inner")
    pts = j.select(*by, F.col("score").alias("threshold"), _zdiv(F.col("cum_neg"), F.col("N")).alias("fpr"),
                   _zdiv(F.col("cum_pos"), F.col("P")).alias("tpr"))
    start = tot.select(*by, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"),
                       F.lit(0.0).alias("tpr"))
    return pts.unionByName(start)


def pr_curve(df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, precision, recall) per distinct score plus the (1, 0) end point."""
    sc = score_counts(df, by, label, score)
    cum = running_totals(sc, by, "score", ["pos", "neg"], descending=True)
    tot = sc.groupBy(*by).agg(F.sum("pos").alias("P"))
    j = keyed_join(cum, tot, list(by)) if by else cum.join(tot, how="inner")
    pts = j.select(*by, F.col("score").alias("threshold"),
                   _zdiv(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
                   _zdiv(F.col("cum_pos"), F.col("P")).alias("recall"))
    end = tot.select(*by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                     F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def average_precision(df: DataFrame, by: Sequence[str] = (), label: str = "label",
                      score: str = "score") -> DataFrame:
    """Σ (R_n − R_{n−1})·P_n over distinct thresholds (step rule, not trapezoid)."""
    sc = score_counts(df, by, label, score)
    cum = running_totals(sc, by, "score", ["pos", "neg"], descending=True)
    prec = _zdiv(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))
    return cum.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("pos") * prec), F.sum("pos").cast("double")).alias("average_precision"))


def log_loss(df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score",
             eps: float = EPS) -> DataFrame:
    """Mean −ln p(label) with p clipped to [eps, 1−eps]."""
    p = F.least(F.greatest(col(score), F.lit(eps)), F.lit(1 - eps))
    ll = F.when(col(label) == 1, -F.log(p)).otherwise(-F.log(1 - p))
    return df.groupBy(*by).agg(F.avg(ll).alias("log_loss"))


def model_comparison(df: DataFrame, model: str = "model", label: str = "label",
                     prediction: str = "prediction", score: str = "score") -> DataFrame:
    """One row per model with all metrics, best ROC AUC first, ``rank`` 1 = best."""
    m = binary_metrics(df, [model], label, prediction, score)
    from pyspark.sql import Window
    # one row per model: a window over the models only
    w = Window.orderBy(F.desc("roc_auc"), model)
    return m.withColumn("rank", F.row_number().over(w))


def best_model(comparison: DataFrame, model: str = "model", metric: str = "roc_auc") -> DataFrame:
    return comparison.agg(F.max_by(col(model), col(metric)).alias("best_model"),
                          F.max(col(metric)).alias(f"best_{metric}"))


def recommendations(metrics: DataFrame) -> DataFrame:
    """Advice for a model from its recall, precision and AUC."""
    notes = F.array_compact(F.array(
        F.when(F.col("recall") < 0.5, F.lit("low recall: lower the threshold or rebalance classes")),
        F.when(F.col("precision") < 0.4, F.lit("low precision: many false alarms")),
        F.when(F.col("roc_auc") > 0.7, F.lit("good ranking quality (roc_auc > 0.7)"))))
    return metrics.withColumn("recommendations", notes)
