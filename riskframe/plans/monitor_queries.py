"""Queries for metrics, drift, performance and fairness."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import metrics as K
from ..operators import monitor as J
from ..session import ensure_checkpoint_dir
from ..streaming import drift as W
from ..streaming import monitors as M
from . import inputs as I
from .catalog import register


def _r(c, d=6):
    return F.round(c, d).alias(c)


# scored lines: two "models" over the same labelled lines --------------------

def scored_lines(spark, sf_dir):
    lt = I.loan_table(spark, sf_dir)
    a = lt.select(F.lit("discount_tax").alias("model"), F.col("target").alias("label"),
                  (F.col("l_discount") * 5 + F.col("l_tax")).alias("score"))
    b = lt.select(F.lit("quantity").alias("model"), F.col("target").alias("label"),
                  (F.col("l_quantity") / 50).alias("score"))
    return a.unionByName(b).withColumn("prediction", (F.col("score") >= 0.3).cast("int"))


SCORED_SQL = """
scored AS (
  SELECT model, label, score, CAST(score >= 0.3 AS INTEGER) AS prediction FROM (
    SELECT 'discount_tax' AS model, target AS label, l_discount * 5 + l_tax AS score FROM loan_table
    UNION ALL
    SELECT 'quantity' AS model, target AS label, l_quantity / 50 AS score FROM loan_table)
),
counts AS (
  SELECT model, score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
  FROM scored GROUP BY model, score
),
asc_cum AS (
  SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY score ROWS UNBOUNDED PRECEDING) AS cum_neg FROM counts
),
desc_cum AS (
  SELECT *, sum(pos) OVER (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_pos,
            sum(neg) OVER (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_neg,
            sum(pos) OVER (PARTITION BY model) AS P, sum(neg) OVER (PARTITION BY model) AS N
  FROM counts
),
auc AS (
  SELECT model, sum(pos * (cum_neg - neg + neg / 2.0)) / (sum(pos) * 1.0 * sum(neg)) AS roc_auc FROM asc_cum GROUP BY model
),
conf AS (
  SELECT model, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
         count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
         count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp
  FROM scored GROUP BY model
),
rates AS (
  SELECT *, coalesce(tp * 1.0 / nullif(tp + fp, 0), 0) AS precision, coalesce(tp * 1.0 / nullif(tp + fn, 0), 0) AS recall,
         coalesce((tp + tn) * 1.0 / nullif(tp + tn + fp + fn, 0), 0) AS accuracy, tn + fp + fn + tp AS n
  FROM conf
)"""


@register("binary_metrics_models", I.with_ctes(I.LOAN_TABLE_SQL, SCORED_SQL) + """
SELECT r.model, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0), 6) AS f1, n,
       round(roc_auc, 6) AS roc_auc
FROM rates r JOIN auc a ON r.model = a.model""")
def binary_metrics_models(spark, sf_dir):
    """K7 per model (accuracy, precision, recall, f1, tie-averaged roc_auc)."""
    m = K.binary_metrics(scored_lines(spark, sf_dir), ["model"])
    return m.select("model", *[_r(c) for c in ("accuracy", "precision", "recall", "f1")], "n", _r("roc_auc"))


@register("confusion_models", I.with_ctes(I.LOAN_TABLE_SQL, SCORED_SQL) + """
SELECT model, tn, fp, fn, tp,
       round(coalesce(tn * 1.0 / nullif(tn + fp, 0), 0), 6) AS specificity,
       round(coalesce(tp * 1.0 / nullif(tp + fn, 0), 0), 6) AS sensitivity,
       round(coalesce(fp * 1.0 / nullif(fp + tn, 0), 0), 6) AS fpr,
       round(coalesce(fn * 1.0 / nullif(fn + tp, 0), 0), 6) AS fnr
FROM conf""")
def confusion_models(spark, sf_dir):
    c = K.confusion(scored_lines(spark, sf_dir), ["model"])
    return c.select("model", "tn", "fp", "fn", "tp",
                    *[_r(x) for x in ("specificity", "sensitivity", "fpr", "fnr")])


@register("roc_curve_models", I.with_ctes(I.LOAN_TABLE_SQL, SCORED_SQL) + """
SELECT model, round(score, 6) AS threshold, round(cum_neg * 1.0 / N, 6) AS fpr, round(cum_pos * 1.0 / P, 6) AS tpr FROM desc_cum
UNION ALL
SELECT DISTINCT model, CAST(NULL AS DOUBLE), 0.0, 0.0 FROM counts""")
def roc_curve_models(spark, sf_dir):
    r = K.roc_curve(scored_lines(spark, sf_dir), ["model"])
    return r.select("model", _r("threshold"), _r("fpr"), _r("tpr"))


@register("pr_curve_models", I.with_ctes(I.LOAN_TABLE_SQL, SCORED_SQL) + """
SELECT model, round(score, 6) AS threshold, round(cum_pos * 1.0 / (cum_pos + cum_neg), 6) AS precision,
       round(cum_pos * 1.0 / P, 6) AS recall FROM desc_cum
UNION ALL
SELECT DISTINCT model, CAST(NULL AS DOUBLE), 1.0, 0.0 FROM counts""")
def pr_curve_models(spark, sf_dir):
    r = K.pr_curve(scored_lines(spark, sf_dir), ["model"])
    return r.select("model", _r("threshold"), _r("precision"), _r("recall"))


@register("average_precision_models", I.with_ctes(I.LOAN_TABLE_SQL, SCORED_SQL) + """
SELECT model, round(sum(pos * cum_pos * 1.0 / (cum_pos + cum_neg)) / sum(pos), 6) AS average_precision
FROM desc_cum GROUP BY model""")
def average_precision_models(spark, sf_dir):
    a = K.average_precision(scored_lines(spark, sf_dir), ["model"])
    return a.select("model", _r("average_precision"))


@register("log_loss_models", I.with_ctes(I.LOAN_TABLE_SQL, SCORED_SQL) + """
SELECT model, round(avg(CASE WHEN label = 1 THEN -ln(least(greatest(score, 1e-15), 1 - 1e-15))
                         ELSE -ln(1 - least(greatest(score, 1e-15), 1 - 1e-15)) END), 6) AS log_loss
FROM scored GROUP BY model""")
def log_loss_models(spark, sf_dir):
    return K.log_loss(scored_lines(spark, sf_dir), ["model"]).select("model", _r("log_loss"))


@register("model_comparison", I.with_ctes(I.LOAN_TABLE_SQL, SCORED_SQL) + """
SELECT r.model, round(roc_auc, 6) AS roc_auc, round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0), 6) AS f1,
       CAST(row_number() OVER (ORDER BY roc_auc DESC, r.model) AS INTEGER) AS rank
FROM rates r JOIN auc a ON r.model = a.model""")
def model_comparison(spark, sf_dir):
    """Models ranked by ROC AUC."""
    m = K.model_comparison(scored_lines(spark, sf_dir), "model")
    return m.select("model", _r("roc_auc"), _r("f1"), F.col("rank").cast("int").alias("rank"))


# drift: reference = finished lines, current = open lines ---------------------

DRIFT_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "tax_gap"]


def _drift(spark, sf_dir):
    lt = I.loan_table(spark, sf_dir)
    ref = lt.where(F.col("l_linestatus") == "F").select(*DRIFT_FEATURES)
    cur = lt.where(F.col("l_linestatus") == "O").select(*DRIFT_FEATURES)
    return J.ks_drift(ref, cur, DRIFT_FEATURES)


KS_SQL = """
vals AS (""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, l_linestatus = 'F' AS is_ref FROM loan_table WHERE {c} IS NOT NULL"
    for c in DRIFT_FEATURES) + """),
cnt AS (SELECT feature, value, count(*) FILTER (WHERE is_ref) AS n_ref, count(*) FILTER (WHERE NOT is_ref) AS n_cur
        FROM vals GROUP BY feature, value),
cdf AS (SELECT feature, sum(n_ref) OVER w * 1.0 / sum(n_ref) OVER (PARTITION BY feature) AS f_ref,
               sum(n_cur) OVER w * 1.0 / sum(n_cur) OVER (PARTITION BY feature) AS f_cur,
               sum(n_ref) OVER (PARTITION BY feature) AS N_ref, sum(n_cur) OVER (PARTITION BY feature) AS N_cur
        FROM cnt WINDOW w AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING)),
ks AS (SELECT feature, max(abs(f_ref - f_cur)) AS d, any_value(N_ref) AS n1, any_value(N_cur) AS n2 FROM cdf GROUP BY feature),
lam AS (SELECT *, (sqrt(n1 * n2 / (n1 + n2)) + 0.12 + 0.11 / sqrt(n1 * n2 / (n1 + n2))) * d AS lam FROM ks),
pv AS (SELECT feature, CASE WHEN lam < 1e-3 THEN 1.0 ELSE least(1.0, greatest(0.0,
          (SELECT sum(2.0 * (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * k * k * lam * lam)) FROM range(1, 101) t(k)))) END AS p
       FROM lam),
mom AS (SELECT feature, avg(value) FILTER (WHERE is_ref) AS reference_mean, avg(value) FILTER (WHERE NOT is_ref) AS current_mean,
               stddev_samp(value) FILTER (WHERE is_ref) AS reference_std, stddev_samp(value) FILTER (WHERE NOT is_ref) AS current_std
        FROM vals GROUP BY feature)"""


@register("ks_drift_lines", I.with_ctes(I.LOAN_TABLE_SQL, KS_SQL) + """
SELECT ks.feature, round(d, 6) AS ks_statistic, round(p, 6) AS p_value, p < 0.1 AS drift_detected,
       round(reference_mean, 6) AS reference_mean, round(current_mean, 6) AS current_mean,
       round(reference_std, 6) AS reference_std, round(current_std, 6) AS current_std,
       CAST(n1 AS BIGINT) AS reference_n, CAST(n2 AS BIGINT) AS current_n
FROM ks JOIN pv ON ks.feature = pv.feature JOIN mom ON ks.feature = mom.feature""")
def ks_drift_lines(spark, sf_dir):
    """Two-sample KS of finished vs open lines per feature."""
    d = _drift(spark, sf_dir)
    return d.select("feature", *[_r(c) for c in ("ks_statistic", "p_value")], "drift_detected",
                    *[_r(c) for c in ("reference_mean", "current_mean", "reference_std", "current_std")],
                    "reference_n", "current_n")


@register("drift_score_lines", I.with_ctes(I.LOAN_TABLE_SQL, KS_SQL) + """
SELECT round(avg(d), 6) AS drift_score, coalesce(avg(d) > 0.1, false) AS overall_drift,
       count(*) FILTER (WHERE p < 0.1) AS drifted_features
FROM ks JOIN pv ON ks.feature = pv.feature""")
def drift_score_lines(spark, sf_dir):
    s = J.drift_score(_drift(spark, sf_dir))
    return s.select(_r("drift_score"), "overall_drift", "drifted_features")


# fairness over card applications ----------------------------------------------

BIAS_ATTRS = ["sex", "education_new", "marriage_new"]


def _card_predictions(spark, sf_dir):
    c = I.card_applications(spark, sf_dir)
    return c.select(F.col("target").alias("label"),
                    F.when(F.col("pay_new") == 1, 1).otherwise(0).alias("prediction"), *BIAS_ATTRS)


BIAS_SQL = """
preds AS (SELECT target AS label, CASE WHEN pay_new = 1 THEN 1 ELSE 0 END AS prediction, sex, education_new, marriage_new
          FROM card_applications),
g AS (""" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS attribute, CAST({a} AS VARCHAR) AS grp, label, prediction FROM preds WHERE {a} IS NOT NULL"
    for a in BIAS_ATTRS) + """),
gc AS (SELECT attribute, grp, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
              count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
              count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
              count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp
       FROM g GROUP BY attribute, grp),
gm AS (SELECT attribute, grp, (tp + tn) * 1.0 / (tp + tn + fp + fn) AS accuracy,
              coalesce(tp * 1.0 / nullif(tp + fp, 0), 0) AS precision, coalesce(tp * 1.0 / nullif(tp + fn, 0), 0) AS recall,
              tp + tn + fp + fn AS size, count(*) OVER (PARTITION BY attribute) AS ngroups
       FROM gc)"""


@register("group_bias_cards", I.with_ctes(I.CARD_APPLICATIONS_SQL, BIAS_SQL) + """
SELECT attribute, grp AS "group", round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0), 6) AS f1, size
FROM gm WHERE ngroups > 1""")
def group_bias_cards(spark, sf_dir):
    """J4 per (attribute, group)."""
    g = J.group_bias(_card_predictions(spark, sf_dir), BIAS_ATTRS)
    return g.select("attribute", "group", *[_r(c) for c in ("accuracy", "precision", "recall", "f1")], "size")


@register("bias_summary_cards", I.with_ctes(I.CARD_APPLICATIONS_SQL, BIAS_SQL) + """
SELECT attribute, round(max(accuracy) - min(accuracy), 6) AS max_accuracy_difference, count(*) AS groups,
       max(accuracy) - min(accuracy) > 0.1 AS bias_detected
FROM gm WHERE ngroups > 1 GROUP BY attribute""")
def bias_summary_cards(spark, sf_dir):
    s = J.bias_summary(J.group_bias(_card_predictions(spark, sf_dir), BIAS_ATTRS))
    return s.select("attribute", _r("max_accuracy_difference"), "groups", "bias_detected")


@register("monitoring_report", I.with_ctes(I.LOAN_TABLE_SQL, KS_SQL, SCORED_SQL).rstrip() + ",\n" +
          I.CARD_APPLICATIONS_SQL.strip() + ",\n" + BIAS_SQL.strip() + """,
alerts AS (
  SELECT 'data_drift' AS type, 'high' AS severity, 'data drift detected' AS message FROM ks HAVING avg(d) > 0.1
  UNION ALL
  SELECT 'performance_degradation', 'high', 'performance degradation detected' FROM rates
  WHERE coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) < 0.7 AND model = 'discount_tax'
  UNION ALL
  SELECT DISTINCT 'prediction_bias', 'medium', 'prediction bias detected' FROM
    (SELECT attribute FROM gm WHERE ngroups > 1 GROUP BY attribute HAVING max(accuracy) - min(accuracy) > 0.1)
)
SELECT * FROM alerts
UNION ALL
SELECT 'overall_status', 'info', CASE WHEN count(*) = 0 THEN 'healthy' ELSE 'issues_detected' END FROM alerts""")
def monitoring_report(spark, sf_dir):
    """Alerts from drift (lines), performance (discount_tax model) and bias (cards)."""
    drift = J.drift_score(_drift(spark, sf_dir))
    perf = K.performance(scored_lines(spark, sf_dir).where(F.col("model") == "discount_tax"))
    bias = J.bias_summary(J.group_bias(_card_predictions(spark, sf_dir), BIAS_ATTRS))
    return J.monitoring_report(drift, perf, bias)


# drift over the trailing days of the event stream ------------------------------

STREAM_FEATURES = ["value", "user_id"]
REFERENCE_DAYS = 14

WINDOW_SQL = """WITH bounds AS (SELECT CAST(min(ts) AS DATE) AS first, CAST(max(ts) AS DATE) AS last FROM events),
vals AS (""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, true AS is_ref FROM events, bounds WHERE {c} IS NOT NULL AND CAST(ts AS DATE) < first + {REFERENCE_DAYS} "
    f"UNION ALL SELECT '{c}', CAST({c} AS DOUBLE), false FROM events, bounds WHERE {c} IS NOT NULL AND CAST(ts AS DATE) > last - 7"
    for c in STREAM_FEATURES) + """),
""" + KS_SQL[KS_SQL.index("cnt AS"):]


@register("windowed_drift_stream", WINDOW_SQL + """
SELECT ks.feature, round(d, 6) AS ks_statistic, round(p, 6) AS p_value, p < 0.1 AS drift_detected,
       round(reference_mean, 6) AS reference_mean, round(current_mean, 6) AS current_mean,
       round(reference_std, 6) AS reference_std, round(current_std, 6) AS current_std,
       CAST(n1 AS BIGINT) AS reference_n, CAST(n2 AS BIGINT) AS current_n
FROM ks JOIN pv ON ks.feature = pv.feature JOIN mom ON ks.feature = mom.feature WHERE n2 >= 100""")
def windowed_drift_stream(spark, sf_dir):
    """M7: the last seven days of the event stream against the first fourteen."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/drift-{uuid.uuid4().hex[:12]}"
    W.keep_counts(M.read_table_stream(spark, sf_dir, "events"), path, STREAM_FEATURES)
    counts = W.kept_counts(spark, path)
    first = counts.select(F.min("day")).scalar()
    reference = counts.where(F.col("day") < F.date_add(first, REFERENCE_DAYS)).groupBy("column", "value").agg(F.sum("n").alias("n"))
    d = W.trailing_drift(counts, reference)
    return d.select("feature", *[_r(c) for c in ("ks_statistic", "p_value")], "drift_detected",
                    *[_r(c) for c in ("reference_mean", "current_mean", "reference_std", "current_std")], "reference_n", "current_n")
