"""Model queries (K1–K16) and score-labelling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import applications as A
from ..operators import metrics as K
from ..operators import ml as ML
from ..operators import sampling as D
from ..operators import scoring as S
from . import inputs as I
from ..session import ensure_checkpoint_dir
from .catalog import register

CARD_NUMERIC = ["limit_bal", "age"]
CARD_CATEGORICAL = ["sex", "marriage_new", "pay_new", "education_new"]


def _cards(spark, sf_dir):
    c = I.card_applications(spark, sf_dir)
    # Categorical codes as text, label column for Spark ML
    return c.withColumns({k: F.col(k).cast("string") for k in CARD_CATEGORICAL}).withColumn(
        "label", F.col("target").cast("double"))


def _split(spark, sf_dir):
    # the split feeds several iterative fits: cut its lineage once (written to the shared checkpoint folder)
    ensure_checkpoint_dir(spark)
    s = D.stratified_split(_cards(spark, sf_dir), ["app_id"], "label", 0.2, seed=42).checkpoint(eager=True)
    return s.where("split = 'train'"), s.where("split = 'test'")


@register("model_comparison_cards")
def model_comparison_cards(spark, sf_dir):
    """Logistic regression, random forest and boosted trees on
    the six card features (stratified 80/20 split), ranked by test ROC AUC."""
    train, test = _split(spark, sf_dir)
    models, errors = ML.train_models(train, CARD_NUMERIC, CARD_CATEGORICAL, "label", balanced=True)
    if errors:
        raise RuntimeError(f"models failed: {errors}")
    return ML.evaluate_models(models, test)


@register("cross_validation_cards")
def cross_validation_cards(spark, sf_dir):
    """K5: stratified 5-fold CV of logistic regression on the training split."""
    train, _ = _split(spark, sf_dir)
    folds = D.stratified_folds(train.drop("split"), ["app_id"], "label", k=5, seed=42)
    per_fold, summary = ML.cross_validate(folds, "logistic_regression", CARD_NUMERIC, CARD_CATEGORICAL)
    return summary


@register("grid_search_cards")
def grid_search_cards(spark, sf_dir):
    """C grid for logistic regression with 5 stratified folds; per-param importance."""
    train, _ = _split(spark, sf_dir)
    folds = D.stratified_folds(train.drop("split"), ["app_id"], "label", k=5, seed=42)
    best, results = ML.grid_search(folds, "logistic_regression", CARD_NUMERIC, CARD_CATEGORICAL,
                                   grid={"C": ML.LR_GRID_C})
    return ML.param_importance(results).join(
        results.agg(F.max("mean_auc").alias("best_mean_auc")), how="inner")


@register("feature_importance_cards")
def feature_importance_cards(spark, sf_dir):
    """Random-forest feature importances per source column."""
    train, _ = _split(spark, sf_dir)
    m = ML.build_pipeline("random_forest", CARD_NUMERIC, CARD_CATEGORICAL).fit(train)
    imp = ML.feature_importance(m, train) or {}
    return spark.createDataFrame(sorted(imp.items()), "feature string, importance double")


@register("model_scored_applications")
def model_scored_applications(spark, sf_dir):
    """L2 with a model: logistic regression on the engineered application
    features predicts P(default); labels, risk and amounts per confidence band."""
    from .profile_queries import labelled_applications
    apps, _ = S.split_applications(labelled_applications(spark, sf_dir))
    apps = A.fill_defaults(apps).withColumns(A.engineered_features()).withColumn("label", F.col("target").cast("double"))
    feats = ["fico_avg", "loan_to_income_ratio", "emp_length_numeric", "dti", "revol_util", "inq_last_6mths"]
    ensure_checkpoint_dir(spark)
    apps = D.stratified_split(apps, ["app_id"], "label", 0.2, seed=42).checkpoint(eager=True)
    train, test = apps.where("split = 'train'"), apps.where("split = 'test'")
    m = ML.build_pipeline("logistic_regression", feats, [], n=train.count()).fit(train)
    scored = ML.score(m, test, "lr", keep=["loan_amnt"]).withColumnRenamed("score", "p_default").drop("prediction")
    lab = A.label_default_probability(scored, "p_default")
    return lab.groupBy("prediction", "confidence").agg(F.count(F.lit(1)).alias("n"),
                                                       F.round(F.avg("risk_score"), 4).alias("avg_risk"))


# --------------------------------------------------------------------------- L2 / L3 given a score

@register("default_labels_applications", I.with_ctes(I.APPLICATIONS_SQL) + """
, p AS (SELECT loan_amnt, least(1.0, dti / 110) AS p FROM applications)
SELECT CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS prediction,
       CASE WHEN p >= 0.8 OR p <= 0.2 THEN 'high' WHEN p >= 0.6 OR p <= 0.4 THEN 'medium' ELSE 'low' END AS confidence,
       count(*) AS n, round(avg(p * 100), 6) AS avg_risk,
       round(sum(CASE WHEN p < 0.5 THEN CASE WHEN p > 0.7 THEN loan_amnt * 0.5 WHEN p > 0.5 THEN loan_amnt * 0.8
                 ELSE loan_amnt END END), 2) AS recommended_total
FROM p GROUP BY ALL""")
def default_labels_applications(spark, sf_dir):
    """L2 labelling given P(default) = min(1, dti/110): prediction, confidence, risk, amount."""
    apps = I.applications(spark, sf_dir).select("loan_amnt", F.least(F.lit(1.0), F.col("dti") / 110).alias("p_default"))
    lab = A.label_default_probability(apps, "p_default")
    return lab.groupBy("prediction", "confidence").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("risk_score"), 6).alias("avg_risk"),
        F.round(F.sum("recommended_amount"), 2).alias("recommended_total"))


@register("repay_labels_cards", I.with_ctes(I.CARD_APPLICATIONS_SQL) + """
, p AS (SELECT 1 - (age - 18) / 70.0 AS p FROM card_applications)
SELECT CASE WHEN p >= 0.8 THEN 'high' WHEN p >= 0.6 THEN 'medium' ELSE 'low' END AS confidence,
       count(*) AS n, round(avg((1 - p) * 100), 6) AS avg_risk FROM p GROUP BY 1""")
def repay_labels_cards(spark, sf_dir):
    """L3 labelling given P(repay) = 1 − (age − 18)/70 (confidence by P(repay), risk = (1 − p)·100)."""
    c = I.card_applications(spark, sf_dir).select((1 - (F.col("age") - 18) / 70.0).alias("p_repay"))
    lab = A.label_repay_probability(c, "p_repay")
    return lab.groupBy("confidence").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("risk_score"), 6).alias("avg_risk"))


@register("prediction_stats_log", I.with_ctes(I.PREDICTION_LOG_SQL) + """
SELECT count(*) AS total_predictions, round(avg(CASE WHEN prediction = 0 THEN 1.0 ELSE 0.0 END), 6) AS approval_rate,
       round(avg(processing_ms), 6) AS avg_processing_ms,
       count(*) FILTER (WHERE ts >= (SELECT max(ts) FROM prediction_log) - INTERVAL 24 HOUR) AS last_24h
FROM prediction_log""")
def prediction_stats_log(spark, sf_dir):
    """L4 over the prediction log."""
    return S.prediction_stats(I.prediction_log(spark, sf_dir))


FEEDBACK_SQL = """
feedback AS (
  SELECT event_id AS request_id, CAST(CASE WHEN event_id % 50 = 0 THEN 2 ELSE user_id % 2 END AS INTEGER) AS actual_outcome
  FROM events WHERE event_id % 3 = 0
)"""


def _feedback(spark, sf_dir):
    ev = I.table(spark, sf_dir, "events").where(F.col("event_id") % 3 == 0)
    return ev.select(F.col("event_id").alias("request_id"),
                     F.when(F.col("event_id") % 50 == 0, 2).otherwise(F.col("user_id") % 2).cast("int")
                     .alias("actual_outcome"))


@register("feedback_performance_log", I.with_ctes(I.PREDICTION_LOG_SQL, FEEDBACK_SQL) + """
, j AS (SELECT l.prediction, f.actual_outcome AS label FROM prediction_log l JOIN feedback f
        ON l.request_id = f.request_id WHERE f.actual_outcome IN (0, 1)),
c AS (SELECT count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
             count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp FROM j)
SELECT tn, fp, fn, tp, round((tp + tn) * 1.0 / (tp + tn + fp + fn), 6) AS accuracy,
       round(coalesce(tp * 1.0 / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp * 1.0 / nullif(tp + fn, 0), 0), 6) AS recall
FROM c""")
def feedback_performance_log(spark, sf_dir):
    """L6 + C4c: predictions labelled by valid feedback (inner join on request id), then confusion metrics."""
    j = S.feedback_performance(I.prediction_log(spark, sf_dir), _feedback(spark, sf_dir))
    j = j.withColumnRenamed("actual_outcome", "label")
    c = K.confusion_counts(j, (), "label", "prediction")
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    r = K._rates(tn, fp, fn, tp)
    return c.select("tn", "fp", "fn", "tp", F.round(r["accuracy"], 6).alias("accuracy"),
                    F.round(r["precision"], 6).alias("precision"), F.round(r["recall"], 6).alias("recall"))
