"""Queries that score applications with a saved model, batch and stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import applications as A
from ..operators import ml as ML
from ..operators import model_scoring as MS
from ..operators import sampling as D
from ..operators import scoring as S
from ..session import ensure_checkpoint_dir
from ..sources.files import save_models
from ..streaming import monitors as M
from . import inputs as I
from .catalog import register
from .profile_queries import labelled_applications
from .scoring_queries import FLAGSHIP_SQL

CHECKED_SQL = FLAGSHIP_SQL[:FLAGSHIP_SQL.index("filled AS (")].rstrip().rstrip(",")


def _model_folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/models-{uuid.uuid4().hex[:12]}"


def saved_application_models(spark, sf_dir) -> str:
    """Fit the forest on 80 % of the labelled valid applications (nine columns) and
    save it beside the logistic model; the folder of both."""
    apps, _ = S.split_applications(labelled_applications(spark, sf_dir).where("target IS NOT NULL"))
    split = D.stratified_split(apps, ["app_id"], "target", 0.2, seed=42).where("split = 'train'")
    train = MS.model_features(split, [*A.MODEL_COLUMNS, "target"]).withColumn("label", F.col("target").cast("double")).checkpoint()
    models, errors = ML.train_models(train, A.MODEL_COLUMNS, kinds=("logistic_regression", "random_forest"))
    if errors:
        raise RuntimeError(f"models failed: {errors}")
    folder = _model_folder(spark)
    save_models({"best tuned forest": models["random_forest"], "logistic regression": models["logistic_regression"]}, folder)
    return folder


def _summary(scored):
    """Rows, mean risk and amounts of each verdict, rounded; the importances' sum is 1."""
    return scored.groupBy("prediction", "confidence", "model_version").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("risk_score"), 4).alias("avg_risk"),
        F.round(F.sum("recommended_amount"), 2).alias("recommended_total"),
        F.round(F.avg(F.aggregate(F.map_values("features_importance"), F.lit(0.0), lambda a, x: a + x)), 6).alias("importance_total"))


@register("saved_model_applications")
def saved_model_applications(spark, sf_dir):
    """L2 end to end: fitted, saved, picked, loaded; every valid application scored."""
    model, version = MS.load_picked(spark, saved_application_models(spark, sf_dir))
    scored, _ = MS.scored_and_quarantined(I.applications(spark, sf_dir), model, version)
    return _summary(scored)


@register("saved_model_stream")
def saved_model_stream(spark, sf_dir):
    """L2 on the application stream with the same model: equal to the batch rows."""
    model, version = MS.load_picked(spark, saved_application_models(spark, sf_dir))
    scored, _ = M.scored_streams(M.application_stream(spark, sf_dir), spark, lambda s: MS.scored_and_quarantined(s, model, version))
    return _summary(scored)


@register("saved_model_counts", CHECKED_SQL + """
SELECT len(reasons) = 0 AS scored, count(*) AS n, round(sum(loan_amnt), 2) AS loan_total,
       count(CASE WHEN len(reasons) = 0 THEN 1 END) AS with_probability FROM checked GROUP BY 1""")
def saved_model_counts(spark, sf_dir):
    """L2: what the model scored and what went to the quarantine, by number and amount."""
    model, version = MS.load_picked(spark, saved_application_models(spark, sf_dir))
    scored, quarantined = MS.scored_and_quarantined(I.applications(spark, sf_dir), model, version)
    both = scored.select(F.lit(True).alias("scored"), "loan_amnt", "p_default").unionByName(
        quarantined.select(F.lit(False).alias("scored"), "loan_amnt", F.lit(None).cast("double").alias("p_default")))
    return both.groupBy("scored").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("loan_amnt"), 2).alias("loan_total"),
                                      F.count_if(F.col("p_default").between(0, 1)).alias("with_probability"))


@register("quarantine_stream", CHECKED_SQL + """
SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM checked) GROUP BY reason""")
def quarantine_stream(spark, sf_dir):
    """M6: applications that the stream puts into quarantine, by reason."""
    _, quarantined = M.scored_streams(M.application_stream(spark, sf_dir), spark, M.score_stream)
    return quarantined.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@register("scorecard_stream", FLAGSHIP_SQL[:FLAGSHIP_SQL.rindex("SELECT segment,")] + """
SELECT CAST(CASE WHEN score >= 50 THEN 0 ELSE 1 END AS INTEGER) AS prediction, count(*) AS n, CAST(sum(score) AS BIGINT) AS points, CAST(1 AS DOUBLE) AS importance_total
FROM scored WHERE is_valid GROUP BY 1""")
def scorecard_stream(spark, sf_dir):
    """L1 on the application stream: rows and points of each verdict."""
    scored, _ = M.scored_streams(M.application_stream(spark, sf_dir), spark, M.score_stream)
    total = F.aggregate(F.map_values("features_importance"), F.lit(0.0), lambda a, x: a + x)
    return scored.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("points"), F.round(F.avg(total), 6).alias("importance_total"))


@register("saved_model_cards")
def saved_model_cards(spark, sf_dir):
    """L3 end to end: boosted trees on the six card features, saved, picked and loaded."""
    cards, _ = MS.split_cards(I.card_applications(spark, sf_dir))
    train = cards.withColumns({c: F.col(c).cast("string") for c in MS.CARD_CODES}).withColumn("label", F.col("target").cast("double"))
    train = D.stratified_split(train, ["app_id"], "label", 0.2, seed=42).where("split = 'train'").checkpoint()
    folder = _model_folder(spark)
    models, errors = ML.train_models(train, MS.CARD_NUMERIC, MS.CARD_CODES, kinds=("gradient_boosting",))
    if errors:
        raise RuntimeError(f"models failed: {errors}")
    save_models(models, folder)
    scored = MS.score_card_applications(cards, *MS.load_picked(spark, folder))
    return scored.groupBy("prediction", "confidence", "model_version").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("risk_score"), 4).alias("avg_risk"))


@register("tuning_runs_cards")
def tuning_runs_cards(spark, sf_dir):
    """The regression's grid on two folds through the run table, searched
    twice: the second search finds every run and adds none."""
    cards, _ = MS.split_cards(I.card_applications(spark, sf_dir))
    rows = cards.withColumns({c: F.col(c).cast("string") for c in MS.CARD_CODES}).withColumn("label", F.col("target").cast("double"))
    folds = D.stratified_folds(rows, ["app_id"], "label", k=ML.TUNING_FOLDS, seed=42).checkpoint()
    path = f"{_model_folder(spark)}-runs"
    for _ in range(2):
        results = ML.tune(folds, "logistic_regression", MS.CARD_NUMERIC, path, MS.CARD_CODES)
    return results.select("point", "folds", F.round("mean_auc", 6).alias("mean_auc"), "rank").withColumn("runs", F.lit(spark.read.parquet(path).count()))
