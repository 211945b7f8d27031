"""Applications scored by a saved model, in batch and on a stream (L2, L3, M6).

The way of an application: a model directory (``pick_model`` chooses it) is
loaded once; applications that fail a rule go to the quarantine with their
reasons; the others get defaults (E3) and engineered features (E11), are
aligned to the columns that the model was fitted on (B9, absent ones 0) and
pass through ``PipelineModel.transform``: one projection, no shuffle, the same
on a table and on a ``readStream``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import applications as A
from ..sources.files import pick_model
from .core import col
from .ml import feature_importance
from .scoring import validate_applications, validate_card_applications

#: columns of a card model, numbers and codes
CARD_NUMERIC = ["limit_bal", "age"]
CARD_CODES = ["sex", "marriage_new", "pay_new", "education_new"]


def load_picked(spark: SparkSession, directory: str) -> tuple[PipelineModel, str]:
    """The model that ``pick_model`` chooses in ``directory`` and its version, the folder's name."""
    path = pick_model(spark, directory)
    if path is None:
        raise FileNotFoundError(f"no model in {directory}")
    return PipelineModel.load(path), re.split("/", path.rstrip("/"))[-1]


def class_probability(label: int) -> Column:
    """P(class ``label``) of a transformed table; a model that was fitted on class 0
    alone knows no class 1, which then has probability 0."""
    return F.coalesce(F.get(vector_to_array("probability"), F.lit(label)), F.lit(0.0))


def importance_map(importance: dict[str, float] | None) -> Column:
    """Feature name → importance as a map column, null where the model has none."""
    if not importance:
        return F.lit(None).cast("map<string,double>")
    return F.create_map(*[x for k, v in importance.items() for x in (F.lit(k), F.lit(float(v)))])


def _transformed(rows: DataFrame, features: DataFrame, model: PipelineModel, outputs: dict[str, Column]) -> DataFrame:
    """``rows`` (a struct column ``_in`` in ``features``) plus the outputs of the model."""
    scored = model.transform(features).select("_in", *[c.alias(f"_out_{k}") for k, c in outputs.items()])
    return scored.select(*[F.col("_in")[c].alias(c) for c in rows.columns], *[F.col(f"_out_{k}").alias(k) for k in outputs])


def model_features(apps: DataFrame, expected: Sequence[str] = A.MODEL_COLUMNS) -> DataFrame:
    """E3 → E11 → B9: the expected columns in order, absent ones 0."""
    return A.align_columns(A.fill_defaults(apps).withColumns(A.engineered_features()), list(expected))


def score_applications(apps: DataFrame, model: PipelineModel, version: str = "", threshold: float = 0.5,
                       expected: Sequence[str] = A.MODEL_COLUMNS) -> DataFrame:
    """L2: valid applications (``split_applications``) plus p_default, prediction,
    confidence, risk_score, recommended_amount, model_version, features_importance."""
    filled = A.fill_defaults(apps).withColumns(A.engineered_features())
    whole = filled.withColumn("_in", F.struct(*[col(c) for c in apps.columns]))
    features = A.align_columns(whole, ["_in", *expected])
    out = _transformed(apps, features, model, {"p_default": class_probability(1)})
    importance = importance_map(feature_importance(model, features))
    return A.label_default_probability(out, "p_default", threshold).withColumns(
        {"model_version": F.lit(version), "features_importance": importance})


def split_cards(cards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid card applications, and the rejected with their first failed rule."""
    v = validate_card_applications(cards)
    return v.where("rejection IS NULL").drop("rejection"), v.where("rejection IS NOT NULL")


def score_card_applications(cards: DataFrame, model: PipelineModel, version: str = "") -> DataFrame:
    """L3: valid card applications plus prediction (the model's class), p_repay =
    P(class 0), risk_score, confidence, model_version and the fixed importance map."""
    codes = {c: col(c).cast("string") for c in CARD_CODES}
    features = cards.select(F.struct(*[col(c) for c in cards.columns]).alias("_in"), *[col(c) for c in CARD_NUMERIC], *[x.alias(c) for c, x in codes.items()])
    out = _transformed(cards, features, model, {"p_repay": class_probability(0), "prediction": F.col("prediction").cast("int")})
    return A.label_repay_probability(out, "p_repay").withColumns(
        {"model_version": F.lit(version), "features_importance": importance_map(A.CARD_IMPORTANCE)})


def scored_and_quarantined(apps: DataFrame, model: PipelineModel, version: str = "", threshold: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Scored valid applications, and the others with their reasons; table or stream."""
    v = validate_applications(apps)
    return score_applications(v.where("is_valid").drop("reasons", "is_valid"), model, version, threshold), v.where(~F.col("is_valid")).drop("is_valid")
