"""Applications scored by a saved model: batch, stream, odd training tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.functions import applications as A
from riskframe.operators import ml as ML
from riskframe.operators import model_scoring as MS
from riskframe.operators import scoring as S
from riskframe.plans import inputs as I
from riskframe.plans.profile_queries import labelled_applications
from riskframe.sources.files import save_models
from riskframe.streaming import monitors as M

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    apps, _ = S.split_applications(labelled_applications(spark, SF).where("target IS NOT NULL"))
    train = MS.model_features(apps.where("app_id % 7 <> 3"), [*A.MODEL_COLUMNS, "target"]).withColumn("label", F.col("target").cast("double"))
    models, errors = ML.train_models(train, A.MODEL_COLUMNS, kinds=("logistic_regression", "random_forest"))
    assert not errors
    path = str(tmp_path_factory.mktemp("models"))
    save_models({"Best Tuned": models["logistic_regression"], "random forest": models["random_forest"], "scaler": models["random_forest"]}, path)
    return path


def labels(p, amount):
    near = max(p, 1 - p)
    return int(p >= 0.5), "high" if near >= 0.8 else "medium" if near >= 0.6 else "low", None if p >= 0.5 else amount


def test_held_out_rows_are_scored_as_the_coefficients_say(spark, folder):
    """P(default) from the saved coefficients by hand; labels, risk and amount from it."""
    model, version = MS.load_picked(spark, folder)
    assert version == "best_tuned"
    held_out = I.applications(spark, SF).where("app_id % 7 = 3")
    scored, quarantined = MS.scored_and_quarantined(held_out, model, version)
    assert scored.columns == [*held_out.columns, "p_default", "prediction", "confidence", "risk_score", "recommended_amount", "model_version", "features_importance"]
    rows = scored.collect()
    assert len(rows) + quarantined.count() == held_out.count() and len(rows) > 20
    scale, regression = model.stages[-2], model.stages[-1]
    fill = A.APPLICATION_DEFAULTS
    for r in rows:
        x = np.array([float(r[c] if r[c] is not None else fill[c]) for c in A.MODEL_COLUMNS])
        z = (x - scale.mean.toArray()) / np.where(scale.std.toArray() > 0, scale.std.toArray(), 1)
        p = 1 / (1 + np.exp(-(z @ regression.coefficients.toArray() + regression.intercept)))
        assert abs(r["p_default"] - p) < 1e-9 and abs(r["risk_score"] - 100 * p) < 1e-7
        assert (r["prediction"], r["confidence"], r["recommended_amount"]) == labels(r["p_default"], r["loan_amnt"])
        assert r["features_importance"] is None and r["model_version"] == "best_tuned"
    assert all(r["reasons"] for r in quarantined.collect())


def test_stream_gives_the_batch_rows(spark, folder):
    model, _ = MS.load_picked(spark, folder)
    both = MS.scored_and_quarantined(I.applications(spark, SF), model, "v")
    streamed = M.scored_streams(M.application_stream(spark, SF), spark, lambda s: MS.scored_and_quarantined(s, model, "v"))
    for batch, stream in zip(both, streamed):
        assert batch.columns == stream.columns and stream.count() > 0
        plain = lambda df: sorted(map(repr, df.withColumns({c: F.to_json(c) for c, t in df.dtypes if t.startswith("map")}).collect()))
        assert plain(batch) == plain(stream)


def test_forest_names_its_columns(spark, folder):
    from pyspark.ml import PipelineModel
    model = PipelineModel.load(f"{folder}/random_forest")
    scored, _ = MS.scored_and_quarantined(I.applications(spark, SF), model)
    weights = scored.select("features_importance").first()[0]
    assert set(weights) == set(A.MODEL_COLUMNS) and abs(sum(weights.values()) - 1) < 1e-9


def test_absent_columns_are_zero_and_order_does_not_matter(spark, folder):
    model, _ = MS.load_picked(spark, folder)
    apps, _ = S.split_applications(I.applications(spark, SF))
    without = MS.score_applications(apps.drop("pub_rec"), model)
    zero = MS.score_applications(apps.withColumn("pub_rec", F.lit(0)).select(*reversed(apps.columns)), model)
    get = lambda df: {r["app_id"]: r["p_default"] for r in df.select("app_id", "p_default").collect()}
    assert get(without) == get(zero) and "pub_rec" not in without.columns


def test_no_model_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        MS.load_picked(spark, str(tmp_path))


@pytest.mark.parametrize("kind", ["logistic_regression", "random_forest"])
@pytest.mark.parametrize("rows, low, high", [([(float(i), 2.0, 0.0) for i in range(1, 6)], 0.0, 0.0), ([(float(i), 2.0, 1.0) for i in range(1, 6)], 1.0, 1.0),
                                             ([(1.0, 3.0, 0.0), (2.0, 4.0, 1.0)], 0.0, 1.0)])
def test_one_class_and_tiny_training_tables(spark, kind, rows, low, high):
    """A class that training never saw has probability 0; two rows are enough to fit."""
    train = spark.createDataFrame(rows, "a double, b double, label double")
    models, errors = ML.train_models(train, ["a", "b"], kinds=(kind,))
    assert not errors
    got = [r["score"] for r in ML.score(models[kind], train, kind).collect()]
    assert all(low <= s <= high for s in got) and len(got) == len(rows)
    if low == high:
        assert all(abs(s - low) < 1e-6 for s in got)


def test_failing_models_are_isolated(spark):
    train = spark.createDataFrame([], "a double, b double, label double")
    models, errors = ML.train_models(train, ["a", "b"], kinds=("logistic_regression", "random_forest"))
    assert not models and set(errors) == {"logistic_regression", "random_forest"}


def test_cards_by_repay_probability(spark):
    """L3: P(class 0), rejected rows apart, the fixed importances."""
    cards = I.card_applications(spark, SF)
    valid, rejected = MS.split_cards(cards)
    train = valid.withColumns({c: F.col(c).cast("string") for c in MS.CARD_CODES}).withColumn("label", F.col("target").cast("double"))
    model = ML.build_pipeline("gradient_boosting", MS.CARD_NUMERIC, MS.CARD_CODES, maxIter=3, maxDepth=3).fit(train)
    rows = MS.score_card_applications(valid, model, "m").collect()
    assert len(rows) + rejected.count() == cards.count()
    direct = {r["app_id"]: float(r["probability"][0]) for r in model.transform(train).select("app_id", "probability").collect()}
    for r in rows:
        assert r["p_repay"] == direct[r["app_id"]] and abs(r["risk_score"] - 100 * (1 - r["p_repay"])) < 1e-9
        assert r["confidence"] == ("high" if r["p_repay"] >= 0.8 else "medium" if r["p_repay"] >= 0.6 else "low")
        assert r["prediction"] in (0, 1) and r["features_importance"] == A.CARD_IMPORTANCE


def test_importance_of_columns_with_awkward_names(spark):
    rows = [(float(i % 7), f"k{i % 3}", f"z{i % 2}", float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "`a__oh b` double, `c__te` string, c string, label double")
    model = ML.build_pipeline("random_forest", ["a__oh b"], ["c__te", "c"], numTrees=5, maxDepth=3).fit(df)
    weights = ML.feature_importance(model, df)
    assert list(weights) == ["a__oh b", "c__te", "c"] and max(weights, key=weights.get) == "c" and abs(sum(weights.values()) - 1) < 1e-9


def test_param_importance_keeps_grid_order(spark):
    names = ["z", "y", "x", "w", "v", "u", "a"]
    rows = [({n: str(i % 2 if n != "a" else i) for n in names}, names, 0.5 + i / 10) for i in range(4)]
    got = [r["param"] for r in ML.param_importance(spark.createDataFrame(rows, "params map<string,string>, grid array<string>, mean_auc double")).collect()]
    assert sorted(got) == sorted(names[:6])
