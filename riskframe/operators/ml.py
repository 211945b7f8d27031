"""Model training, tuning and evaluation with Spark ML.

Every model is a ``pyspark.ml.Pipeline`` fitted on the training split only
(the reference fits imputers/scalers before the split — not copied).
Evaluation scores a held-out table and hands the long ``(model, label,
score, prediction)`` table to the metric operators, so all models and
folds are measured by one aggregate each.
"""

from __future__ import annotations

import itertools
import json
import math
import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, TargetEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..sources.files import _fs
from .cleaning import with_class_weights
from .core import col
from .metrics import binary_metrics, model_comparison

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
LR_MAX_ITER = 1000
LR_GRID_C = [0.1, 1.0, 10.0]
RF_TREES, RF_DEPTH = 50, 10
GBT_ITER, GBT_STEP, GBT_DEPTH = 100, 0.1, 6
# tuning grids: parameters in order, with the values of each
GRIDS = {
    "logistic_regression": {"C": [0.1, 1.0, 10.0], "maxIter": [1000]},
    "random_forest": {"numTrees": [50, 100], "maxDepth": [10, 15], "minInstancesPerNode": [1, 2]},
    "random_forest_wide": {"numTrees": [50, 100, 200], "maxDepth": [5, 10, 30], "minInstancesPerNode": [1, 2, 4]},
    "gradient_boosting": {"maxIter": [100, 200], "maxDepth": [4, 6], "stepSize": [0.05, 0.1]},
}
TUNING_FOLDS = 2
#: rows that a task of an iterative fit has at least before the table is dealt to more tasks
TASK_ROWS = 20_000
#: larger tables are fitted one point of a grid at a time: the learner keeps its own copy of the rows
SIDE_BY_SIDE = 2_000_000
#: trees are grown on the counted cells of tables of more rows, where rows of a cell are CELL_SHARE or more on average
CELL_ROWS, CELL_SHARE = 2_000_000, 4
#: values that a tree tells apart in a numeric column (Spark's ``maxBins``), and the shares of a class at which they are sought
BINS, SHARES = 32, 512


def _features(numeric: Sequence[str], categorical: Sequence[str], encode: str = "onehot",
              label: str = "label", scale: bool = False) -> list:
    stages, inputs = [], list(numeric)
    if categorical:
        idx = [f"{c}__idx" for c in categorical]
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=idx, handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        if encode == "target":
            te = [f"{c}__te" for c in categorical]
            stages.append(TargetEncoder(inputCols=idx, outputCols=te, labelCol=label, targetType="binary",
                                        handleInvalid="keep"))
            inputs += te
        else:
            oh = [f"{c}__oh" for c in categorical]
            stages.append(OneHotEncoder(inputCols=idx, outputCols=oh, dropLast=True, handleInvalid="keep"))
            inputs += oh
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features_raw", handleInvalid="keep"))
    if scale:
        stages.append(StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True))
    return stages


def build_pipeline(kind: str, numeric: Sequence[str], categorical: Sequence[str] = (), label: str = "label",
                   weight: str | None = None, n: int | None = None, **params) -> Pipeline:
    """K1–K4: logistic regression (scaled, L2, C → regParam = 1/(C·n)), random
    forest, or gradient-boosted trees on target-encoded categoricals."""
    if kind == "logistic_regression":
        stages = _features(numeric, categorical, "onehot", label, scale=True)
        c = params.get("C", 1.0)
        clf = LogisticRegression(featuresCol="features", labelCol=label, maxIter=params.get("maxIter", LR_MAX_ITER),
                                 regParam=1.0 / (c * n) if n else 0.0, elasticNetParam=0.0)
    elif kind == "random_forest":
        stages = _features(numeric, categorical, "onehot", label)
        clf = RandomForestClassifier(featuresCol="features_raw", labelCol=label, seed=42,
                                     numTrees=params.get("numTrees", RF_TREES),
                                     maxDepth=params.get("maxDepth", RF_DEPTH),
                                     minInstancesPerNode=params.get("minInstancesPerNode", 1))
    elif kind == "gradient_boosting":
        stages = _features(numeric, categorical, "target", label)
        clf = GBTClassifier(featuresCol="features_raw", labelCol=label, seed=42,
                            maxIter=params.get("maxIter", GBT_ITER),
                            stepSize=params.get("stepSize", GBT_STEP), maxDepth=params.get("maxDepth", GBT_DEPTH))
    else:
        raise ValueError(f"unknown model kind {kind!r}")
    if weight:
        clf.setWeightCol(weight)
    return Pipeline(stages=[*stages, clf])


def score(model: PipelineModel, df: DataFrame, name: str, label: str = "label",
          keep: Sequence[str] = ()) -> DataFrame:
    """Long scored table: (model, label, score = P(class 1), prediction, keep…)."""
    out = model.transform(df)
    return out.select(F.lit(name).alias("model"), F.col(label).alias("label"),
                      F.coalesce(F.get(vector_to_array("probability"), F.lit(1)), F.lit(0.0)).alias("score"),
                      F.col("prediction").cast("int").alias("prediction"), *keep)


def spread(df: DataFrame, n: int) -> DataFrame:
    """``df`` of ``n`` rows over all cores, where it has fewer tasks: learners pass
    over their rows hundreds of times in the tasks in which they find them."""
    wanted = min(df.sparkSession.sparkContext.defaultParallelism, n // TASK_ROWS)
    return df.repartition(wanted) if wanted > df.rdd.getNumPartitions() else df


def _nearest(data: DataFrame, numeric: Sequence[str], label: str, weight: str | None) -> dict[str, list[float]]:
    """Up to ``BINS`` values of each numeric column that stand for the others: all of
    a column of so few, else the quantiles by weight in the middle of equal shares."""
    def finite(c: str):
        v = col(c).cast("double")
        return F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)

    sizes = data.agg(F.lit(0), *[F.approx_count_distinct(finite(c), 0.02) for c in numeric]).first()[1:]
    few = [c for c, n in zip(numeric, sizes) if n <= 1.2 * BINS]
    sets = data.agg(F.lit(0), *[F.collect_set(finite(c)) for c in few]).first()[1:]   # at most about 1.2 BINS values each
    found = {c: sorted(v) for c, v in zip(few, sets) if len(v) <= BINS}
    rest = [c for c in numeric if c not in found]
    if rest:
        share = F.array(*[F.lit((i + 0.5) / SHARES) for i in range(SHARES)])
        own = F.lit(1.0) if weight is None else col(weight)
        classes = data.groupBy(col(label).alias("_class")).agg(*[f for c in rest for f in (
            F.percentile_approx(finite(c), share, 10_000), F.sum(F.when(finite(c).isNotNull(), own)))]).collect()   # a row a class
        for i, c in enumerate(rest):
            parts = [(r[1 + 2 * i], r[2 + 2 * i]) for r in classes if r[1 + 2 * i]]
            values = np.concatenate([np.asarray(v) for v, _ in parts])
            mass = np.concatenate([np.full(len(v), w / len(v)) for v, w in parts])
            order = np.argsort(values, kind="stable")
            below = np.cumsum(mass[order])
            at = np.searchsorted(below, (np.arange(BINS) + 0.5) / BINS * below[-1])
            found[c] = sorted(set(values[order][np.minimum(at, len(values) - 1)].tolist()))
    return found


def counted_cells(data: DataFrame, n: int, numeric: Sequence[str], categorical: Sequence[str], label: str,
                  weight: str | None) -> DataFrame | None:
    """The ``n`` rows of ``data`` as cells of equal rows with their number as ``_rows``, numeric
    values replaced by the nearest of ``_nearest``; none where that leaves too many cells.

    Learners of trees cut a column into ``BINS`` bins and see no more of a value.
    They put the cuts half way between the values that they find, which is just where the
    nearest value changes: a tree grown on the cells cuts the rows themselves alike.
    A missing number stands with the largest, as trees read NaN."""
    def stands(c: str, values: list[float]):
        if not values:
            return F.lit(None).cast("double").alias(c)
        e = F
        for low, high in zip(values, values[1:]):
            e = e.when(col(c).cast("double") <= F.lit((low + high) / 2.0), F.lit(low))
        return (F.lit(values[-1]) if e is F else e.otherwise(F.lit(values[-1]))).alias(c)

    keys = [*numeric, *categorical, label, *([weight] if weight else [])]
    nearest = _nearest(data, numeric, label, weight)
    rows = data.select(*[stands(c, nearest[c]) for c in numeric], *[col(c) for c in keys[len(numeric):]])
    if rows.agg(F.approx_count_distinct(F.xxhash64(*[col(c) for c in keys]), 0.02)).first()[0] > n // CELL_SHARE:
        return None
    return rows.groupBy(*[col(c) for c in keys]).agg(F.count(F.lit(1)).alias("_rows"))


def _draws(rows: pd.Series, keys: pd.Series, trees: int) -> pd.Series:
    """How often each tree's bootstrap sample holds the rows of a cell: a row is drawn by
    Poisson's law of mean 1, as the forest does it, and so ``rows`` of them by that of mean ``rows``."""
    return pd.Series([np.random.Generator(np.random.Philox(key=k & (1 << 64) - 1)).poisson(r, trees) for r, k in zip(rows, keys)])


def _forest(clf: RandomForestClassifier, cells: DataFrame, keys: Sequence[str], label: str, weight: str, parallelism: int = 4) -> RandomForestClassificationModel:
    """``clf`` grown tree by tree on counted cells: the bootstrap draws rows, not cells."""
    trees, features = clf.getNumTrees(), clf.getFeaturesCol()

    @F.pandas_udf("array<long>")
    def draws(rows: pd.Series, keys: pd.Series) -> pd.Series:
        return _draws(rows, keys, trees)

    drawn = cells.select(features, label, weight, draws("_rows", F.xxhash64(*[col(c) for c in keys], F.lit(clf.getSeed()))).alias("_draws")).persist()
    try:
        # a sample may lack a class, its tree may not
        classes = {"ml_attr": {"type": "nominal", "vals": [str(i) for i in range(int(drawn.agg(F.max(label)).first()[0]) + 1)]}}

        def grow(t: int) -> RandomForestClassificationModel:
            one = clf.copy({clf.numTrees: 1, clf.bootstrap: False, clf.seed: clf.getSeed() + t, clf.weightCol: "_w",
                            clf.featureSubsetStrategy: "sqrt"})   # what "auto" is for several trees
            sample = drawn.where(F.col("_draws")[t] > 0).select(features, col(label).alias(label, metadata=classes), (col(weight) * F.col("_draws")[t]).alias("_w"))
            return one.fit(sample)

        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            grown = list(pool.map(inheritable_thread_target(cells.sparkSession)(grow), range(trees)))
    finally:
        drawn.unpersist()
    sc = cells.sparkSession.sparkContext
    package = sc._jvm.org.apache.spark.ml.classification
    kept = sc._gateway.new_array(package.DecisionTreeClassificationModel, trees)
    for t, m in enumerate(grown):
        kept[t] = m.trees[0]._java_obj
    java = package.RandomForestClassificationModel(clf.uid, kept, grown[0].numFeatures, grown[0].numClasses)
    model = clf._copyValues(RandomForestClassificationModel(java))
    model._transfer_params_to_java()
    return model


def fit_on_cells(pipe: Pipeline, data: DataFrame, cells: DataFrame, label: str, weight: str | None) -> PipelineModel:
    """``pipe`` with its feature stages fitted on all rows of ``data`` and its trees on their ``cells``."""
    *made, clf = pipe.getStages()
    keys = [c for c in cells.columns if c != "_rows"]
    features = Pipeline(stages=made).fit(data)
    each = col(weight) if weight else F.lit(1.0)
    table = features.transform(cells.withColumn("_each", each))
    # so many bins that the values are found in all cells instead of a sample; columns have no more than BINS
    clf = clf.copy({clf.maxBins: max(BINS, math.isqrt(cells.count()) + 1)})
    if isinstance(clf, RandomForestClassifier):
        model = _forest(clf, table, keys, label, "_each")
    else:
        model = clf.setWeightCol("_w").fit(table.withColumn("_w", F.col("_each") * F.col("_rows")))
    return PipelineModel([*features.stages, model])


def train_models(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (),
                 label: str = "label", kinds: Sequence[str] = ("logistic_regression", "random_forest",
                                                               "gradient_boosting"),
                 balanced: bool = False) -> tuple[dict, dict]:
    """Fit every model kind; a failing model is isolated: ``(models, errors)``.  Trees of
    large tables are grown on ``counted_cells``, where these are few."""
    n, classes = train.agg(F.count(F.lit(1)), F.count_distinct(label)).first()
    data = train
    weight = "weight" if balanced else None
    if balanced:  # a table for one task stays as the join leaves it
        data = with_class_weights(train, label, "weight", classes if n > TASK_ROWS else None)
    if n > CELL_ROWS:
        data = data.select(*[col(c) for c in dict.fromkeys([*numeric, *categorical, label, *([weight] if weight else [])])])
    data = spread(data, n).persist()
    cells, counted = None, n <= CELL_ROWS
    try:   # iterative learners re-read their input many times: persist it only around the fits
        models, errors = {}, {}
        for k in kinds:
            try:
                pipe = build_pipeline(k, numeric, categorical, label, weight, n=n)
                if k != "logistic_regression" and not counted:
                    counted = True
                    found = counted_cells(data, n, numeric, categorical, label, weight)
                    if found is not None:
                        found = found.persist()
                        cells = found.repartition(max(1, min(found.sparkSession.sparkContext.defaultParallelism, found.count() // TASK_ROWS))).persist()
                        cells.count()
                        found.unpersist()
                models[k] = pipe.fit(data) if cells is None or k == "logistic_regression" else fit_on_cells(pipe, data, cells, label, weight)
            except Exception as e:  # isolate the failing model, as the reference does
                errors[k] = f"{type(e).__name__}: {e}"
    finally:
        data.unpersist()
        if cells is not None:
            cells.unpersist()
    return models, errors


def evaluate_models(models: dict, test: DataFrame, label: str = "label") -> DataFrame:
    """Metrics per model on the test table, best ROC AUC first."""
    scored = None
    for name, m in models.items():
        s = score(m, test, name, label)
        scored = s if scored is None else scored.unionByName(s)
    return model_comparison(scored, "model")


def cross_validate(df: DataFrame, kind: str, numeric: Sequence[str], categorical: Sequence[str] = (),
                   label: str = "label", fold: str = "fold", **params) -> DataFrame:
    """K5: per-fold metrics and their mean / population std (fold column from D3).
    Every fold model scores its held-out rows; all folds are then measured
    by one grouped aggregate."""
    df = df.persist()
    k = [r[0] for r in df.select(fold).distinct().collect()]   # k fold ids
    scored = None
    for f in sorted(k):
        tr, te = df.where(F.col(fold) != f), df.where(F.col(fold) == f)
        m = build_pipeline(kind, numeric, categorical, label, n=tr.count(), **params).fit(tr)
        s = score(m, te, kind, label).withColumn("fold", F.lit(f))
        scored = s if scored is None else scored.unionByName(s)
    # fold scores are small (one row per test row); materialise, then release the input
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    scored = scored.checkpoint(eager=True)
    df.unpersist()
    per_fold = binary_metrics(scored, ["fold"])
    metrics = ["accuracy", "precision", "recall", "f1", "roc_auc"]
    summary = per_fold.agg(*[F.avg(m).alias(f"{m}_mean") for m in metrics],
                           *[F.stddev_pop(m).alias(f"{m}_std") for m in metrics])
    return per_fold, summary


def grid_search(df: DataFrame, kind: str, numeric: Sequence[str], categorical: Sequence[str] = (),
                label: str = "label", fold: str = "fold", grid: dict | None = None, parallelism: int = 4):
    """K6: cross validation over a parameter grid with a fold column, scored by ROC
    AUC; returns (best model, results table of params → mean AUC).  As
    ``CrossValidator`` does it, but the feature stages, which no parameter touches, are
    fitted once a fold, and its points share the table that they make."""
    df = df.persist()
    n, last = df.agg(F.count(F.lit(1)), F.max(fold)).first()
    k = int(last) + 1
    pipe = build_pipeline(kind, numeric, categorical, label, n=n)
    *made, clf = pipe.getStages()
    builder = ParamGridBuilder()
    for p, values in (grid or {}).items():
        if kind == "logistic_regression" and p == "C":
            builder = builder.addGrid(clf.regParam, [1.0 / (c * n) for c in values])
        else:
            builder = builder.addGrid(clf.getParam(p), values)
    maps = builder.build()
    evaluator = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    total = [0.0] * len(maps)
    with ThreadPoolExecutor(max_workers=parallelism if n <= SIDE_BY_SIDE else 1) as pool:
        for f in range(k):
            rest, held = df.where(F.col(fold) != f), df.where(F.col(fold) == f)
            if rest.isEmpty() or held.isEmpty():
                raise ValueError(f"fold {f} holds no row, or all rows")
            features = Pipeline(stages=made).fit(rest)
            columns = [label, clf.getFeaturesCol()]
            fitted_on, scored = (features.transform(t).select(*columns).persist() for t in (rest, held))
            fits = clf.fitMultiple(fitted_on, maps)

            def fit_next(_):
                i, model = next(fits)
                return i, evaluator.evaluate(model.transform(scored))

            for i, auc in pool.map(inheritable_thread_target(df.sparkSession)(fit_next), maps):
                total[i] += auc
            fitted_on.unpersist()
            scored.unpersist()
    means = [t / k for t in total]
    best = pipe.fit(df, maps[max(range(len(maps)), key=means.__getitem__)])
    df.unpersist()
    rows = []
    for pm, auc in zip(maps, means):
        rows.append(({p.name: str(v) for p, v in pm.items()}, [p.name for p in pm], float(auc)))
    # a map keeps no order: the grid's is beside it
    res = df.sparkSession.createDataFrame(rows, "params map<string,string>, grid array<string>, mean_auc double")
    return best, res


def grid_points(grid: dict[str, Sequence]) -> list[dict]:
    """Every combination of the grid's values, the last parameter fastest."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def _done(spark: SparkSession, path: str, name: str) -> set[tuple[str, str]]:
    """(point, fold) of the logged runs of ``name`` that did not fail."""
    fs, place = _fs(spark, path)
    if not fs.exists(place):
        return set()
    runs = spark.read.schema(RUN_SCHEMA).parquet(path).where((F.col("run_name") == name) & F.col("metrics")["roc_auc"].isNotNull())
    return {(r["point"], r["fold"]) for r in runs.select(F.col("params")["point"].alias("point"), F.col("params")["fold"].alias("fold")).collect()}


def tune(df: DataFrame, kind: str, numeric: Sequence[str], path: str, categorical: Sequence[str] = (), label: str = "label",
         fold: str = "fold", grid: dict | None = None, parallelism: int = 4, name: str | None = None) -> DataFrame:
    """K6 through the run table (K17) at ``path``: every point of the grid on every
    fold is fitted on the other folds and logged with its ROC AUC, a failed one with its error;
    runs that the table already holds are not repeated, so a broken search goes
    on where it stopped.  Returns ``tuning_results``."""
    grid, name = grid or GRIDS[kind], name or f"tune_{kind}"
    spark = df.sparkSession
    done = _done(spark, path, name)
    data = df.persist()
    try:
        sizes = {r[fold]: r["count"] for r in data.groupBy(fold).count().collect()}  # a row a fold
        total = sum(sizes.values())

        def run(point: dict, f) -> tuple[dict, dict]:
            params = {**point, "point": json.dumps(point), "fold": str(f)}
            try:
                model = build_pipeline(kind, numeric, categorical, label, n=total - sizes[f], **point).fit(data.where(F.col(fold) != f))
                scored = score(model, data.where(F.col(fold) == f), kind, label)
                auc = binary_metrics(scored, ["model"]).first()["roc_auc"]
                if auc is None:
                    raise ValueError("the fold has one class only")
                return params, {"roc_auc": auc}
            except Exception as e:  # a failed point is a row of the results
                return {**params, "error": f"{type(e).__name__}: {e}"[:500]}, {}

        wanted = [(p, f) for p in grid_points(grid) for f in sorted(sizes) if (json.dumps(p), str(f)) not in done]
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            # logged here, one by one as they end: appends to one table must not overlap
            for ended in as_completed([pool.submit(run, *w) for w in wanted]):
                log_run(spark, path, name, *ended.result())
    finally:
        data.unpersist()
    return tuning_results(spark.read.schema(RUN_SCHEMA).parquet(path).where(F.col("run_name") == name), list(grid), len(sizes))


def tuning_results(runs: DataFrame, grid: Sequence[str], folds: int) -> DataFrame:
    """params, grid, folds (that succeeded), mean_auc (null unless all did), error
    (of a fold that never did), rank (by mean_auc, then the point's text); a row a point."""
    p = F.col("params")
    latest = runs.groupBy(p["point"].alias("point"), p["fold"].alias("fold")).agg(
        F.max(F.col("metrics")["roc_auc"]).alias("auc"), F.max(p["error"]).alias("error"), F.first("params").alias("params"))
    points = latest.groupBy("point").agg(F.first("params").alias("params"), F.count("auc").alias("folds"), F.avg("auc").alias("mean_auc"),
                                         F.max(F.when(F.col("auc").isNull(), F.col("error"))).alias("error"))
    names = F.array(*[F.lit(g) for g in grid])
    shown = points.select("point", F.map_filter("params", lambda k, v: F.array_contains(names, k)).alias("params"), names.alias("grid"), "folds",
                          F.when(F.col("folds") == folds, F.col("mean_auc")).alias("mean_auc"), "error")
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc_nulls_last("mean_auc"), "point")  # as many rows as the grid has points
    return shown.withColumn("rank", F.row_number().over(w))


def best_point(results: DataFrame) -> dict:
    """The parameters of the best point that every fold has scored."""
    row = results.where(F.col("mean_auc").isNotNull()).orderBy("rank").first()
    if row is None:
        raise RuntimeError("no point of the grid succeeded on all folds")
    return json.loads(row["point"])


def param_importance(results: DataFrame, limit: int = 6) -> DataFrame:
    """Per parameter, max − min of the mean score over its values, for the
    first ``limit`` parameters in grid order."""
    e = results.select("params", F.posexplode("grid").alias("place", "param"), "mean_auc").withColumn("value", F.col("params")[F.col("param")])
    per_value = e.groupBy("param", "value").agg(F.avg("mean_auc").alias("m"), F.min("place").alias("place"))
    return (per_value.groupBy("param").agg((F.max("m") - F.min("m")).alias("importance"), F.min("place").alias("place"))
            .orderBy("place", "param").limit(limit).orderBy(F.desc("importance"), "param").drop("place"))


def feature_importance(model: PipelineModel, data: DataFrame) -> dict[str, float] | None:
    """Source column → importance for tree models (None when unsupported);
    the indicators of a one-hot column count together.  ``data`` has the
    pipeline's input columns; only its schema is used."""
    clf = model.stages[-1]
    if not hasattr(clf, "featureImportances"):
        return None
    # which column an encoder made from which, as the stages themselves say
    made = {o: i for stage in model.stages[:-1] if stage.hasParam("inputCols") and stage.hasParam("outputCols")
            for i, o in zip(stage.getInputCols(), stage.getOutputCols())}
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    empty = data.limit(0)
    if empty.isStreaming:
        empty = data.sparkSession.createDataFrame([], data.schema)
    schema = model.transform(empty).schema
    widths = {c: schema[c].metadata.get("ml_attr", {}).get("num_attrs", 1) for c in assembler.getInputCols()}
    values, at, out = clf.featureImportances.toArray(), 0, {}
    for c, width in widths.items():
        source = c
        while source in made:
            source = made[source]
        out[source] = out.get(source, 0.0) + float(values[at:at + width].sum())
        at += width
    return out


# --------------------------------------------------------------------------- K17–K19 run table

RUN_SCHEMA = "run_id string, run_name string, ts timestamp, params map<string,string>, metrics map<string,double>"


def log_run(spark: SparkSession, path: str, run_name: str, params: dict, metrics: dict) -> str:
    """Append one run row (params: scalars and lists shorter than 10)."""
    keep = {k: json.dumps(v) if isinstance(v, list) else str(v) for k, v in params.items()
            if not isinstance(v, (dict, set)) and (not isinstance(v, list) or len(v) < 10)}
    run_id = uuid.uuid4().hex
    row = [(run_id, run_name, time.strftime("%Y-%m-%d %H:%M:%S"), keep,
            {k: float(v) for k, v in metrics.items()})]
    df = spark.createDataFrame(row, RUN_SCHEMA.replace("ts timestamp", "ts string")).withColumn(
        "ts", F.to_timestamp("ts"))
    df.write.mode("append").parquet(path)
    return run_id


def best_run(runs: DataFrame, metric: str, ascending: bool = False) -> DataFrame:
    """The first run by ``metric``."""
    m = F.col("metrics")[metric]
    return runs.where(m.isNotNull()).orderBy(m.asc() if ascending else m.desc()).limit(1)


def compare_runs(runs: DataFrame, metrics: Sequence[str], run_ids: Sequence[str] | None = None) -> DataFrame:
    """Run × metric table (missing -> null)."""
    r = runs if run_ids is None else runs.where(F.col("run_id").isin(list(run_ids)))
    return r.select("run_id", "run_name", *[F.col("metrics")[m].alias(m) for m in metrics])
