"""Model training, selection and comparison with MLlib."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, LinearSVC, LogisticRegression, NaiveBayes, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, MulticlassClassificationEvaluator,
                                   RegressionEvaluator)
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import delay_label
from ..operators.statistics import classification_metrics, regression_metrics
from ..session import materialise
from .features import FLIGHT_FEATURES, random_split
from .forests import METRICS, Forest, grow
from .moments import fit_from_moments, learns_from_moments, moments


def fit_stages(df: DataFrame, stages: Sequence) -> PipelineModel:
    return Pipeline(stages=list(stages)).fit(df)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def ridge_unit(train: DataFrame, label: str = "label") -> float:
    """Spark's regularisation for a ridge ``alpha`` of 1 on this frame.

    Spark averages the squared loss over the rows and applies the quadratic
    penalty to a label scaled by its deviation.
    """
    row = train.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
    return row.s / row.n if row.n else 0.0


def linear(kind: str = "linear", alpha: float = 1.0, unit: float | None = None, intercept: bool = True,
           features: str = "features", label: str = "label") -> LinearRegression:
    """Ordinary, ridge or lasso regression with the usual single-machine meaning of ``alpha``.

    Ridge needs the ``ridge_unit`` of its training rows; inputs are expected to
    be scaled already.
    """
    model = LinearRegression(featuresCol=features, labelCol=label, fitIntercept=intercept, standardization=False)
    if kind == "linear":
        return model.setRegParam(0.0)
    if kind == "ridge":
        if unit is None:
            raise ValueError("ridge needs the ridge_unit of its training rows")
        return model.setRegParam(alpha * unit).setElasticNetParam(0.0)
    if kind == "lasso":
        return model.setRegParam(alpha).setElasticNetParam(1.0)
    raise ValueError(f"unknown linear model {kind!r}")


def forest(trees: int = 100, depth: int = 10, min_leaf: int = 1, features: str = "features", label: str = "label",
           seed: int = 42, kind: type[RandomForestRegressor] = Forest) -> RandomForestRegressor:
    """``kind`` RandomForestRegressor learns in MLlib, as the forecasts do.

    There rows remember the node of each tree they are in, so that no level of a deep forest walks down all trees again.
    """
    return kind(featuresCol=features, labelCol=label, numTrees=trees, maxDepth=depth,
                minInstancesPerNode=min_leaf, seed=seed, cacheNodeIds=True)


def tree(depth: int = 10, min_leaf: int = 1, features: str = "features", label: str = "label",
         seed: int = 42) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(featuresCol=features, labelCol=label, maxDepth=depth, minInstancesPerNode=min_leaf, seed=seed)


def classifier(kind: str, features: str = "features", label: str = "label", seed: int = 42, **settings) -> Estimator:
    """``forest``, ``tree``, ``bayes`` (Gaussian), ``logistic`` or ``svm`` (linear, one against the rest)."""
    columns = {"featuresCol": features, "labelCol": label}
    if kind == "forest":
        return RandomForestClassifier(seed=seed, **columns, **settings)
    if kind == "tree":
        return DecisionTreeClassifier(seed=seed, **columns, **settings)
    if kind == "bayes":
        return NaiveBayes(modelType="gaussian", **columns, **settings)
    if kind == "logistic":
        return LogisticRegression(**columns, **settings)
    if kind == "svm":
        return OneVsRest(classifier=LinearSVC(**columns, **settings), **columns)
    raise ValueError(f"unknown classifier {kind!r}")


def dealt(df: DataFrame, label: str = "label") -> DataFrame:
    """The rows dealt evenly over all cores, those of like labels side by side, for learning trees.

    That costs far more per row than reading, so parts of a file's size leave most cores idle. Rows of like labels mostly
    go to the same nodes of a tree, whose counts then stay in the processor's cache. Parts come in whole rounds of the
    cores: one part more would keep all others waiting at every level of the trees.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    rounds = max(1, round(df.rdd.getNumPartitions() / cores))
    return df.repartition(rounds * cores).sortWithinPartitions(label)


def _on_all_cores(df: DataFrame) -> bool:
    return df.rdd.getNumPartitions() >= df.sparkSession.sparkContext.defaultParallelism


def fit(estimator: Estimator, train: DataFrame) -> Model:
    trees = (RandomForestRegressor, DecisionTreeRegressor, RandomForestClassifier, DecisionTreeClassifier)
    if not isinstance(estimator, trees) or (isinstance(estimator, Forest) and estimator.learns_here(train) and _on_all_cores(train)):
        return estimator.fit(train)  # a forest deals binned rows itself, and needs cores only to read them
    return estimator.fit(dealt(train, estimator.getLabelCol()))


def delay_model(df: DataFrame, features: Sequence[str] = tuple(FLIGHT_FEATURES), fraction: float = 0.8, seed: int = 42,
                iterations: int = 100) -> tuple[PipelineModel, DataFrame, float]:
    """Late-arrival classifier: fitted stages, scored test rows and the area under the ROC curve."""
    known = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in features]))
    labelled = known.select(*features, delay_label("ArrDelay").alias("delayed"))
    train, test = random_split(labelled, fraction, seed)
    model = fit_stages(train, [VectorAssembler(inputCols=list(features), outputCol="features"),
                               LogisticRegression(featuresCol="features", labelCol="delayed", maxIter=iterations)])
    scored = model.transform(test)
    return model, scored, BinaryClassificationEvaluator(labelCol="delayed").evaluate(scored)


def carrier_features(df: DataFrame) -> DataFrame:
    """Carrier code, distance and scheduled time as one vector."""
    stages = [StringIndexer(inputCol="UniqueCarrier", outputCol="carrier_index", handleInvalid="keep"),
              VectorAssembler(inputCols=["carrier_index", "Distance", "CRSElapsedTime"], outputCol="features")]
    return fit_stages(df, stages).transform(df)


def _evaluator(metric: str, label: str):
    if metric in ("rmse", "mse", "r2", "mae"):
        return RegressionEvaluator(labelCol=label, metricName=metric)
    if metric == "areaUnderROC":
        return BinaryClassificationEvaluator(labelCol=label)
    return MulticlassClassificationEvaluator(labelCol=label, metricName=metric)


@dataclass
class SearchResult:
    best: Model
    best_name: str
    best_metric: float
    scores: DataFrame


def cross_validate(df: DataFrame, estimator: Estimator, grid=None, folds: int = 5, metric: str = "mse",
                   label: str = "label", seed: int = 42, parallelism: int = 4) -> CrossValidatorModel:
    grid = ParamGridBuilder().build() if grid is None else grid
    return CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=_evaluator(metric, label),
                          numFolds=folds, seed=seed, parallelism=parallelism).fit(df)


class _FoldStages:
    """Stages before the last one of searched pipelines, fitted once per fold however many settings share them."""

    def __init__(self, train: DataFrame, held: DataFrame):
        self.made = {(): (train, held)}

    def prepare(self, stages: Sequence) -> tuple[DataFrame, DataFrame]:
        """Both parts of the fold after these stages, which are known by their kind and settings."""
        key = tuple((type(s), *sorted(f"{p.name}={v!r}" for p, v in s.extractParamMap().items())) for s in stages)
        if key not in self.made:
            train, held = self.prepare(stages[:-1])
            model = stages[-1].fit(train) if isinstance(stages[-1], Estimator) else stages[-1]
            self.made[key] = model.transform(train), model.transform(held)
        return self.made[key]


def _split_stages(estimator: Estimator, params: Mapping) -> tuple[list, Estimator]:
    """What precedes the learner, and the learner, with the settings in place."""
    stages = estimator.copy(params).getStages() if isinstance(estimator, Pipeline) else [estimator.copy(params)]
    return stages[:-1], stages[-1]


def _together(learner: Estimator, metric: str) -> tuple:
    """What learners of the same rows that can learn together have in common (any other one is by itself)."""
    if isinstance(learner, Forest):
        rest = sorted(f"{p.name}={v!r}" for p, v in learner.extractParamMap().items() if p.name not in ("numTrees", "maxDepth"))
        return ("forest", *rest)
    if learns_from_moments(learner, metric):
        return "linear", learner.getFeaturesCol(), learner.getLabelCol()
    return "alone", id(learner)


def _measured(learners: Sequence[Estimator], train: DataFrame, held: DataFrame, evaluator, metric: str) -> list[float]:
    """The metric of each learner (of those that learn together) on the rows held out.

    The trees of a forest are the first of a larger one, and lie at the top of deeper ones. Linear models
    learn from means and covariances, and their errors follow from those of the rows held out.
    """
    first = learners[0]
    if isinstance(first, Forest) and first.learns_here(train):
        deepest = first.copy({first.numTrees: max(x.getNumTrees() for x in learners), first.maxDepth: max(x.getMaxDepth() for x in learners)})
        grown = grow(deepest, train)
        if metric in METRICS:
            return grown.errors(learners, held, metric)
        return [evaluator.evaluate(grown.model(x, train.sparkSession).transform(held)) for x in learners]
    if learns_from_moments(first, metric) and (of := moments(train, first.getFeaturesCol(), first.getLabelCol())):
        left_out = moments(held, first.getFeaturesCol(), first.getLabelCol())
        return [left_out.error(fit_from_moments(x, of, train.sparkSession), metric) for x in learners]
    return [evaluator.evaluate(x.fit(train).transform(held)) for x in learners]


def grid_search(df: DataFrame, grids: Mapping[str, tuple[Estimator, list]], folds: int = 5, metric: str = "mse",
                label: str = "label", seed: int = 42, parallelism: int = 4) -> SearchResult:
    """k-fold search over several estimators with their grids; the best mean metric wins.

    Folds are those of ``CrossValidator``. Stages that settings share are fitted once
    in a fold, and so are forests that hold one another and the moments that linear
    models learn from; all learners of all folds share the cores, and only the winner
    is fitted to all rows.
    """
    evaluator = _evaluator(metric, label)
    df = materialise(dealt(df, label), "search")  # stored, since the folds go by the places of the rows
    placed = df.withColumn("_place", F.rand(seed))
    settings = [(name, estimator, params) for name, (estimator, grid) in grids.items() for params in grid]
    tasks: dict[tuple, list] = {}
    for fold in range(folds):
        inside = (F.col("_place") >= fold * (1.0 / folds)) & (F.col("_place") < (fold + 1) * (1.0 / folds))
        shared = _FoldStages(placed.where(~inside), placed.where(inside))
        for at, (_, estimator, params) in enumerate(settings):
            before, learner = _split_stages(estimator, params)
            parts = shared.prepare(before)
            tasks.setdefault((fold, id(parts), _together(learner, metric)), []).append((at, learner, parts))

    found = np.zeros((folds, len(settings)))

    def measured(task: tuple) -> None:
        (fold, *_), members = task
        at, learners, parts = zip(*members, strict=True)
        found[fold, list(at)] = _measured(learners, *parts[0], evaluator, metric)

    with ThreadPool(parallelism) as pool:
        pool.map(inheritable_thread_target(df.sparkSession)(measured), tasks.items(), chunksize=1)
    means, deviations = found.mean(axis=0), found.std(axis=0)
    best = int((np.argmax if evaluator.isLargerBetter() else np.argmin)(means))
    name, estimator, params = settings[best]
    rows = [(n, ", ".join(sorted(f"{p.name}={v}" for p, v in q.items())), float(m), float(d))
            for (n, _, q), m, d in zip(settings, means, deviations, strict=True)]
    scores = df.sparkSession.createDataFrame(rows, "model string, parameters string, mean_metric double, std_metric double")
    return SearchResult(estimator.copy(params).fit(df), name, float(means[best]), scores)


def cv_scores(df: DataFrame, estimator: Estimator, folds: int = 5, metric: str = "r2", label: str = "label",
              seed: int = 42) -> tuple[float, float]:
    """Mean and deviation of a metric over the folds."""
    fitted = cross_validate(df, estimator, None, folds, metric, label, seed)
    return float(fitted.avgMetrics[0]), float(fitted.stdMetrics[0])


def compare_models(train: DataFrame, test: DataFrame, estimators: Mapping[str, Estimator], label: str = "label",
                   task: str = "regression") -> DataFrame:
    """Test metrics per model, best first (R² or accuracy)."""
    tables = []
    for name, estimator in estimators.items():
        scored = fit(estimator, train).transform(test)
        if task == "regression":
            metrics = regression_metrics(scored, label, "prediction")
        else:
            metrics = classification_metrics(scored, label, "prediction")
        tables.append(metrics.withColumn("model", F.lit(name)))
    table = reduce(DataFrame.unionByName, tables)
    return table.orderBy(F.desc("r2" if task == "regression" else "accuracy"), "model")


def feature_importance(model, names: Sequence[str], spark) -> DataFrame:
    """Importance (trees) or coefficient size (linear models) per feature, largest first."""
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    else:
        values = model.coefficients.toArray()
    rows = [(n, float(v), float(abs(v))) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, value double, importance double").orderBy(
        F.desc("importance"), "feature")


def rank_coefficients(model, names: Sequence[str], spark, k: int = 10) -> DataFrame:
    return feature_importance(model, names, spark).limit(k)


def text_model(train: DataFrame, text: str = "text", label: str = "label", buckets: int = 1 << 18,
               iterations: int = 50, reg: float = 0.01) -> PipelineModel:
    """Text to label with probability: word counts by hash, weighted by rarity, into a logistic model."""
    return fit_stages(train, [
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"[^\p{L}\p{N}]+", toLowercase=True),
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=buckets),
        IDF(inputCol="_counts", outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol=label, maxIter=iterations, regParam=reg),
    ])


def score_text(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Predicted label and its probability."""
    scored = model.transform(df)
    return scored.withColumn("confidence", F.array_max(vector_to_array("probability"))).drop(
        "_words", "_counts", "features", "rawPrediction", "probability")


def score(df: DataFrame, model, r2: float, model_name: str, now, prefix: str = "fish_pred") -> DataFrame:
    """Predictions with two decimals, clamped confidence, model name, id and time."""
    stamp = F.lit(now).cast("timestamp")
    confidence = round(min(0.95, max(0.7, r2)), 3)
    return model.transform(df).withColumns({
        "predicted_weight": F.round("prediction", 2),
        "confidence_score": F.lit(confidence),
        "model_used": F.lit(model_name),
        "prediction_id": F.concat(F.lit(f"{prefix}_"), F.date_format(stamp, "yyyyMMdd_HHmmss")),
        "timestamp": stamp,
    })


def trainable(df: DataFrame, key: str, complete=None, min_rows: int = 50, min_valid: int = 30) -> DataFrame:
    """Row counts per key and whether there is enough to train on."""
    valid = F.lit(True) if complete is None else complete
    counted = df.groupBy(key).agg(F.count("*").alias("rows"), F.count_if(valid).alias("valid_rows"))
    return counted.withColumn("trainable", (F.col("rows") >= min_rows) & (F.col("valid_rows") >= min_valid))
