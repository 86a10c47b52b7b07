"""Supervised regression job: prepare, search, evaluate, explain, store."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import comb

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import StandardScaler
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import band
from ..ml import features as feat, models as mod
from ..ml.selection import BestTerms
from ..operators import statistics as st
from ..operators.cleaning import drop_incomplete
from ..session import materialise

ALPHAS = [0.1, 1.0, 10.0, 100.0]
#: Factors of a term, and terms that stay.
DEGREES, KS = (1, 2), (10, 15, 20)


@dataclass
class RegressionRun:
    model_name: str
    scores: DataFrame
    metrics: DataFrame
    importance: DataFrame
    residuals: DataFrame


def prepare(df: DataFrame, numeric: Sequence[str], category: str, target: str, row_id: str,
            fraction: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame, list[str]]:
    """Coded category and measures as the vector ``measures``, and a split per category.

    What depends on the rows a model learns from (scale, terms, the best of them)
    is left to the stages of the searched pipelines.
    """
    complete = drop_incomplete(df.select(row_id, category, target, *numeric))
    marked = feat.mark_stratified(complete, row_id, fraction, [category], seed)
    coded = feat.index_category(marked, category, "alphabetAsc", "_code").withColumnRenamed(target, "label")
    base = ["_code", *numeric]
    ready = feat.assemble(coded, base, "measures").select(row_id, category, "label", "measures", "is_train")
    stored = materialise(ready, "regression-measures")
    return stored.where("is_train"), stored.where(~F.col("is_train")), base


def searched(regressor: Estimator, grid: list, size: int, degrees: Sequence[int] = DEGREES, ks: Sequence[int] = KS) -> tuple[Pipeline, list]:
    """Scaling, best terms and a regressor as one pipeline, with the grid over degree, number of terms and ``grid``.

    Numbers beyond the terms there are choose all of them and are tried once.
    """
    terms = BestTerms(inputCol="scaled")
    stages = [StandardScaler(inputCol="measures", outputCol="scaled", withMean=True), terms, regressor]
    maps = []
    for degree in degrees:
        there = sum(comb(size, n) for n in range(1, degree + 1))
        for k in sorted({min(k, there) for k in ks}):
            maps += [{terms.degree: degree, terms.k: k, **settings} for settings in grid]
    return Pipeline(stages=stages), maps


def default_grids(train: DataFrame, degrees: Sequence[int] = DEGREES, ks: Sequence[int] = KS) -> dict:
    unit = mod.ridge_unit(train)
    plain, ridge, lasso = mod.linear("linear"), mod.linear("ridge", 1.0, unit), mod.linear("lasso", 1.0)
    wood = mod.forest(50, 5)
    size = len(train.select("measures").head()[0])
    return {
        "linear": searched(plain, ParamGridBuilder().addGrid(plain.fitIntercept, [True, False]).build(), size, degrees, ks),
        "ridge": searched(ridge, ParamGridBuilder().addGrid(ridge.regParam, [a * unit for a in ALPHAS]).build(), size, degrees, ks),
        "lasso": searched(lasso, ParamGridBuilder().addGrid(lasso.regParam, ALPHAS).build(), size, degrees, ks[:2]),
        # trees need no products
        "forest": searched(wood, ParamGridBuilder().addGrid(wood.numTrees, [50, 100]).addGrid(wood.maxDepth, [5, 10]).build(),
                           size, degrees[:1], ks[:2]),
    }


def regression_run(df: DataFrame, numeric: Sequence[str], category: str, target: str, row_id: str,
                   folds: int = 5, grids=default_grids, model_path: str | None = None) -> RegressionRun:
    train, test, names = prepare(df, numeric, category, target, row_id)
    found = mod.grid_search(train, grids(train), folds)
    if model_path:
        mod.save_model(found.best, model_path)
    scored = found.best.transform(test)
    train_metrics = st.regression_metrics(found.best.transform(train), "label", "prediction")
    test_metrics = st.regression_metrics(scored, "label", "prediction")
    metrics = (train_metrics.withColumn("part", F.lit("train"))
               .unionByName(test_metrics.withColumn("part", F.lit("test")))
               .withColumns({"model": F.lit(found.best_name), "quality": band("r2")}))
    return RegressionRun(found.best_name, found.scores, metrics,
                         mod.feature_importance(found.best.stages[-1], found.best.stages[1].names(names), df.sparkSession),
                         st.residual_frame(scored.drop("measures", "scaled", "features"), "label", "prediction", category))
