"""Linear models from the means and covariances of their rows, which one pass adds up for any number of settings."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, functions as F

#: Features whose products fit well into a row that a task returns.
MOST_FEATURES = 512


@dataclass
class Moments:
    """Number of rows, means and (centred) sums of products of the features and, last, the label."""

    n: int
    means: np.ndarray
    products: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not self.n or not other.n:
            return self if self.n else other
        apart = other.means - self.means
        return Moments(n, self.means + apart * (other.n / n),
                       self.products + other.products + np.outer(apart, apart) * (self.n * other.n / n))

    def pseudo_rows(self, spark) -> DataFrame:
        """A few weighted rows of the same number, means and covariances."""
        spread = np.sqrt(np.diag(self.products) / self.n)
        varied = np.flatnonzero(spread > 0)
        scaled = self.products[np.ix_(varied, varied)] / self.n / np.outer(spread[varied], spread[varied])
        sizes, axes = np.linalg.eigh(scaled)
        count = max(1, len(varied))
        steps = np.zeros((count, len(spread)))
        steps[:len(varied), varied] = (axes * np.sqrt(np.maximum(sizes, 0.0) * count)).T * spread[varied]
        rows = np.concatenate([self.means + steps, self.means - steps])
        table = pa.table({"x": pa.array(list(rows[:, :-1]), pa.list_(pa.float64())), "label": rows[:, -1],
                          "weight": np.full(len(rows), self.n / len(rows))})
        return spark.createDataFrame(table).coalesce(1).select(array_to_vector("x").alias("features"), "label", "weight")

    def error(self, model: LinearRegressionModel, metric: str) -> float:
        """``mse``, ``rmse`` or ``r2`` of the model over these rows."""
        if not self.n:
            return float("nan")
        by = np.r_[-model.coefficients.toArray(), 1.0]
        mse = max(float(by @ self.products @ by) / self.n, 0.0) + float(self.means @ by - model.intercept) ** 2
        if metric == "r2":
            total = float(self.products[-1, -1])
            return 1 - mse * self.n / total if total else (float("nan") if not mse else float("-inf"))
        return mse if metric == "mse" else mse**0.5


def learns_from_moments(learner, metric: str) -> bool:
    """Whether the learner sees no more of its rows than their moments, nor the metric of the predictions."""
    return (isinstance(learner, LinearRegression) and learner.getSolver() in ("auto", "normal") and learner.getLoss() == "squaredError"
            and not (learner.isDefined(learner.weightCol) and learner.getWeightCol()) and metric in ("mse", "rmse", "r2"))


def moments(df: DataFrame, features: str, label: str) -> Moments | None:
    """Moments of a frame in one pass; none where there are too many features."""
    first = df.select(F.size(vector_to_array(features))).head()
    width = first[0] if first else 0
    if width > MOST_FEATURES:
        return None

    def add_up(batches):
        held = Moments(0, np.zeros(width + 1), np.zeros((width + 1, width + 1)))
        for batch in batches:
            if batch.num_rows:
                rows = np.column_stack([np.asarray(batch.column(0).flatten()).reshape(-1, width), np.asarray(batch.column(1))])
                means = rows.mean(axis=0)
                rows -= means
                held += Moments(len(rows), means, rows.T @ rows)
        yield pa.RecordBatch.from_arrays([pa.array([held.n], pa.int64()), pa.array([held.means.tobytes()], pa.binary()),
                                          pa.array([held.products.tobytes()], pa.binary())], ["n", "means", "products"])

    found = df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y")).mapInArrow(
        add_up, "n bigint, means binary, products binary").collect()
    total = Moments(0, np.zeros(width + 1), np.zeros((width + 1, width + 1)))
    for r in found:
        total += Moments(r.n, np.frombuffer(r.means), np.frombuffer(r.products).reshape(width + 1, width + 1))
    return total


def fit_from_moments(learner: LinearRegression, of: Moments, spark) -> LinearRegressionModel:
    """The learner's own fit, to rows of these moments."""
    rows = of.pseudo_rows(spark).toDF(learner.getFeaturesCol(), learner.getLabelCol(), "_weight")
    return learner.copy().setWeightCol("_weight").fit(rows)
