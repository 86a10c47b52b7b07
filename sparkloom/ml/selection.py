"""Pipeline stages that choose what a model learns from, so that a search fits them anew in every fold."""

from __future__ import annotations

from functools import reduce
from itertools import chain, combinations
from operator import mul

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasLabelCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from .features import correlation


def _product(values: Column, term: str) -> Column:
    return reduce(mul, [values[int(i)] for i in term.split(",")])


class _TermParams(HasInputCol, HasOutputCol, HasLabelCol):
    degree = Param(Params._dummy(), "degree", "factors of a term at most, each measure once", TypeConverters.toInt)
    k = Param(Params._dummy(), "k", "terms that stay", TypeConverters.toInt)
    terms = Param(Params._dummy(), "terms", "places of the factors of each term that stays", TypeConverters.toListString)


class BestTerms(Estimator, _TermParams, DefaultParamsReadable, DefaultParamsWritable):
    """The k products of up to ``degree`` measures with the highest univariate F-score against the label.

    Fitting takes one pass that adds up all correlations. Terms are named by the
    places of their measures; equal scores go by that name, terms without a score
    (constants) come last. With fewer than k terms all stay.
    """

    @keyword_only
    def __init__(self, *, inputCol: str = "measures", outputCol: str = "features", labelCol: str = "label", degree: int = 1,
                 k: int = 10):
        super().__init__()
        self._setDefault(inputCol="measures", outputCol="features", labelCol="label", degree=1, k=10)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> BestTermsModel:
        values = vector_to_array(self.getInputCol())
        first = dataset.select(F.size(values)).head()
        size = first[0] if first else 0
        places = chain(*(combinations(range(size), n) for n in range(1, self.getOrDefault(self.degree) + 1)))
        names = [",".join(map(str, p)) for p in places]
        rows = dataset.select(F.col(self.getLabelCol()).cast("double").alias("y"), values.alias("v"))
        found = rows.agg(*[correlation(_product(F.col("v"), t), F.col("y")) for t in names]).first() if names else ()
        # of rows of one number the F-score grows with the squared correlation
        scored = sorted(zip(names, found, strict=True), key=lambda x: (x[1] is None, -(x[1] or 0.0) ** 2, x[0]))
        best = sorted(t for t, _ in scored[:self.getOrDefault(self.k)])
        return self._copyValues(BestTermsModel()._set(terms=best))


class BestTermsModel(Model, _TermParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the vector of the chosen terms."""

    def __init__(self):
        super().__init__()
        self._setDefault(inputCol="measures", outputCol="features", labelCol="label", degree=1, k=10)

    def names(self, measures: list[str]) -> list[str]:
        return ["_x_".join(measures[int(i)] for i in t.split(",")) for t in self.getOrDefault(self.terms)]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        with_values = dataset.withColumn("_measures", vector_to_array(self.getInputCol()))
        products = F.array(*[_product(F.col("_measures"), t) for t in self.getOrDefault(self.terms)])
        return with_values.withColumn(self.getOutputCol(), array_to_vector(products)).drop("_measures")
