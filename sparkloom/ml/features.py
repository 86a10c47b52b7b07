"""Feature engineering: everything that can be an expression is one, so it fuses with the scan."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, combinations_with_replacement

from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.attach import attach
from ..operators.order_stats import first_fraction

FLIGHT_FEATURES = ["Month", "DayOfWeek", "CRSDepTime", "CRSArrTime", "CRSElapsedTime", "Distance", "TaxiIn", "TaxiOut"]


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features", invalid: str = "error") -> DataFrame:
    """Columns to one vector; ``invalid`` is error (missing values are refused), skip or keep."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=invalid).transform(df)


def category_index(df: DataFrame, column: str, order: str = "frequencyDesc", out: str | None = None) -> StringIndexerModel:
    return StringIndexer(inputCol=column, outputCol=out or f"{column}_index", stringOrderType=order,
                         handleInvalid="keep").fit(df)


def index_category(df: DataFrame, column: str, order: str = "frequencyDesc", out: str | None = None) -> DataFrame:
    """Integer code per category, by falling frequency or (``alphabetAsc``) by name."""
    return category_index(df, column, order, out).transform(df)


def one_hot(df: DataFrame, column: str, known: Sequence, drop_first: bool = True) -> DataFrame:
    """One 0/1 column per known category; other values give zeros everywhere.

    The caller names the categories, since they become columns; for many or
    unknown ones index the category and encode the index as a vector.
    """
    used = list(known)[1:] if drop_first else list(known)
    return df.withColumns({f"{column}_{k}": F.coalesce((F.col(column) == F.lit(k)).cast("double"), F.lit(0.0))
                           for k in used})


def standardise(df: DataFrame, cols: Sequence[str], ddof: int = 0, centre: bool = True,
                fit_on: DataFrame | None = None) -> DataFrame:
    """Scale columns by mean and deviation (population with ``ddof=0``, sample with 1) of ``fit_on`` or the frame itself.

    A constant column is only centred.
    """
    deviation = F.stddev_pop if ddof == 0 else F.stddev_samp
    source = df if fit_on is None else fit_on
    stats = source.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[deviation(c).alias(f"s_{c}") for c in cols])
    out = {}
    scaled = attach(df, stats, [], "_z")
    for c in cols:
        spread = F.col(f"_z.s_{c}")
        shifted = F.col(c) - F.col(f"_z.m_{c}") if centre else F.col(c)
        out[c] = shifted / F.when(spread > 0, spread).otherwise(F.lit(1.0))
    return scaled.withColumns(out).drop("_z")


def poly_terms(cols: Sequence[str], degree: int = 2, interaction_only: bool = False) -> dict[str, Column]:
    """Products of up to ``degree`` columns by name; ``interaction_only`` uses each column at most once."""
    terms = {}
    for size in range(2, degree + 1):
        for combo in (combinations if interaction_only else combinations_with_replacement)(cols, size):
            product = F.col(combo[0])
            for c in combo[1:]:
                product = product * F.col(c)
            terms["_x_".join(combo)] = product
    return terms


def poly_features(df: DataFrame, cols: Sequence[str], degree: int = 2, interaction_only: bool = False) -> DataFrame:
    return df.withColumns(poly_terms(cols, degree, interaction_only))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation, NULL where one side is constant (``corr`` refuses it)."""
    known = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(*known), F.stddev_pop(known[0]) * F.stddev_pop(known[1]))


def f_scores(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Univariate regression F-score per column, from one aggregate pass."""
    rows = df.where(F.col(target).isNotNull())
    wide = rows.agg(F.count("*").alias("n"), *[correlation(F.col(c), F.col(target)).alias(f"_c{i}") for i, c in enumerate(cols)])
    long = wide.select("n", F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"_c{i}").alias("r")) for i, c in enumerate(cols)])))
    r2 = F.col("r") * F.col("r")
    return long.select("feature", (F.try_divide(r2, 1 - r2) * (F.col("n") - 2)).alias("f_score"))


def select_k_best(df: DataFrame, cols: Sequence[str], target: str, k: int) -> list[str]:
    """Names of the k columns with the highest F-score (as many rows as there are columns come to the driver)."""
    best = f_scores(df, cols, target).orderBy(F.desc_nulls_last("f_score"), "feature").limit(k).collect()
    return [row.feature for row in best]


def random_split(df: DataFrame, fraction: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    train, test = df.randomSplit([fraction, 1 - fraction], seed=seed)
    return train, test


def mark_stratified(df: DataFrame, row_id: str, fraction: float = 0.8, strata: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """Flag ``is_train``: exactly ``floor(fraction * n)`` rows of every stratum, chosen by a seeded hash of the id."""
    hashed = df.withColumn("_h", F.xxhash64(F.lit(seed), F.col(row_id)))
    return first_fraction(hashed, "_h", row_id, fraction, strata).drop("_h")


def stratified_split(df: DataFrame, row_id: str, fraction: float = 0.8, strata: Sequence[str] = (),
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of ``mark_stratified``; the same rows on every run."""
    marked = mark_stratified(df, row_id, fraction, strata, seed)
    return marked.where("is_train").drop("is_train"), marked.where(~F.col("is_train")).drop("is_train")
