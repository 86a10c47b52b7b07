"""Descriptive statistics, histograms, regressions and evaluation metrics."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import absolute_error, percent_error
from ..functions.text import bind, json_value
from .attach import attach
from .order_stats import percentiles

QUARTILES = [0.25, 0.5, 0.75]


def percentile_of(df: DataFrame, column: str, p: float, name: str, key: Sequence[str] = (),
                  exact: bool = True) -> DataFrame:
    return percentiles(df, column, [p], key, exact).select(*key, F.col("p_0").alias(name))


def _melt(df: DataFrame, cols: Sequence[str], key: Sequence[str] = ()) -> DataFrame:
    return df.select(*key, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in cols])))


def describe(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles, one row per column."""
    long = _melt(df, cols)
    moments = long.groupBy("column_name").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    quartiles = percentiles(long, "value", QUARTILES, ["column_name"], exact)
    return attach(moments, quartiles, ["column_name"], "_q", stored=False).select(
        "column_name", "count", "mean", "std", "min", F.col("_q.p_0").alias("q1"),
        F.col("_q.p_1").alias("median"), F.col("_q.p_2").alias("q3"), "max")


def box_stats(df: DataFrame, key: str, column: str, exact: bool = True) -> DataFrame:
    """Five-number summary per group."""
    extremes = df.groupBy(key).agg(F.min(column).alias("min"), F.max(column).alias("max"))
    quartiles = percentiles(df, column, QUARTILES, [key], exact)
    return attach(extremes, quartiles, [key], "_q", stored=False).select(
        key, "min", F.col("_q.p_0").alias("q1"), F.col("_q.p_1").alias("median"), F.col("_q.p_2").alias("q3"), "max")


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, both orders, from one aggregate pass."""
    pairs = list(combinations_with_replacement(cols, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"_c{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"_c{i}").alias("corr")))
    return wide.select(F.inline(F.array(*cells)))


def corr_with_target(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Columns ranked by the size of their correlation with the target."""
    wide = df.agg(*[F.corr(c, target).alias(f"_c{i}") for i, c in enumerate(cols)])
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"_c{i}").alias("corr")) for i, c in enumerate(cols)])))
    return long.withColumn("abs_corr", F.abs("corr")).orderBy(F.desc("abs_corr"), "feature")


def _bin_frame(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Attach ``_b.lo``, ``_b.hi`` and ``_b.width`` of equal-width bins; a constant column gets width 1 around it."""
    edges = df.agg(F.min(column).cast("double").alias("mn"), F.max(column).cast("double").alias("mx"))
    constant = F.col("mn") == F.col("mx")
    edges = edges.select(
        F.when(constant, F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
        F.when(constant, F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi"),
    ).withColumn("width", (F.col("hi") - F.col("lo")) / bins)
    return attach(df.where(F.col(column).isNotNull()), edges, [], "_b")


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Counts of equal-width bins (left-closed, the last one closed on both sides), empty bins included."""
    binned = _bin_frame(df, column, bins)
    index = F.least(F.lit(bins - 1), F.floor((F.col(column) - F.col("_b.lo")) / F.col("_b.width")))
    counts = binned.groupBy(index.cast("bigint").alias("bin")).agg(F.count("*").alias("n"))
    frame = _bin_edges(df, column, bins)
    return (frame.join(counts, "bin", "left")
            .select("bin", "bin_start", "bin_end", F.coalesce("n", F.lit(0)).alias("count")))


def _bin_edges(df: DataFrame, column: str, bins: int) -> DataFrame:
    edges = df.agg(F.min(column).cast("double").alias("mn"), F.max(column).cast("double").alias("mx"))
    constant = F.col("mn") == F.col("mx")
    lo = F.when(constant, F.col("mn") - 0.5).otherwise(F.col("mn"))
    hi = F.when(constant, F.col("mx") + 0.5).otherwise(F.col("mx"))
    steps = F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))
    return (edges.where(F.col("mn").isNotNull())
            .select(lo.alias("lo"), ((hi - lo) / bins).alias("width"), F.explode(steps).alias("bin"))
            .select("bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
                    (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end")))


def right_closed_bin(value, lo, width, bins: int) -> Column:
    """1-based index of right-closed equal-width bins; the smallest value belongs to the first."""
    return F.greatest(F.lit(1), F.least(F.lit(bins), F.ceil((value - lo) / width))).cast("bigint")


def with_value_bin(df: DataFrame, column: str, bins: int = 5, name: str = "bin") -> DataFrame:
    return _bin_frame(df, column, bins).withColumn(
        name, right_closed_bin(F.col(column), F.col("_b.lo"), F.col("_b.width"), bins)).drop("_b")


def error_by_bin(df: DataFrame, actual: str, predicted: str, bins: int = 5) -> DataFrame:
    """Mean absolute error per bin of the actual value; empty bins do not appear."""
    return (with_value_bin(df, actual, bins).groupBy("bin")
            .agg(F.avg(absolute_error(actual, predicted)).alias("mean_abs_error"), F.count("*").alias("n")))


def residual_frame(df: DataFrame, actual: str, predicted: str, group: str, bins: int = 5) -> DataFrame:
    """Per row: residual, absolute and percentage error and the bin of the actual value."""
    return with_value_bin(df, actual, bins).withColumns({
        "residual": F.col(actual) - F.col(predicted),
        "abs_error": absolute_error(actual, predicted),
        "pct_error": percent_error(actual, predicted),
    })


def least_squares(df: DataFrame, x: str, y: str) -> DataFrame:
    """Intercept and slope of the line through the average ``y`` of every ``x >= 0``; 0.0 where undefined."""
    averaged = (df.where(F.col(x) >= 0).groupBy(x).agg(F.avg(y).alias("_y")).where(F.col("_y").isNotNull()))
    return averaged.agg(
        F.coalesce(F.regr_intercept("_y", x), F.lit(0.0)).alias("intercept"),
        F.coalesce(F.regr_slope("_y", x), F.lit(0.0)).alias("slope"),
    )


def regression_metrics(df: DataFrame, actual: str, predicted: str, key: Sequence[str] = ()) -> DataFrame:
    """MSE, RMSE, MAE, R² and MAPE (rows with a zero actual value left out of the last one)."""
    a, p = F.col(actual), F.col(predicted)
    base = df.where(a.isNotNull() & p.isNotNull())
    sums = base.groupBy(*key).agg(
        F.count("*").alias("n"),
        F.avg((a - p) * (a - p)).alias("mse"),
        F.avg(F.abs(a - p)).alias("mae"),
        F.var_pop(a).alias("_var"),
        F.avg(percent_error(actual, predicted)).alias("mape"),
    )
    return sums.select(*key, "n", "mse", F.sqrt("mse").alias("rmse"), "mae",
                       (1 - F.try_divide(F.col("mse"), F.col("_var"))).alias("r2"), "mape")


def overfit_check(train_metrics: DataFrame, test_metrics: DataFrame, threshold: float = 0.1) -> DataFrame:
    """R² on both sides, their difference and the overfitting flag."""
    train = train_metrics.select("r2").scalar()
    return test_metrics.select(train.alias("train_r2"), F.col("r2").alias("test_r2")).withColumn(
        "r2_difference", F.col("train_r2") - F.col("test_r2")).withColumn(
        "overfit", F.col("r2_difference") > threshold)


def confusion(df: DataFrame, actual: str, predicted: str, classes: Sequence | None = None) -> DataFrame:
    """Count per (actual, predicted) pair, zeros included.

    The class list is what the caller gives, else the values seen (one row per
    class after combining).
    """
    counted = df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n"))
    if classes is None:
        seen = counted.select(F.explode(F.array("actual", "predicted")).alias("c")).agg(
            F.array_sort(F.collect_set("c")).alias("classes"))
        labels = seen.scalar()
        grid = seen.select(F.explode("classes").alias("actual")).select("actual", F.explode(labels).alias("predicted"))
    else:
        labels = F.array(*[F.lit(c) for c in classes])
        spark = df.sparkSession
        grid = spark.range(1).select(F.explode(labels).alias("actual")).select(
            "actual", F.explode(labels).alias("predicted"))
    return grid.join(counted, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("n", F.lit(0)).alias("count"))


def class_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class; a zero denominator gives 0."""
    counted = df.groupBy(F.col(actual).alias("_a"), F.col(predicted).alias("_p")).agg(F.count("*").alias("_n"))
    hit = F.when(F.col("_a") == F.col("_p"), F.col("_n")).otherwise(0)
    sides = counted.select(F.inline(F.array(
        F.struct(F.col("_a").alias("label"), hit.alias("tp"), F.col("_n").alias("support"), F.lit(0).cast("bigint").alias("called")),
        F.struct(F.col("_p").alias("label"), F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("support"), F.col("_n").alias("called")),
    )))
    summed = sides.groupBy("label").agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"),
                                        F.sum("called").alias("called"))

    def share(top, bottom) -> Column:
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    scored = summed.withColumns({"precision": share(F.col("tp"), F.col("called")),
                                 "recall": share(F.col("tp"), F.col("support"))})
    both = F.col("precision") + F.col("recall")
    return scored.withColumn("f1", share(2 * F.col("precision") * F.col("recall"), both)).select(
        "label", "precision", "recall", "f1", "support", "tp")


def classification_metrics(df: DataFrame, actual: str, predicted: str, confidence: str | None = None) -> DataFrame:
    """Accuracy, support-weighted and macro precision/recall/F1, and mean confidence when given."""
    report = class_report(df, actual, predicted)
    total = F.sum("support")
    figures = [(F.sum("tp") / total).alias("accuracy")]
    for m in ("precision", "recall", "f1"):
        figures.append((F.sum(F.col(m) * F.col("support")) / total).alias(m))
        figures.append(F.avg(m).alias(f"macro_{m}"))
    result = report.agg(*figures, total.alias("n"))
    if confidence is not None:
        result = result.withColumn("mean_confidence", df.agg(F.avg(confidence).alias("c")).scalar())
    return result


def _calls_of(text: Column) -> Column:
    """Struct of the text as JSON printed in one fixed order, whether it is a list of objects, and the set of names in it."""
    def figures(value: Column) -> Column:
        calls = F.try_variant_get(value, "$", "array<variant>")
        objects = F.coalesce(F.forall(calls, lambda c: F.schema_of_variant(c).startswith("OBJECT")), F.lit(False))
        names = F.transform(calls, lambda c: F.coalesce(F.to_json(F.try_variant_get(c, "$.name", "variant")), F.lit('""')))
        return F.struct(F.to_json(value).alias("printed"), objects.alias("calls"), F.array_sort(F.array_distinct(names)).alias("names"))

    return bind(json_value(text), figures)


def score_tool_calls(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Share of rows calling the same tools and share with identical calls.

    Both texts are read whole. A row with an unreadable text is left out; one
    whose texts are not both lists of objects counts as wrong. A call without a
    name has the empty name, and the last of a repeated key counts.
    """
    def verdict(two: Column) -> Column:
        t, p = two["t"], two["p"]
        same_tools = t["calls"] & p["calls"] & F.coalesce(t["names"] == p["names"], F.lit(False))
        return F.struct((t["printed"].isNotNull() & p["printed"].isNotNull()).alias("readable"), same_tools.alias("tools"),
                        (same_tools & (t["printed"] == p["printed"])).alias("calls"))

    two = F.struct(_calls_of(F.col(truth)).alias("t"), _calls_of(F.col(predicted)).alias("p"))
    # one verdict a row: an aggregate that mentions a text's figures several times would parse it as often
    read = df.select(F.explode(F.array(bind(two, verdict))).alias("v"))
    readable, same_tools, same_calls = F.col("v.readable"), F.col("v.tools"), F.col("v.calls")
    return read.agg(
        F.avg(F.when(readable, same_tools.cast("double"))).alias("tool_accuracy"),
        F.avg(F.when(readable, same_calls.cast("double"))).alias("exact_match"),
        F.count_if(readable).alias("total_samples"),
    )
