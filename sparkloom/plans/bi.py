"""Data sets for business-intelligence tools."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.numbers import absolute_error, percent_error
from ..operators.cleaning import fill_const
from ..sinks.lake import export_bi


def prepare_facts(df: DataFrame, source: str, now=None) -> DataFrame:
    """Numbers as doubles with gaps filled by 0, plus update time and source."""
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    numbers = df.withColumns({c: F.col(c).try_cast("double") for c in numeric})
    return fill_const(numbers, 0, numeric).withColumns({"last_updated": stamp, "data_source": F.lit(source)})


def prepare_predictions(df: DataFrame, actual: str, predicted: str, now=None) -> DataFrame:
    """Predictions with their errors and update time."""
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return df.withColumns({"prediction_error": absolute_error(actual, predicted),
                           "prediction_error_pct": percent_error(actual, predicted), "last_updated": stamp})


def bi_datasets(facts: DataFrame, predictions: DataFrame, metrics: DataFrame, out: str, source: str, actual: str,
                predicted: str, now=None) -> DataFrame:
    """Export the three data sets; returns row counts and export time."""
    return export_bi({"facts": prepare_facts(facts, source, now),
                      "predictions": prepare_predictions(predictions, actual, predicted, now),
                      "metrics": metrics}, out, now)
