"""Tabular profile: everything a first look at a table needs, as one long frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators import aggregates, statistics as st, validation

SHAPE = ("section", "item", "statistic", "value")


def _long(df: DataFrame, section: str, item, statistics: Sequence[str]) -> DataFrame:
    cells = F.inline(F.array(*[F.struct(F.lit(s).alias("statistic"), F.col(s).cast("double").alias("value"))
                               for s in statistics]))
    return df.select(F.lit(section).alias("section"), item.cast("string").alias("item"), cells)


def profile(df: DataFrame, numeric: Sequence[str], category: str, target: str, bins: int = 20) -> DataFrame:
    """Summary, quartiles, gaps, category shares, correlations, histogram and box figures of the target."""
    sections = [
        _long(st.describe(df, numeric), "summary", F.col("column_name"),
              ["count", "mean", "std", "min", "q1", "median", "q3", "max"]),
        _long(validation.missing_profile(df, [category, *numeric]), "missing", F.col("column_name"),
              ["missing", "missing_pct"]),
        _long(aggregates.value_counts(df, category), "category", F.col(category), ["count", "percentage"]),
        _long(st.corr_matrix(df, numeric), "correlation", F.concat_ws(" ~ ", "x", "y"), ["corr"]),
        _long(st.histogram(df, target, bins), "histogram", F.col("bin"), ["bin_start", "bin_end", "count"]),
        _long(st.box_stats(df, category, target), "box", F.col(category), ["min", "q1", "median", "q3", "max"]),
    ]
    out = sections[0]
    for section in sections[1:]:
        out = out.unionByName(section)
    return out
