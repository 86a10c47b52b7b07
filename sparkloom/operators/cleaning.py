"""Filters, projections and filling of missing values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import fixed_values as fx
from ..functions.text import length_ok
from .attach import attach
from .order_stats import percentiles


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.where(_all([F.col(c).isNotNull() for c in cols]))


def where_equal(df: DataFrame, column: str, value, keep: Sequence[str] | None = None) -> DataFrame:
    kept = df.where(F.col(column) == F.lit(value))
    return kept.select(*keep) if keep else kept


def where_range(df: DataFrame, column: str, lo=None, hi=None) -> DataFrame:
    """Half-open range ``lo <= column < hi``; an end that is None is open."""
    conditions = []
    if lo is not None:
        conditions.append(F.col(column) >= F.lit(lo))
    if hi is not None:
        conditions.append(F.col(column) < F.lit(hi))
    return df.where(_all(conditions)) if conditions else df


def where_all(df: DataFrame, equals: Mapping[str, object]) -> DataFrame:
    return df.where(_all([F.col(c) == F.lit(v) for c, v in equals.items()]))


def within_bounds(bounds: Mapping[str, tuple[float | None, float | None]], keys: Sequence[str] = ()) -> Column:
    """Condition that every measure is inside its inclusive bounds and every key is present; never NULL."""
    conditions = [F.col(k).isNotNull() for k in keys]
    for column, (lo, hi) in bounds.items():
        if lo is not None:
            conditions.append(F.col(column) >= lo)
        if hi is not None:
            conditions.append(F.col(column) <= hi)
    return F.coalesce(_all(conditions), F.lit(False))


def valid_readings(df: DataFrame, bounds=fx.READING_BOUNDS, keys=fx.READING_KEYS) -> DataFrame:
    return df.where(within_bounds(bounds, keys))


def apply_mapping(df: DataFrame, mapping: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Project, rename and cast ``(source, source type, target, target type)``; values that do not cast become NULL."""
    projected = []
    for source, source_type, target, target_type in mapping:
        value = F.col(source)
        projected.append((value if source_type == target_type else value.try_cast(target_type)).alias(target))
    return df.select(*projected)


def flatten(df: DataFrame, struct_col: str) -> DataFrame:
    return df.select(f"{struct_col}.*")


def between_times(df: DataFrame, ts: str, start=None, end=None, closed: bool = True) -> DataFrame:
    """Rows between two instants; both ends included when ``closed``, both excluded otherwise; ends optional."""
    conditions = []
    if start is not None:
        edge = F.lit(start).cast("timestamp")
        conditions.append(F.col(ts) >= edge if closed else F.col(ts) > edge)
    if end is not None:
        edge = F.lit(end).cast("timestamp")
        conditions.append(F.col(ts) <= edge if closed else F.col(ts) < edge)
    return df.where(_all(conditions)) if conditions else df


def last_hours(df: DataFrame, ts: str, hours: int, as_of) -> DataFrame:
    """Rows after ``as_of - hours``."""
    edge = F.lit(as_of).cast("timestamp") - F.make_interval(hours=F.lit(hours))
    return df.where(F.col(ts) > edge)


def _missing(df: DataFrame, column: str) -> Column:
    condition = F.col(column).isNull()
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        condition = condition | F.isnan(column)
    return condition


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows where any of the columns is NULL or not a number."""
    return df.where(_all([~_missing(df, c) for c in (cols or df.columns)]))


def fill_const(df: DataFrame, value, cols: Sequence[str] | None = None) -> DataFrame:
    return df.na.fill(value, subset=list(cols) if cols else None)


def fill_mean(df: DataFrame, cols: Sequence[str], key: Sequence[str] = ()) -> DataFrame:
    """Replace missing values by the column's mean, over the frame or per key."""
    present = {c: F.when(~_missing(df, c), F.col(c)) for c in cols}
    means = df.groupBy(*key).agg(*[F.avg(present[c]).alias(c) for c in cols])
    filled = attach(df, means, key, "_mean")
    return filled.withColumns({c: F.coalesce(present[c], F.col(f"_mean.{c}")) for c in cols}).drop("_mean")


def fill_median(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """Replace missing values by the column's median."""
    present = {c: F.when(~_missing(df, c), F.col(c)) for c in cols}
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("name"), present[c].cast("double").alias("value")) for c in cols])))
    medians = percentiles(long, "value", [0.5], key=["name"], exact=exact)
    # one row per column name: a frame as small as the column list
    packed = medians.agg(F.map_from_entries(F.collect_list(F.struct("name", "p_0"))).alias("m"))
    filled = attach(df, packed, [], "_median")
    return filled.withColumns({
        c: F.coalesce(present[c], F.try_element_at(F.col("_median.m"), F.lit(c))) for c in cols}).drop("_median")


def to_number(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Lenient cast to double: text that is no number becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols})


def normalise_fields(df: DataFrame, aliases: Mapping[str, Sequence[str]], defaults: Mapping[str, object],
                     now=None, ts: str | None = None) -> DataFrame:
    """First present alias wins, then the default; a missing timestamp becomes ``now``."""
    present = set(df.columns)
    out = {}
    for target in {**{t: None for t in aliases}, **{t: None for t in defaults}}:
        candidates = [F.col(c) for c in (target, *aliases.get(target, ())) if c in present]
        if target in defaults:
            candidates.append(F.lit(defaults[target]))
        out[target] = F.coalesce(*candidates)
    if ts is not None:
        out[ts] = F.coalesce(F.col(ts), F.current_timestamp() if now is None else F.lit(now).cast("timestamp"))
    return df.withColumns(out)


def text_length_ok(df: DataFrame, column: str, lo: int = fx.MIN_TEXT_CHARS, hi: int = fx.MAX_TEXT_CHARS) -> DataFrame:
    return df.where(length_ok(column, lo, hi))


def drop_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)
