"""Timestamps: parsing, calendar parts, cyclic encodings, formatted keys."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .numbers import as_col


def parse_ts(c, default=None) -> Column:
    """ISO-8601 text (``Z`` or offset suffix allowed) to timestamp; unreadable or missing gives ``default``."""
    parsed = F.try_to_timestamp(as_col(c).cast("string"))
    return parsed if default is None else F.coalesce(parsed, default if isinstance(default, Column) else F.lit(default))


def calendar_parts(df: DataFrame, ts: str, parts=("year", "month", "day", "hour")) -> DataFrame:
    """Add integer calendar columns; ``day_of_week`` counts from Monday = 0."""
    makers = {
        "year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour,
        "day_of_week": F.weekday, "day_of_year": F.dayofyear,
    }
    return df.withColumns({part: makers[part](F.col(ts)) for part in parts})


def cyclic(c, period: float) -> tuple[Column, Column]:
    """Sine and cosine of the position within the period."""
    angle = as_col(c) * (2 * math.pi) / period
    return F.sin(angle), F.cos(angle)


def with_cyclic(df: DataFrame, column: str, period: float, prefix: str) -> DataFrame:
    sine, cosine = cyclic(column, period)
    return df.withColumns({f"{prefix}_sin": sine, f"{prefix}_cos": cosine})


def make_id(prefix: str, ts) -> Column:
    """``<prefix>_yyyyMMdd_HHmmss``"""
    return F.concat(F.lit(f"{prefix}_"), F.date_format(as_col(ts), "yyyyMMdd_HHmmss"))


def date_keys(df: DataFrame, ts: str) -> DataFrame:
    """Zero-padded text partition keys."""
    return df.withColumns({
        "year": F.date_format(F.col(ts), "yyyy"),
        "month": F.date_format(F.col(ts), "MM"),
        "day": F.date_format(F.col(ts), "dd"),
    })


def interval_col(hours: float) -> Column:
    return F.make_interval(hours=F.lit(int(hours))) if float(hours).is_integer() else F.make_dt_interval(
        secs=F.lit(float(hours) * 3600))


def with_constants(df: DataFrame, now=None, **constants) -> DataFrame:
    """Add a processing time and constant columns; ``None`` values become NULL strings unless a Column is given."""
    stamp = F.current_timestamp() if now is None else (now if isinstance(now, Column) else F.lit(now).cast("timestamp"))
    columns = {"processing_timestamp": stamp}
    for name, value in constants.items():
        columns[name] = value if isinstance(value, Column) else F.lit(value)
    return df.withColumns(columns)
