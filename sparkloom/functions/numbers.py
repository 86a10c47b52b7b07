"""Arithmetic helpers: rounding, ratios, distances, error columns, ladders."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed_values as fx


def as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def round_to(c, digits: int | None, mode: str = "half_up") -> Column:
    """Round to ``digits`` (``None`` keeps the value); ``mode`` is half_up or half_even."""
    c = as_col(c)
    if digits is None:
        return c
    return F.bround(c, digits) if mode == "half_even" else F.round(c, digits)


def ratio(numerator, denominator, eps: float = 0.0) -> Column:
    """Quotient that is NULL on a zero denominator; ``eps`` is added to the denominator."""
    bottom = as_col(denominator)
    return F.try_divide(as_col(numerator), bottom + eps if eps else bottom)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance between two points given in degrees."""
    phi1, phi2 = F.radians(as_col(lat1)), F.radians(as_col(lat2))
    half_dphi = (phi2 - phi1) / 2
    half_dlambda = F.radians(as_col(lon2) - as_col(lon1)) / 2
    a = F.pow(F.sin(half_dphi), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_dlambda), 2)
    # rounding can push antipodal points a hair over 1
    a = F.least(a, F.lit(1.0))
    return 2 * fx.EARTH_RADIUS_KM * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def absolute_error(actual, predicted) -> Column:
    return F.abs(as_col(predicted) - as_col(actual))


def percent_error(actual, predicted) -> Column:
    """Absolute error as a percentage of the actual value; NULL where that is zero."""
    return F.try_divide(absolute_error(actual, predicted), as_col(actual)) * 100


def band(value, ladder=fx.R2_BANDS, otherwise: str = fx.R2_BAND_ELSE) -> Column:
    """Name of the first threshold in ``ladder`` (highest first) the value exceeds."""
    value = as_col(value)
    result = None
    for threshold, name in ladder:
        condition = value > threshold
        result = F.when(condition, name) if result is None else result.when(condition, name)
    return result.otherwise(otherwise)


def budget_pct(actual, limit) -> Column:
    limit = as_col(limit)
    return F.when(limit > 0, as_col(actual) / limit * 100).otherwise(F.lit(0.0))


def budget_status(actual, limit) -> Column:
    pct = budget_pct(actual, limit)
    return (
        F.when(pct < fx.BUDGET_WARNING_PCT, "OK")
        .when(pct < fx.BUDGET_EXCEEDED_PCT, "WARNING")
        .otherwise("EXCEEDED")
    )


def forecast_confidence(day) -> Column:
    """Confidence of a forecast ``day`` days ahead (0 = today)."""
    return F.round(F.greatest(F.lit(fx.FORECAST_MIN_CONFIDENCE), 1.0 - as_col(day) * fx.FORECAST_DECAY_PER_DAY), 2)


def forecast_bounds(predicted, day) -> tuple[Column, Column]:
    """Lower and upper bound around a prediction, widening with every day ahead."""
    half_width = fx.FORECAST_BAND_BASE + as_col(day) * fx.FORECAST_BAND_PER_DAY
    predicted = as_col(predicted)
    return F.round(predicted - half_width, 2), F.round(predicted + half_width, 2)


def is_error(status) -> Column:
    return as_col(status) >= fx.ERROR_STATUS_FROM


def delay_label(arrival_delay) -> Column:
    """1.0 for a late arrival, 0.0 otherwise (also when the delay is unknown)."""
    return F.when(as_col(arrival_delay) > fx.DELAYED_ABOVE, 1.0).otherwise(0.0)


def delay_category(arrival_delay) -> Column:
    delay = as_col(arrival_delay)
    return F.when(delay > fx.DELAYED_ABOVE, "Delayed").when(delay < fx.EARLY_BELOW, "Early").otherwise("OnTime")
