"""Derived weather measures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from .. import fixed_values as fx
from .numbers import as_col, round_to


def _power(base: Column, exponent: int) -> Column:
    return reduce(lambda acc, _: acc * base, range(exponent - 1), base)


def heat_index(temperature, humidity, variant: str = "full", digits: int | None = None) -> Column:
    """Apparent heat; readings under the threshold keep their temperature.

    ``variant`` picks how much of the polynomial is used. The ``full`` one is
    reported with two decimals unless ``digits`` says otherwise.
    """
    t, h = as_col(temperature), as_col(humidity)
    if digits is None and variant == "full":
        digits = 2
    terms = []
    for coefficient, t_power, h_power in fx.HEAT_INDEX_TERMS[: fx.HEAT_INDEX_VARIANTS[variant]]:
        term = F.lit(coefficient)
        if t_power:
            term = term * _power(t, t_power)
        if h_power:
            term = term * _power(h, h_power)
        terms.append(term)
    polynomial = reduce(lambda a, b: a + b, terms)
    return F.when(t < fx.HEAT_INDEX_MIN_TEMPERATURE, t).otherwise(round_to(polynomial, digits))


def wind_chill(temperature, wind, digits: int | None = None) -> Column:
    """Felt temperature in cold wind; mild or calm readings keep their temperature."""
    t, w = as_col(temperature), as_col(wind)
    w_term = F.pow(w, F.lit(fx.WIND_CHILL_EXPONENT))
    felt = (
        F.lit(fx.WIND_CHILL_BASE)
        + fx.WIND_CHILL_PER_DEGREE * t
        + (fx.WIND_CHILL_PER_WIND + fx.WIND_CHILL_PER_DEGREE_WIND * t) * w_term
    )
    unaffected = (t > fx.WIND_CHILL_MAX_TEMPERATURE) | (w < fx.WIND_CHILL_MIN_WIND)
    return F.when(unaffected, t).otherwise(round_to(felt, digits))


def dew_point(temperature, humidity, digits: int | None = None) -> Column:
    """Magnus dew point; NULL when the humidity is zero or negative."""
    t, h = as_col(temperature), as_col(humidity)
    # a non-positive humidity has no logarithm: ln() is NULL there
    gamma = fx.MAGNUS_A * t / (fx.MAGNUS_B + t) + F.ln(h / 100.0)
    return round_to(F.try_divide(fx.MAGNUS_B * gamma, fx.MAGNUS_A - gamma), digits)


def alert_level(temperature, wind) -> Column:
    """First matching level of the ladder hot, cold, windy, normal."""
    hot, cold, windy, normal = fx.ALERT_LEVELS
    t, w = as_col(temperature), as_col(wind)
    return (
        F.when(t > fx.ALERT_HOT_ABOVE, hot)
        .when(t < fx.ALERT_COLD_BELOW, cold)
        .when(w > fx.ALERT_WIND_ABOVE, windy)
        .otherwise(normal)
    )


def reading_alerts(station, temperature, wind, ts, now=None) -> Column:
    """Array of the 0 to 2 alerts one reading raises; their ids name the kind, the station and the second they are raised in."""
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    t, w = as_col(temperature), as_col(wind)
    extreme = (t > fx.EXTREME_HOT_ABOVE) | (t < fx.EXTREME_COLD_BELOW)

    def alert(prefix: str, kind: str, severity: Column, message: Column) -> Column:
        return F.struct(
            F.concat(F.lit(f"{prefix}_"), as_col(station).cast("string"), F.lit("_"), F.unix_seconds(stamp).cast("string")).alias("alert_id"),
            as_col(station).alias("station_id"),
            F.lit(kind).alias("alert_type"),
            severity.alias("severity"),
            message.alias("message"),
            as_col(ts).alias("timestamp"),
        )

    severity = F.when(F.abs(t) > fx.EXTREME_HIGH_SEVERITY_ABS, "high").otherwise("medium")
    candidates = F.array(
        F.when(extreme, alert("temp", "temperature", severity,
                              F.concat(F.lit("Extreme temperature: "), t.cast("string"), F.lit("°C")))),
        F.when(w > fx.STRONG_WIND_ABOVE, alert("wind", "wind", F.lit("high"),
                                               F.concat(F.lit("High wind speed: "), w.cast("string"), F.lit(" km/h")))),
    )
    return F.filter(candidates, lambda a: a.isNotNull())
