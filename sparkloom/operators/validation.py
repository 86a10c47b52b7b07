"""Record validation with reasons, counters and the valid/rejected split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fx


@dataclass(frozen=True)
class Rule:
    """``broken`` may evaluate to NULL, which counts as not broken."""

    broken: Column
    message: Column
    severity: str = "error"


def _text(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _out_of_range(column: str, label: str, unit: str, lo: float, hi: float, shown: str | None = None) -> Rule:
    value = F.col(column)
    shown = shown or f"[{lo}, {hi}]"
    return Rule((value < lo) | (value > hi),
                F.concat(F.lit(f"{label} "), value.cast("string"), F.lit(f"{unit} out of range {shown}")))


def reading_rules() -> list[Rule]:
    bounds = fx.READING_BOUNDS
    wind_max = bounds["wind_speed"][1]
    return [
        _out_of_range("temperature", "Temperature", "°C", *bounds["temperature"]),
        _out_of_range("humidity", "Humidity", "%", *bounds["humidity"]),
        _out_of_range("pressure", "Pressure", " hPa", *bounds["pressure"]),
        Rule(F.col("wind_speed") > wind_max,
             F.concat(F.lit("Wind speed "), F.col("wind_speed").cast("string"),
                      F.lit(f" km/h exceeds maximum {wind_max}"))),
        _out_of_range("wind_direction", "Wind direction", "°", *bounds["wind_direction"], shown="[0, 360]"),
        Rule((F.abs("temperature") < fx.SUSPICIOUS_BELOW) & (F.abs("humidity") < fx.SUSPICIOUS_BELOW),
             F.lit(fx.SUSPICIOUS_MESSAGE), "warning"),
    ]


def measurement_rules(with_location: bool = True) -> list[Rule]:
    """Constraints of the nested measurement: missing readings pass, missing keys do not."""
    say = {name: F.lit(text) for name, text in fx.MEASUREMENT_MESSAGES.items()}
    c = F.col
    rules = [
        Rule(c("station_id").isNull(), say["station_id"]),
        Rule(c("timestamp").isNull(), say["timestamp"]),
        Rule(c("temperature") < -100, say["temperature_min"]),
        Rule(c("temperature") > 100, say["temperature_max"]),
        Rule(c("humidity") < 0, say["humidity_min"]),
        Rule(c("humidity") > 100, say["humidity_max"]),
        Rule(c("pressure") < 800, say["pressure_min"]),
        Rule(c("pressure") > 1200, say["pressure_max"]),
        Rule(c("wind_speed") < 0, say["wind_speed_min"]),
        Rule(c("wind_direction") < 0, say["wind_direction_min"]),
        Rule(c("wind_direction") > 360, say["wind_direction_max"]),
    ]
    if with_location:
        given = c("location").isNotNull()
        for field, limit in (("latitude", 90), ("longitude", 180)):
            value = c(f"location.{field}")
            rules.append(Rule(given & value.isNull(), say[field]))
            rules.append(Rule(F.abs(value) > limit, say[f"{field}_range"]))
    return rules


def sensor_rules(range_severity: str = "error") -> list[Rule]:
    temperature = F.col("temperature")
    return [
        Rule(F.col("sensor_id").isNull() | (F.trim("sensor_id") == ""), F.lit(fx.SENSOR_ID_MESSAGE)),
        Rule(temperature.isNull(), F.lit(fx.SENSOR_NULL_MESSAGE)),
        Rule(F.abs(temperature) > fx.SENSOR_TEMPERATURE_LIMIT,
             F.concat(F.lit(fx.SENSOR_RANGE_MESSAGE), temperature.cast("string")), range_severity),
    ]


def fish_rules(species: str = "species", measures: Sequence[str] = tuple(fx.FISH_MEASURES)) -> list[Rule]:
    rules = [Rule(~F.coalesce(F.col(species).isin(fx.FISH_SPECIES), F.lit(False)),
                  F.lit(f"{fx.FISH_SPECIES_MESSAGE}{fx.FISH_SPECIES}"))]
    for m in measures:
        rules.append(Rule(F.col(m).isNull() | (F.col(m) <= 0), F.lit(fx.FISH_POSITIVE_MESSAGE)))
        rules.append(Rule(F.col(m) > fx.FISH_MAX_MEASURE, F.lit(fx.FISH_UNREALISTIC_MESSAGE)))
    return rules


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``errors`` and ``warnings`` (text arrays) and ``is_valid`` in one projection."""

    def messages(severity: str) -> Column:
        hits = [F.when(r.broken, _text(r.message)) for r in rules if r.severity == severity]
        if not hits:
            return F.array().cast("array<string>")
        return F.filter(F.array(*hits), lambda m: m.isNotNull())

    return df.withColumns({"errors": messages("error"), "warnings": messages("warning")}).withColumn(
        "is_valid", F.size("errors") == 0)


def joined_errors(separator: str = ", ") -> Column:
    return F.array_join("errors", separator)


def split_valid(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The valid rows without their annotations, and the rejected rows with their reasons."""
    valid = annotated.where("is_valid").drop("errors", "warnings", "is_valid")
    rejected = annotated.where(~F.col("is_valid")).drop("is_valid")
    return valid, rejected


def validation_counts(annotated: DataFrame, parsed: Column | None = None) -> DataFrame:
    """Received, valid and invalid counts; rows that could not be parsed count as invalid."""
    good = F.col("is_valid") if parsed is None else F.col("is_valid") & F.coalesce(parsed, F.lit(False))
    return annotated.agg(
        F.count("*").alias("received"),
        F.count_if(good).alias("valid"),
        F.count_if(~F.coalesce(good, F.lit(False))).alias("invalid"),
    )


def quality_score(df: DataFrame, valid: Column) -> DataFrame:
    """Share of valid rows in percent, 0 for an empty frame, with its alarm flag."""
    score = F.coalesce(F.try_divide(F.count_if(valid) * 100.0, F.count("*")), F.lit(0.0))
    return df.agg(F.count("*").alias("total"), F.count_if(valid).alias("valid"), score.alias("quality_score")) \
             .withColumn("below_target", F.col("quality_score") < 95.0)


def check_dataset(df: DataFrame, required: Sequence[str], max_missing_pct: float = 50.0) -> DataFrame:
    """Missing count and share per required column with a verdict; absent columns fail at once."""
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"missing required columns: {', '.join(absent)}")
    profile = missing_profile(df, required)
    verdict = (F.when(F.col("total") == 0, "empty")
               .when(F.col("missing_pct") > max_missing_pct, "mostly missing").otherwise("ok"))
    return profile.withColumn("verdict", verdict)


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Number and percentage of NULLs per column, in one pass."""
    cols = list(cols or df.columns)
    counted = df.agg(F.count("*").alias("total"),
                     *[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)])
    long = counted.select("total", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_m{i}").alias("missing")) for i, c in enumerate(cols)])))
    share = F.coalesce(F.try_divide(F.col("missing") * 100.0, F.col("total")), F.lit(0.0))
    return long.select("column_name", "total", "missing", share.alias("missing_pct"))
