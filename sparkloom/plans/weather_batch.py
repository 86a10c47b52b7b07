"""Weather batch job: validate, enrich, aggregate, store, measure."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fx
from ..functions.timeparts import calendar_parts, parse_ts, with_constants
from ..functions.weather import dew_point, heat_index, wind_chill
from ..operators.aggregates import rollup_readings
from ..operators.cleaning import apply_mapping, within_bounds
from ..session import materialise
from ..sinks.lake import AGGREGATE_KEYS, FACT_KEYS, write_lake
from ..sinks.tables import record_metrics

MAPPING = fx.READING_MAPPING


def is_plausible():
    return within_bounds(fx.READING_BOUNDS, fx.READING_KEYS)


def with_time(raw: DataFrame) -> DataFrame:
    """The raw layer may hold its timestamps as text."""
    if dict(raw.dtypes)["timestamp"] == "string":
        return raw.withColumn("timestamp", parse_ts("timestamp"))
    return raw


def processed(raw: DataFrame, now=None) -> DataFrame:
    """Processed layer: plausible readings with derived measures, constants and calendar columns."""
    mapped = apply_mapping(with_time(raw).where(is_plausible()), MAPPING)
    derived = mapped.withColumns({
        "heat_index_celsius": heat_index("temperature_celsius", "humidity_percent", "batch"),
        "wind_chill_celsius": wind_chill("temperature_celsius", "wind_speed_kmh"),
        "dew_point_celsius": dew_point("temperature_celsius", "humidity_percent"),
    })
    return calendar_parts(with_constants(derived, now, data_quality_score=100.0), "measurement_time")


def aggregated(facts: DataFrame, now=None) -> DataFrame:
    """Aggregated layer: hourly and daily station figures."""
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return rollup_readings(facts).withColumn("created_at", stamp)


def rolled_up(raw: DataFrame) -> DataFrame:
    """Station figures of all readings, plausible ones and others apart (``_valid``), stored for this run alone."""
    marked = apply_mapping(with_time(raw).withColumn("_valid", is_plausible()), [*MAPPING, ("_valid", "boolean", "_valid", "boolean")])
    dated = calendar_parts(marked.withColumn("data_quality_score", F.lit(100.0)), "measurement_time")
    return materialise(rollup_readings(dated, by=("_valid",)), "rolled-up")


def weather_batch(raw: DataFrame, out: str, now: str | None = None, mode: str = "append") -> dict[str, float]:
    """Write both layers under ``out`` and record the run.

    The source is read twice, for the facts and for the figures, the second time
    only its few columns. The figures are made of all readings, those that are not
    plausible in groups of their own, and stored for this run: its counts come
    from there, whatever other runs have written.
    """
    spark = raw.sparkSession
    now = now or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    write_lake(processed(raw, now), f"{out}/processed", FACT_KEYS, mode=mode)
    figures = rolled_up(raw)
    created = figures.where("_valid").drop("_valid").withColumn("created_at", F.lit(now).cast("timestamp"))
    write_lake(created, f"{out}/aggregated", AGGREGATE_KEYS, mode=mode)
    counted = figures.where("aggregation_level = 'daily'").agg(
        F.sum("measurement_count").alias("total"), F.sum(F.when(F.col("_valid"), F.col("measurement_count"))).alias("valid")).first()
    total, valid = counted.total or 0, counted.valid or 0
    metrics = {"records": total, "valid_records": valid, "quality_score": valid * 100.0 / total if total else 0.0}
    record_metrics(spark, f"{out}/metrics", "weather_batch", metrics, now)
    return metrics
