"""Grouped and global aggregates, all map-side combined."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import fixed_values as fx
from ..functions.numbers import is_error
from .cleaning import last_hours


def count_per_key(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    """Rows per non-NULL key, largest first, key as tie-break."""
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(name))
            .orderBy(F.desc(name), F.asc(key)))


def max_where(df: DataFrame, column: str, condition: Column, name: str) -> DataFrame:
    return df.where(condition).agg(F.max(column).alias(name))


def avg_and_count(df: DataFrame, key: str, column: str, avg_name: str, count_name: str) -> DataFrame:
    return (df.groupBy(key).agg(F.avg(column).alias(avg_name), F.count("*").alias(count_name))
            .orderBy(F.desc(avg_name), F.asc(key)))


def multi_agg(df: DataFrame, key: str, spec: Mapping[str, str]) -> DataFrame:
    """One aggregate per column, named ``<function>_<column>``."""
    return df.groupBy(key).agg(*[F.expr(f"{fn}(`{c}`)").alias(f"{fn}_{c}") for c, fn in spec.items()])


def ratio_where(df: DataFrame, key: str, condition: Column, name: str = "ratio", scale: float = 1.0) -> DataFrame:
    return df.groupBy(key).agg((F.count_if(condition) * scale / F.count("*")).alias(name))


#: figures reported per station; each comes out as ``<function>_<measure>``
STATION_FIGURES = {
    "temperature": ("avg", "min", "max"),
    "humidity": ("avg",),
    "pressure": ("avg",),
    "wind_speed": ("avg", "max"),
}
#: the measures as the processed layer calls them
PROCESSED_NAMES = {"temperature": "temperature_celsius", "humidity": "humidity_percent", "pressure": "pressure_hpa",
                   "wind_speed": "wind_speed_kmh"}


def station_figures(names: Mapping[str, str] | None = None) -> list[Column]:
    """Aggregates of ``STATION_FIGURES`` and the number of readings; ``names`` maps measures to columns."""
    names = names or {}
    figures = [getattr(F, function)(names.get(measure, measure)).alias(f"{function}_{measure}")
               for measure, functions in STATION_FIGURES.items() for function in functions]
    return [*figures, F.count("*").alias("measurement_count")]


def rollup_readings(df: DataFrame, station: str = "station_id", by: Sequence[str] = ()) -> DataFrame:
    """Hourly and daily station rollups out of one scan and one shuffle (grouping sets), apart by the columns ``by``.

    Daily rows carry a NULL hour; ``aggregation_level`` tells the two apart.
    """
    daily = [F.col(c) for c in (station, "year", "month", "day", *by)]
    hourly = [*daily, F.col("hour")]
    return (df.groupingSets([hourly, daily], *hourly)
            .agg(*station_figures(PROCESSED_NAMES), F.avg("data_quality_score").alias("avg_data_quality"),
                 F.grouping("hour").alias("_daily"))
            .withColumn("aggregation_level", F.when(F.col("_daily") == 1, "daily").otherwise("hourly"))
            .drop("_daily"))


def bucket_stats(df: DataFrame, key: str, ts: str, width: str = "1 hour",
                 temperature: str = "temperature", humidity: str = "humidity") -> DataFrame:
    """Per sensor and time bucket: temperature mean/min/max/sample deviation, humidity mean/min/max, two decimals."""
    stats = {"mean": F.avg, "min": F.min, "max": F.max}
    measures = [F.round(fn(temperature), 2).alias(f"temperature_{s}") for s, fn in stats.items()]
    measures.append(F.round(F.stddev_samp(temperature), 2).alias("temperature_std"))
    measures += [F.round(fn(humidity), 2).alias(f"humidity_{s}") for s, fn in stats.items()]
    return (df.groupBy(key, F.window(ts, width).alias("_w")).agg(*measures)
            .withColumn("bucket", F.col("_w.start")).drop("_w"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage per value, largest first."""
    counted = df.groupBy(column).agg(F.count("*").alias("count"))
    total = counted.agg(F.sum("count").alias("n")).scalar()
    return (counted.withColumn("percentage", F.col("count") * 100.0 / total)
            .orderBy(F.desc("count"), F.asc(column)))


def n_distinct(df: DataFrame, column: str, name: str = "n_distinct") -> DataFrame:
    return df.agg(F.count_distinct(column).alias(name))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def latest_per_key(df: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """The newest whole record per key; rows beyond the first of a key are dropped in every map task before the shuffle."""
    order = Window.partitionBy(key).orderBy(F.desc_nulls_last(ts), F.desc_nulls_last(tie))
    return df.withColumn("_n", F.row_number().over(order)).where("_n <= 1").drop("_n")


def avg_of_latest(df: DataFrame, key: str, ts: str, tie: str, cols: Sequence[str]) -> DataFrame:
    """Mean of each measure over the newest record of every key, a missing measure counting as 0."""
    latest = latest_per_key(df.select(key, ts, tie, *cols), key, ts, tie)
    return latest.agg(F.count("*").alias("stations"), *[F.avg(F.coalesce(F.col(c), F.lit(0.0))).alias(f"avg_{c}") for c in cols])


def avg_since(df: DataFrame, key: str, column: str, ts: str, as_of, hours: int) -> DataFrame:
    """Per-key average over the last hours, missing values skipped."""
    recent = last_hours(df, ts, hours, as_of).where(F.col(column).isNotNull())
    return recent.groupBy(key).agg(F.avg(column).alias(f"avg_{column}"))


def sensor_stats(df: DataFrame, key: str, column: str, ts: str, tie: str) -> DataFrame:
    """Points, rounded average, extremes and newest value per sensor."""
    return df.groupBy(key).agg(
        F.count("*").alias("data_points"),
        F.round(F.avg(column), 2).alias(f"average_{column}"),
        F.min(column).alias(f"min_{column}"),
        F.max(column).alias(f"max_{column}"),
        F.max_by(column, F.struct(F.col(ts), F.col(tie))).alias(f"latest_{column}"),
    )


def dataset_summary(df: DataFrame, key: str, column: str, ts: str) -> DataFrame:
    """Totals of a whole data set; an empty one gives zeros and no timestamp."""
    return df.agg(
        F.count("*").alias("total_measurements"),
        F.count_distinct(key).alias("station_count"),
        F.coalesce(F.min(column), F.lit(0.0)).alias(f"min_{column}"),
        F.coalesce(F.max(column), F.lit(0.0)).alias(f"max_{column}"),
        F.coalesce(F.avg(column), F.lit(0.0)).alias(f"avg_{column}"),
        F.max(ts).alias("latest_measurement"),
    )


def collect_values(df: DataFrame, key: Sequence[str], column: str, name: str = "values") -> DataFrame:
    """All values of a group as a sorted ``array<struct<value, n>>``.

    A repeated value is held once with its count, so nothing is lost and a hot
    group is combined before it reaches its task.
    """
    key = list(key)
    counted = df.groupBy(*key, F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return counted.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("value", "n"))).alias(name))


def usage_rollup(df: DataFrame, day: str, service: str, cost: str, usage: str) -> DataFrame:
    """Cost and usage per day and service."""
    return df.groupBy(F.to_date(day).alias("day"), service).agg(
        F.sum(cost).alias("cost"), F.sum(usage).alias("usage"))


def usage_total(daily: DataFrame, period_days: int) -> DataFrame:
    """Total cost and its average over the days of the period (not the days that have data)."""
    total = F.coalesce(F.sum("cost"), F.lit(0.0))
    average = total / period_days if period_days > 0 else F.lit(0.0)
    return daily.agg(total.alias("total_cost"), average.alias("average_daily_cost"),
                     F.count_distinct("day").alias("days_with_data"))


def endpoint_report(df: DataFrame, key: str, latency: str, invocations: Column, errors: Column) -> DataFrame:
    """Invocations, mean latency, errors and error rate per endpoint."""
    invoked, failed = F.sum(invocations), F.sum(errors)
    rate = F.when(invoked > 0, failed / invoked * 100).otherwise(F.lit(0.0))
    return df.groupBy(key).agg(
        invoked.cast("bigint").alias("total_invocations"),
        F.round(F.coalesce(F.avg(latency), F.lit(0.0)), 2).alias("average_latency_ms"),
        failed.cast("bigint").alias("total_errors"),
        F.round(rate, 2).alias("error_rate"),
    )


def job_stats(df: DataFrame, status: str, completed: str = "Completed", failed: str = "Failed",
              running: str = "InProgress") -> DataFrame:
    """Counts per status with success rate and the failure-rate flag."""
    counted = df.agg(
        F.count("*").alias("total_jobs"),
        F.count_if(F.col(status) == completed).alias("completed_jobs"),
        F.count_if(F.col(status) == failed).alias("failed_jobs"),
        F.count_if(F.col(status) == running).alias("running_jobs"),
    )
    total = F.col("total_jobs")
    return counted.withColumns({
        "success_rate": F.coalesce(F.try_divide(F.col("completed_jobs") * 100.0, total), F.lit(0.0)),
        "failure_rate": F.coalesce(F.try_divide(F.col("failed_jobs").cast("double"), total), F.lit(0.0)),
    }).withColumn("high_failure_rate", F.col("failure_rate") > fx.COST_FAILURE_RATE_ABOVE)


def window_request_metrics(df: DataFrame, ts: str, path: str, latency: str, status: str, width: str) -> DataFrame:
    """Requests, mean processing time and error rate per path and tumbling window (batch or stream)."""
    return (df.groupBy(F.window(ts, width).alias("_w"), F.col(path).alias("endpoint"))
            .agg(F.count("*").alias("request_count"),
                 F.avg(latency).alias("avg_processing_time"),
                 (F.count_if(is_error(status)) * 100.0 / F.count("*")).alias("error_rate"))
            .withColumns({"window_start": F.col("_w.start"), "window_end": F.col("_w.end")}).drop("_w"))


