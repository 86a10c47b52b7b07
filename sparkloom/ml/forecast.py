"""Sensor forecasting: feature set, training, and direct and recursive 24-hour forecasts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, WindowSpec, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from .. import fixed_values as fx
from ..functions.numbers import forecast_bounds, forecast_confidence, ratio
from ..functions.timeparts import calendar_parts, with_cyclic
from ..operators.cleaning import drop_incomplete
from ..operators.order_stats import first_fraction
from ..operators.statistics import regression_metrics
from ..operators.windows import history_features, latest_n, latest_state, over_history
from ..session import materialise, scratch_path
from .models import dealt, fit_stages, forest

CALENDAR = ["hour", "day_of_week", "month", "day_of_year"]
CYCLES = [("hour", 24, "hour"), ("day_of_week", 7, "day"), ("month", 12, "month")]
DIRECT_FEATURES = [
    *CALENDAR,
    *[f"{prefix}_{part}" for _, _, prefix in CYCLES for part in ("sin", "cos")],
    *[f"temp_lag_{n}" for n in fx.LAG_STEPS],
    *[f"temp_rolling_{s}_{n}" for n in fx.ROLLING_WIDTHS for s in ("mean", "std")],
    *[f"temp_diff_{n}" for n in fx.DIFF_STEPS],
    "humidity_lag_1", "temp_humidity_ratio",
]
RECURSIVE_LAGS = [1, 2, 24]
RECURSIVE_MEANS = [3, 6, 12]
RECURSIVE_FEATURES = [*CALENDAR, *[f"temp_lag_{n}" for n in RECURSIVE_LAGS],
                      *[f"temp_rolling_mean_{n}" for n in RECURSIVE_MEANS], "humidity"]


def with_time_features(df: DataFrame, ts: str) -> DataFrame:
    out = calendar_parts(df, ts, tuple(CALENDAR))
    for column, period, prefix in CYCLES:
        out = with_cyclic(out, column, period, prefix)
    return out


def direct_features(df: DataFrame, key: str, ts: str, tie: str, temperature: str = "temperature",
                    humidity: str = "humidity", **sizing) -> DataFrame:
    """Calendar, lag, rolling, difference and humidity features per reading."""
    past = history_features(df, [key], ts, tie, temperature, fx.LAG_STEPS, fx.ROLLING_WIDTHS, fx.DIFF_STEPS,
                            second=humidity, **sizing)
    return with_time_features(past, ts).withColumn(
        "temp_humidity_ratio", ratio(temperature, humidity, fx.RATIO_EPSILON))


def recursive_features(df: DataFrame, key: str, ts: str, tie: str, temperature: str = "temperature", **sizing) -> DataFrame:
    """The smaller set whose values can be carried forward from forecast to forecast.

    Rolling means end *before* the reading, as they have to when it is forecast.
    """

    def columns(w: WindowSpec) -> dict[str, Column]:
        out = {f"temp_lag_{n}": F.lag(temperature, n).over(w) for n in RECURSIVE_LAGS}
        for n in RECURSIVE_MEANS:
            before = w.rowsBetween(-n, -1)
            out[f"temp_rolling_mean_{n}"] = F.when(F.count(temperature).over(before) == n, F.avg(temperature).over(before))
        return out

    past = over_history(df, [key], ts, tie, max([*RECURSIVE_LAGS, *RECURSIVE_MEANS]), columns, **sizing)
    return calendar_parts(past, ts, tuple(CALENDAR))


@dataclass
class SensorModel:
    stages: PipelineModel
    features: list[str]
    metrics: DataFrame


def train_sensor_model(features: DataFrame, columns: Sequence[str], ts: str, tie: str, target: str = "temperature",
                       trees: int = 100, depth: int = 10, fraction: float = 0.8, seed: int = 42) -> SensorModel:
    """Forest on the first part of the time line, error figures on both parts."""
    columns = list(columns)
    complete = drop_incomplete(features.select(ts, tie, target, *columns), [target, *columns])
    at = complete.withColumn("_at", F.unix_micros(F.col(ts).cast("timestamp")))
    marked = materialise(dealt(first_fraction(at, "_at", tie, fraction).select(
        "is_train", F.col(target).alias("label"), *columns)), "sensor-training")
    train, test = marked.where("is_train"), marked.where(~F.col("is_train"))
    stages = fit_stages(train, [
        VectorAssembler(inputCols=columns, outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True),
        forest(trees, depth, seed=seed, kind=RandomForestRegressor),
    ])
    scored = stages.transform(marked).withColumn("part", F.when(F.col("is_train"), "train").otherwise("test"))
    return SensorModel(stages, columns, regression_metrics(scored, "label", "prediction", ["part"]))


def forecast_direct(readings: DataFrame, model: SensorModel, key: str, ts: str, tie: str, hours: int = 24,
                    temperature: str = "temperature", humidity: str = "humidity") -> DataFrame:
    """One row per sensor and hour ahead: the calendar moves on, the sensor's own features stay at its latest state."""
    state = latest_state(readings, key, ts, tie, temperature, humidity, fx.LAG_STEPS, fx.ROLLING_WIDTHS,
                         fx.DEFAULT_HUMIDITY, fx.RATIO_EPSILON)
    steps = F.explode(F.sequence(F.lit(1), F.lit(hours)))
    ahead = state.withColumn("prediction_hour", steps).withColumn(
        "timestamp", F.col("last_ts") + F.make_interval(hours=F.col("prediction_hour")))
    ready = drop_incomplete(with_time_features(ahead, "timestamp"), model.features)
    return model.stages.transform(ready).select(
        key, "timestamp", F.round("prediction", 2).alias("predicted_temperature"), "prediction_hour")


def forecast_recursive(readings: DataFrame, model: SensorModel, key: str, ts: str, tie: str, days: int = 1,
                       temperature: str = "temperature", humidity: str = "humidity", min_rows: int = 24) -> DataFrame:
    """Hourly forecast per sensor where every prediction becomes history for the next.

    Only the newest readings of a sensor matter, so its state is one small row. All
    sensors take an hour together: features out of the state, the fitted stages over
    them, the prediction into the state. The state is written between hours, so no
    plan holds more than one hour and a lost executor costs one at most. Readings
    without a temperature are no history; sensors with too little get no forecast.
    """
    spark = readings.sparkSession
    span = max(min_rows, *RECURSIVE_LAGS, *RECURSIVE_MEANS)
    known = readings.where(F.col(temperature).isNotNull())
    kept = latest_n(known.select(key, ts, tie, temperature, humidity), [key], ts, tie, span, rank="_rn")
    state = kept.groupBy(key).agg(
        F.max(ts).cast("timestamp").alias("timestamp"),
        F.transform(F.array_sort(F.collect_list(F.struct((-F.col("_rn")).alias("o"), F.col(temperature).alias("v")))),
                    lambda r: r["v"].cast("double")).alias("temps"),
        F.coalesce(F.max(F.when(F.col("_rn") == 1, F.col(humidity))), F.lit(fx.DEFAULT_HUMIDITY)).alias("humidity"),
    ).where(F.size("temps") >= span)
    state = materialise(state, "forecast-state")

    def newest(n: int) -> Column:
        return F.slice("temps", -n, n)

    past = {f"temp_lag_{n}": F.element_at("temps", -n) for n in RECURSIVE_LAGS}
    past |= {f"temp_rolling_mean_{n}": F.aggregate(newest(n), F.lit(0.0), lambda a, v: a + v) / n for n in RECURSIVE_MEANS}
    carried = StructType([*state.schema.fields, StructField("raw", DoubleType())])
    path = scratch_path(spark, "forecast")
    for hour in range(days * 24):
        ahead = state.select(key, (F.col("timestamp") + F.make_interval(hours=F.lit(1))).alias("timestamp"),
                             "temps", "humidity").withColumns(past)
        made = model.stages.transform(calendar_parts(ahead, "timestamp", tuple(CALENDAR)))
        made.select(key, "timestamp", F.concat(F.slice("temps", 2, span - 1), F.array("prediction")).alias("temps"),
                    "humidity", F.col("prediction").alias("raw")).write.parquet(f"{path}/hour={hour}")
        state = spark.read.schema(carried).parquet(f"{path}/hour={hour}")

    points = spark.read.schema(StructType([*carried.fields, StructField("hour", IntegerType())])).parquet(path)
    points = points.withColumn("day", F.floor(F.col("hour") / 24).cast("int"))
    low, high = forecast_bounds("raw", "day")
    return points.select(key, "timestamp", F.round("raw", 2).alias("temperature"), low.alias("min_temperature"),
                         high.alias("max_temperature"), forecast_confidence("day").alias("confidence"))


def overall_confidence(forecast: DataFrame, key: str) -> DataFrame:
    return forecast.groupBy(key).agg(F.round(F.avg("confidence"), 2).alias("confidence"), F.count("*").alias("points"))
