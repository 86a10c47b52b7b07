"""Sensor forecasting job: features, training on the earlier part, forecast per sensor."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..ml import forecast as fc
from ..ml.models import save_model, trainable


def sensor_forecast(readings: DataFrame, key: str, ts: str, tie: str, horizon_days: int = 1, recursive: bool = False,
                    trees: int = 100, depth: int = 10, min_rows: int = 50, model_path: str | None = None
                    ) -> tuple[DataFrame, DataFrame]:
    """Forecast rows and error figures; sensors with too little history neither train nor get a forecast."""
    enough = trainable(readings, key, F.col("temperature").isNotNull(), min_rows).where("trainable").select(key)
    usable = readings.join(enough, key, "left_semi")
    make = fc.recursive_features if recursive else fc.direct_features
    columns = fc.RECURSIVE_FEATURES if recursive else fc.DIRECT_FEATURES
    model = fc.train_sensor_model(make(usable, key, ts, tie), columns, ts, tie, trees=trees, depth=depth)
    if model_path:
        save_model(model.stages, model_path)
    if recursive:
        return fc.forecast_recursive(usable, model, key, ts, tie, days=horizon_days), model.metrics
    return fc.forecast_direct(usable, model, key, ts, tie, hours=24 * horizon_days), model.metrics
