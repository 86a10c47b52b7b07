"""Topic and payload envelopes of device messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.documents import json_field, rest_as_map, topic_part
from ..functions.timeparts import parse_ts

#: payload keys that have a column of their own
RECORD_FIELDS = ["temperature", "humidity", "pressure", "wind_speed", "wind_direction", "latitude", "longitude"]


def parse_envelope(df: DataFrame, topic: str = "topic", payload: str = "payload", position: int = 1,
                   now=None) -> DataFrame:
    """Sensor readings: id from the topic, aliases ``temp``/``hum``, defaults for what is missing."""
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")

    def number(name: str, alias: str):
        return F.coalesce(json_field(payload, name, "double"), json_field(payload, alias, "double"), F.lit(0.0))

    return df.select(
        topic_part(topic, position).alias("sensor_id"),
        number("temperature", "temp").alias("temperature"),
        number("humidity", "hum").alias("humidity"),
        json_field(payload, "location", "string", "unknown").alias("location"),
        parse_ts(json_field(payload, "timestamp", "string"), stamp).alias("timestamp"),
    )


def parse_record(df: DataFrame, topic: str = "topic", payload: str = "payload", now=None) -> DataFrame:
    """Weather records: station from the last but one topic part, 0.0 for missing readings, the rest as metadata."""
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return df.select(
        topic_part(topic, -2).alias("station_id"),
        *[json_field(payload, name, "double", 0.0).alias(name) for name in RECORD_FIELDS],
        parse_ts(json_field(payload, "timestamp", "string"), stamp).alias("timestamp"),
        rest_as_map(payload, [*RECORD_FIELDS, "timestamp"]).alias("metadata"),
    )


def parse_payload(df: DataFrame, payload: str = "payload", topic: str = "topic", now=None) -> DataFrame:
    """Sensor payload that is JSON or a plain number; anything else is dropped.

    A plain number takes its id from the last part of a topic with more than two parts.
    """
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    body = F.from_json(F.col(payload), "sensor_id string, temperature double, humidity double, timestamp string")
    is_object = F.trim(payload).startswith("{") & F.try_parse_json(F.col(payload)).isNotNull()
    number = F.trim(payload).try_cast("double")
    last = F.regexp_replace(topic_part(topic, -1), r"\+", "default")
    named = F.when(F.size(F.split(topic, "/")) > 2, last).otherwise("unknown")
    read = df.withColumns({"_json": F.coalesce(is_object, F.lit(False)), "_body": body, "_number": number})
    return read.where(F.col("_json") | F.col("_number").isNotNull()).select(
        F.when(F.col("_json"), F.col("_body.sensor_id")).otherwise(named).alias("sensor_id"),
        F.when(F.col("_json"), F.col("_body.temperature")).otherwise(F.col("_number")).alias("temperature"),
        F.when(F.col("_json"), F.col("_body.humidity")).alias("humidity"),
        F.when(F.col("_json"), parse_ts(F.col("_body.timestamp"), stamp)).otherwise(stamp).alias("timestamp"),
    )
