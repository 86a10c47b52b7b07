"""Weather streaming job: late-data limit, enrichment, raw sink and windowed sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..schemas import READINGS
from ..sources.streams import parse_data_column
from ..streaming.run import TRIGGER, fan_out
from ..streaming.windows import enrich_stream, window_stats, with_lateness


def parse_readings(messages: DataFrame, data: str = "data") -> DataFrame:
    return parse_data_column(messages, READINGS, data)


def weather_stream(readings: DataFrame, out: str, checkpoint: str, delay: str = "2 minutes", width: str = "10 minutes",
                   trigger: str | None = TRIGGER, keys=("station_id",), now=None) -> list[StreamingQuery]:
    """Start both queries; wait for them with ``streaming.run.await_all``."""
    enriched = enrich_stream(with_lateness(readings, "timestamp", delay), now)
    return fan_out({"enriched": (enriched, keys), "windows": (window_stats(enriched, width=width), ())},
                   out, checkpoint, trigger)
