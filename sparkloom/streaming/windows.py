"""Watermarks, windowed aggregates and stateless enrichment. Every function also runs on a batch frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fx
from ..functions.weather import alert_level, heat_index
from ..operators.aggregates import station_figures, window_request_metrics
from ..operators.cleaning import valid_readings


def with_lateness(df: DataFrame, ts: str, delay: str = "2 minutes") -> DataFrame:
    """Forget windows and drop rows older than the newest event minus ``delay``."""
    return df.withWatermark(ts, delay)


def enrich_stream(df: DataFrame, now=None) -> DataFrame:
    """Keep plausible readings and add heat index, alert level and processing time."""
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return valid_readings(df, fx.STREAM_READING_BOUNDS, ("station_id",)).withColumns({
        "processing_time": stamp,
        "heat_index": heat_index("temperature", "humidity", "stream"),
        "alert_level": alert_level("temperature", "wind_speed"),
    })


def window_stats(df: DataFrame, ts: str = "timestamp", key: str = "station_id", width: str = "10 minutes",
                 slide: str | None = None, levels: Sequence[str] = fx.ALERT_LEVELS) -> DataFrame:
    """Ten-minute figures per station; ``slide`` makes the windows overlap.

    ``alerts`` holds every alert of the window as level and count, which keeps a
    busy window's state as small as a quiet one's.
    """
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    counts = F.array(*[F.struct(F.lit(level).alias("level"), F.count_if(F.col("alert_level") == level).alias("n"))
                       for level in levels])
    figures = [*station_figures(), F.filter(counts, lambda a: a["n"] > 0).alias("alerts")]
    return df.groupBy(window.alias("_w"), key).agg(*figures).withColumns(
        {"window_start": F.col("_w.start"), "window_end": F.col("_w.end")}).drop("_w")


def http_window_metrics(df: DataFrame, ts: str = "event_timestamp", width: str = "5 minutes",
                        delay: str = "5 seconds") -> DataFrame:
    """Requests, mean processing time and error rate of responses per path and window."""
    responses = df.where(F.col("event_type") == "http_response")
    if delay and df.isStreaming:
        responses = with_lateness(responses, ts, delay)
    return window_request_metrics(responses, ts, "path", "processing_time_ms", "status_code", width)
