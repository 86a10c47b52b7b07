"""HTTP monitoring job: request-rate and error-rate monitors over response events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.documents import json_field
from ..sources.streams import only_event_type
from ..streaming.run import TRIGGER, to_messages
from ..streaming.stateful import error_rate_monitor, request_monitor


def response_events(messages: DataFrame, data: str = "data", ts: str = "arrival_time") -> DataFrame:
    """Responses out of JSON text, with defaults for missing fields; a response without status counts as fine."""
    return only_event_type(messages, "http_response", data).select(
        json_field(data, "path", "string", "unknown").alias("path"),
        json_field(data, "status_code", "int", 200).alias("status_code"),
        json_field(data, "processing_time_ms", "double", 0.0).alias("processing_time_ms"),
        F.unix_millis(F.col(ts)).alias("event_ms"),
        F.col("sequence_number").cast("bigint").alias("id"),
    )


def http_monitor(events: DataFrame, out: str, checkpoint: str, trigger: str | None = TRIGGER, request=None,
                 errors=None) -> list[StreamingQuery]:
    """Both monitors over one source, each writing JSON messages; settings go to the monitors."""
    return [
        to_messages(request_monitor(events, **(request or {})), f"{out}/requests", f"{checkpoint}/requests", trigger),
        to_messages(error_rate_monitor(events, **(errors or {})), f"{out}/errors", f"{checkpoint}/errors", trigger),
    ]
