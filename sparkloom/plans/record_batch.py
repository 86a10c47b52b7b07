"""Device records as a batch: parse, validate, derive, quarantine, store."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from ..functions.documents import enrich_map
from ..functions.weather import dew_point, heat_index, wind_chill
from ..operators.aggregates import latest_per_key
from ..operators.validation import reading_rules, split_valid, validate
from ..session import materialise
from ..sinks.lake import write_json_lake
from ..sinks.tables import append_records
from ..sources.envelope import parse_record

VERSION = "1.0.0"


def enrich_records(valid: DataFrame, now=None, version: str = VERSION) -> DataFrame:
    """Derived measures, processing time and version as metadata text."""
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return valid.withColumn("metadata", enrich_map("metadata", {
        "heat_index": heat_index("temperature", "humidity", "full"),
        "wind_chill": wind_chill("temperature", "wind_speed", 2),
        "dew_point": dew_point("temperature", "humidity", 2),
        "processed_at": F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ssXXX"),
        "processor_version": F.lit(version),
    }))


def record_batch(messages: DataFrame, out: str, now=None) -> None:
    """Store valid records as a table and as JSON, the newest per station, and rejected ones with their reasons.

    Messages are parsed and validated once, and stored; all sinks share one clock.
    """
    now = now or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    valid, rejected = split_valid(materialise(validate(parse_record(messages, now=now), reading_rules()), "records"))
    enriched = enrich_records(valid, now)
    append_records(enriched, f"{out}/records", now=now)
    write_json_lake(enriched, f"{out}/json", "timestamp", "station_id")
    rejected.write.mode("append").parquet(f"{out}/rejected")
    newest = latest_per_key(enriched.withColumn("metadata", F.to_json("metadata")), "station_id", "timestamp", "metadata")
    newest.write.mode("overwrite").parquet(f"{out}/latest")
