"""Streaming sources behind one function."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def kafka_options(servers: str, topic: str, start: str = "latest", max_offsets: int | None = None) -> dict[str, str]:
    """Reader options of a Kafka topic; the trigger limit bounds what one batch takes in."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start,
               "failOnDataLoss": "true"}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_stream(spark: SparkSession, kind: str, *, path: str | None = None, schema: T.StructType | str | None = None,
                fmt: str = "parquet", servers: str | None = None, topic: str | None = None, start: str = "latest",
                max_files: int | None = None, max_offsets: int | None = None, glob: str | None = None) -> DataFrame:
    """``kind="file"`` streams a folder, ``kind="kafka"`` a topic as text with its arrival time and offset.

    Kafka needs the connector package on the cluster's class path.
    """
    if kind == "kafka":
        raw = spark.readStream.format("kafka").options(**kafka_options(servers, topic, start, max_offsets)).load()
        return raw.select(F.col("value").cast("string").alias("data"), F.col("timestamp").alias("arrival_time"),
                          F.col("offset").alias("sequence_number"))
    if kind != "file":
        raise ValueError(f"unknown stream kind {kind!r}")
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.format(fmt).load(path)


def with_ingest_meta(df: DataFrame) -> DataFrame:
    """Arrival time and file position of records read from files."""
    return df.select("*", F.col("_metadata.file_modification_time").alias("arrival_time"),
                     F.col("_metadata.file_name").alias("source_file"),
                     F.col("_metadata.file_block_start").alias("sequence_number"))


def parse_data_column(df: DataFrame, schema: T.StructType | str, data: str = "data") -> DataFrame:
    """JSON text column to its fields; unreadable text gives NULL fields."""
    return df.select(F.from_json(F.col(data), schema).alias("_r")).select("_r.*")


def only_event_type(df: DataFrame, event_type: str, data: str = "data") -> DataFrame:
    """Rows whose JSON text has the event type, however it is spaced."""
    return df.where(F.get_json_object(F.col(data), "$.event_type") == event_type)
