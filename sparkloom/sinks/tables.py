"""Catalog tables, database sinks and run metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions.documents import map_to_json


def _columns(schema: str, keys: dict[str, str]) -> str:
    return ", ".join([schema, *[f"`{k}` {t}" for k, t in keys.items()]])


#: table -> (row type, file format, partition keys)
WEATHER_TABLES = {
    "raw_weather": (schemas.RAW_WEATHER, "csv", {"year": "string", "month": "string", "day": "string"}),
    "processed_weather": (schemas.PROCESSED_WEATHER, "parquet", {"year": "string", "month": "string", "day": "string"}),
    "weather_aggregations": (schemas.WEATHER_AGGREGATIONS, "parquet",
                             {"aggregation_level": "string", "year": "string", "month": "string"}),
}


def create_tables(spark: SparkSession, database: str, location: str | None = None, tables=None) -> list[str]:
    """Create the database and its partitioned tables; what exists is left alone."""
    tables = WEATHER_TABLES if tables is None else tables
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, (schema, fmt, keys) in tables.items():
        options = "OPTIONS (header 'true', escape '\"')" if fmt == "csv" else ""
        place = f"LOCATION '{location}/{name}'" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({_columns(schema, keys)}) USING {fmt} "
                  f"{options} PARTITIONED BY ({', '.join(keys)}) {place}")
    return list(tables)


def refresh_table(spark: SparkSession, database: str, table: str) -> None:
    """Pick up folders that were added behind the catalog's back."""
    spark.sql(f"MSCK REPAIR TABLE `{database}`.`{table}`")
    spark.catalog.refreshTable(f"{database}.{table}")


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch_size: int = 10_000,
               writers: int | None = None, **options) -> None:
    """Write to a database table; ``writers`` limits the parallel connections."""
    out = df if writers is None else df.coalesce(writers)
    (out.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
     .option("batchsize", batch_size).options(**options).save())


def with_record_keys(df: DataFrame, metadata: str = "metadata", now=None) -> DataFrame:
    """Random id, creation time and metadata as JSON text (NULL when empty)."""
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return df.withColumns({"id": F.uuid(), "created_at": stamp, metadata: map_to_json(metadata)})


def append_records(df: DataFrame, path: str, metadata: str = "metadata", now=None) -> None:
    with_record_keys(df, metadata, now).write.mode("append").parquet(path)


def record_metrics(spark: SparkSession, path: str, job: str, metrics: dict[str, float], now=None) -> DataFrame:
    """Append one row per metric of a run and return the metrics table."""
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    rows = [(job, name, float(value)) for name, value in metrics.items()]
    (spark.createDataFrame(rows, "job string, metric string, value double").withColumn("recorded_at", stamp)
     .coalesce(1).write.mode("append").parquet(path))
    return spark.read.parquet(path)


def known_partitions(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS `{database}`.`{table}`")


def merged_schema(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Files written with different column sets as one frame."""
    return spark.read.option("mergeSchema", True).parquet(*paths)
