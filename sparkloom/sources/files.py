"""File, table and database scans. Schemas are given, not inferred, unless asked for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, null_value: str = "NA",
             header: bool = True, encoding: str = "UTF-8") -> DataFrame:
    """CSV with a header; ``null_value`` means NULL, a byte-order mark is skipped. No schema means inference."""
    reader = spark.read.option("header", header).option("nullValue", null_value).option("encoding", encoding)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One JSON object per line."""
    return spark.read.schema(schema).json(path)


def read_json_multiline(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One JSON document (object or array of objects) per file."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"`{database}`.`{table}`")


def read_partitioned_csv(spark: SparkSession, root: str, schema: str,
                         partition_keys: Sequence[str] = ("year", "month", "day")) -> DataFrame:
    """CSV under ``key=value`` folders (gzip is read as it comes); the keys stay text, as they are written."""
    keys = ", ".join(f"`{k}` STRING" for k in partition_keys)
    return spark.read.option("header", True).option("escape", '"').schema(f"{schema}, {keys}").csv(root)


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def from_rows(spark: SparkSession, rows: Sequence, columns) -> DataFrame:
    return spark.createDataFrame(rows, columns)


def register(df: DataFrame, name: str) -> DataFrame:
    """Make the frame usable from SQL under a name."""
    df.createOrReplaceTempView(name)
    return df


def read_jdbc(spark: SparkSession, url: str, table: str, predicate: str | None = None,
              partition: tuple[str, object, object, int] | None = None, **options) -> DataFrame:
    """Database table, optionally split over tasks by ``(column, lower, upper, partitions)``.

    A predicate on the frame is pushed to the database.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition is not None:
        column, lower, upper, pieces = partition
        reader = (reader.option("partitionColumn", column).option("lowerBound", str(lower))
                  .option("upperBound", str(upper)).option("numPartitions", str(pieces)))
    df = reader.load()
    return df.where(F.expr(predicate)) if predicate else df
