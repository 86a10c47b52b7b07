"""Partitioned file sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.documents import map_to_json
from ..functions.timeparts import date_keys

FACT_KEYS = ("year", "month", "day")
STATION_KEYS = (*FACT_KEYS, "station")
AGGREGATE_KEYS = ("aggregation_level", "year", "month")


def write_lake(df: DataFrame, path: str, partition_keys: Sequence[str] = FACT_KEYS, compression: str = "gzip",
               mode: str = "append", rows_per_file: int = 5_000_000, rebalance: bool = True) -> None:
    """Parquet, one folder per key value.

    The rows of a folder are brought together first, so scattered input does not
    leave a file per task and folder; adaptive execution splits a folder that is
    too large for one task. ``rebalance=False`` leaves rows in the task that made
    them, which suits input that already comes day by day.
    """
    if rebalance:
        df = df.hint("rebalance", *[F.col(k) for k in partition_keys])
    (df.write.mode(mode).partitionBy(*partition_keys).option("compression", compression)
     .option("maxRecordsPerFile", rows_per_file).parquet(path))


def write_json_lake(df: DataFrame, path: str, ts: str, station: str, mode: str = "append") -> None:
    """JSON lines under zero-padded ``year=/month=/day=/station=`` folders, the rows of one brought together."""
    keyed = date_keys(df, ts).withColumn("station", F.col(station)).hint("rebalance", *map(F.col, STATION_KEYS))
    keyed.write.mode(mode).partitionBy(*STATION_KEYS).json(path)


def land_raw_csv(df: DataFrame, root: str, ts: str, metadata: str = "metadata", mode: str = "append") -> None:
    """Raw batch as dated CSV; metadata as JSON text, ``{}`` when there is none."""
    text = F.coalesce(map_to_json(metadata), F.lit("{}"))
    flat = date_keys(df.withColumn(metadata, text), ts)
    (flat.write.mode(mode).partitionBy(*FACT_KEYS).option("header", True).option("escape", '"')
     .option("compression", "gzip").csv(root))


def export_bi(datasets: Mapping[str, DataFrame], out: str, now=None) -> DataFrame:
    """Each data set as CSV with a header, plus one JSON line per data set with its row count and the export time."""
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    catalogue = None
    for name, df in datasets.items():
        target = f"{out}/{name}"
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(target)
        # counted from what was written, so an expensive plan is not run again
        written = df.sparkSession.read.option("header", True).option("escape", '"').schema(df.schema).csv(target)
        line = written.agg(F.count("*").alias("records")).select(F.lit(name).alias("dataset"), "records")
        catalogue = line if catalogue is None else catalogue.unionByName(line)
    catalogue = catalogue.withColumn("exported_at", stamp)
    catalogue.write.mode("overwrite").json(f"{out}/metadata")
    return catalogue.sparkSession.read.schema(catalogue.schema).json(f"{out}/metadata")


def export_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line; text is kept as it is, without escapes for other scripts."""
    df.write.mode(mode).json(path)


def process_new(spark: SparkSession, source, sink_path: str, checkpoint: str, transform=None,
                partition_keys: Sequence[str] = ()) -> None:
    """Process only what earlier runs have not seen.

    ``source`` is a streaming frame; its checkpoint remembers the files taken.
    """
    stream = source if transform is None else transform(source)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if partition_keys:
        writer = writer.partitionBy(*partition_keys)
    writer.start(sink_path).awaitTermination()


def process_range(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Rows of the days from ``start`` to ``end``, both included.

    On a lake with text ``year``/``month``/``day`` folders the folder names are
    compared as well, so whole folders are skipped.
    """
    ranged = df.where((F.to_date(ts) >= F.lit(start).cast("date")) & (F.to_date(ts) <= F.lit(end).cast("date")))
    if all(k in df.columns for k in FACT_KEYS):
        folder = F.make_date(*[F.col(k).cast("int") for k in FACT_KEYS])
        ranged = ranged.where(folder.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return ranged


def rewrite_range(df: DataFrame, path: str, partition_keys: Sequence[str] = FACT_KEYS) -> None:
    """Replace exactly the folders the frame has rows for."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_keys).parquet(path))
