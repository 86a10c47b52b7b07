"""Starting, fanning out and watching streaming queries."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from queue import SimpleQueue

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions.documents import to_message
from ..operators.aggregates import latest_per_key
from ..session import complete_folders, remove_folder, scratch_path

TRIGGER = "30 seconds"


def _trigger(writer, trigger: str | None):
    return writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)


def write_stream(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str] = (), trigger: str | None = TRIGGER,
                 fmt: str = "parquet", name: str | None = None) -> StreamingQuery:
    """Checkpointed file sink: each input row ends up in the folder exactly once. No trigger = what is there, then stop."""
    writer = stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if keys:
        writer = writer.partitionBy(*keys)
    if name:
        writer = writer.queryName(name)
    return _trigger(writer, trigger).start(path)


def fan_out(sinks: Mapping[str, tuple[DataFrame, Sequence[str]]], root: str, checkpoint: str,
            trigger: str | None = TRIGGER) -> list[StreamingQuery]:
    """One query and checkpoint per named sink of ``(stream, partition keys)``."""
    return [write_stream(stream, f"{root}/{name}", f"{checkpoint}/{name}", keys, trigger)
            for name, (stream, keys) in sinks.items()]


def fan_out_state(stream: DataFrame, processors: Mapping[str, Callable[[DataFrame], DataFrame]], root: str,
                  checkpoint: str, trigger: str | None = TRIGGER) -> list[StreamingQuery]:
    """Several stateful jobs over one keyed source, each with its own state and sink."""
    return fan_out({name: (job(stream), ()) for name, job in processors.items()}, root, checkpoint, trigger)


def await_all(spark: SparkSession, queries: Sequence[StreamingQuery]) -> None:
    """Wait until all have ended; the first failure stops the rest and is raised."""
    try:
        while any(q.isActive for q in queries):
            spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
        for q in queries:
            q.awaitTermination()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()


@contextmanager
def started_with(spark: SparkSession, partitions: int | None = None, idle_batches: bool = True):
    """Settings taken over by queries started inside.

    ``partitions`` is the number of state partitions (fixed for a query's life).
    Processing-time state asks for batches without data for ever, so a query that
    is to end when its input is used up needs ``idle_batches=False``.
    """
    wanted = {"spark.sql.streaming.noDataMicroBatches.enabled": str(idle_batches).lower()}
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def run_available(stream: DataFrame, label: str, partitions: int | None = None, idle_batches: bool = True) -> DataFrame:
    """Process what is there with checkpointing and read the sink back as a batch frame."""
    spark = stream.sparkSession
    path, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")
    with started_with(spark, partitions, idle_batches):
        write_stream(stream, path, checkpoint, trigger=None).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def micro_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
                trigger: str | None = "5 minutes") -> StreamingQuery:
    """Call ``handle(batch, batch id)`` per micro-batch.

    The batch size is a source setting (``max_files`` / ``max_offsets``). A batch
    can be replayed after a failure, so ``handle`` must write by batch id.
    """
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


#: Batches of a view that are kept beside its snapshot before they are folded into the next one.
COMPACT_EVERY = 8
#: ``as_of`` of a view: its own newest event time.
NEWEST = "newest"


def _number(folder: str) -> int:
    return int(folder.rpartition("=")[2])


def _snapshot(spark: SparkSession, path: str) -> int:
    """The batch whose snapshot is in force, -1 before the first one."""
    return max(map(_number, complete_folders(spark, f"{path}/manifest")), default=-1)


def _stored_view(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the snapshot in force and of the batches after it."""
    last = _snapshot(spark, path)
    parts = [f"{path}/delta/{f}" for f in complete_folders(spark, f"{path}/delta") if _number(f) > last]
    return spark.read.parquet(*([f"{path}/snapshot/batch={last}"] if last >= 0 else []), *parts)


def _alive(rows: DataFrame, ts: str, as_of, ttl_s: int) -> DataFrame:
    now = rows.agg(F.max(ts)).scalar() if as_of == NEWEST else F.lit(as_of).cast("timestamp")
    return rows.where(F.col(ts) > now - F.make_interval(secs=F.lit(ttl_s)))


def _compact(spark: SparkSession, path: str, key: str, ts: str, tie: str, ttl_s: int | None, batch_id: int) -> None:
    """Write the view as a new snapshot without expired keys, put it in force, delete what it replaces.

    The manifest folder appears when its only file is committed, so a reader finds
    the old snapshot or the new one. The snapshot before is kept for readers that
    have just looked it up.
    """
    before = _snapshot(spark, path)
    rows = latest_per_key(_stored_view(spark, path), key, ts, tie)
    if ttl_s is not None:
        rows = _alive(rows, ts, NEWEST, ttl_s)
    rows.write.mode("overwrite").parquet(f"{path}/snapshot/batch={batch_id}")
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/batch={batch_id}")
    for kind, oldest in (("snapshot", before), ("manifest", before), ("delta", batch_id + 1)):
        for folder in complete_folders(spark, f"{path}/{kind}"):
            if _number(folder) < oldest:
                remove_folder(spark, f"{path}/{kind}/{folder}")


def latest_view(stream: DataFrame, key: str, ts: str, tie: str, path: str, checkpoint: str,
                trigger: str | None = TRIGGER, ttl_s: int | None = None, compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Maintain the newest record per key.

    Each batch writes the newest record of the keys it saw into its own folder,
    replacing the folder when the batch is replayed. Every ``compact_every``
    batches the folders are folded into a snapshot and deleted; with ``ttl_s``
    records that are so many seconds older than the view's newest one leave it
    then. So what is stored is bounded by the live keys and a few batches.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id <= _snapshot(spark, path):
            return  # replayed after its snapshot came into force
        latest_per_key(batch, key, ts, tie).write.mode("overwrite").parquet(f"{path}/delta/batch={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            _compact(spark, path, key, ts, tie, ttl_s, batch_id)

    return micro_batch(stream, keep, checkpoint, trigger)


def read_latest_view(spark: SparkSession, path: str, key: str, ts: str, tie: str, as_of=None,
                     ttl_s: int = 3600) -> DataFrame:
    """Newest record per key; with ``as_of`` (a time, or ``NEWEST``) only those not older than the time to live."""
    newest = latest_per_key(_stored_view(spark, path), key, ts, tie)
    return newest if as_of is None else _alive(newest, ts, as_of, ttl_s)


def newest_version(history: DataFrame, key: str = "key") -> DataFrame:
    """Current rows out of versioned rows."""
    last = history.groupBy(key).agg(F.max("version").alias("version"))
    return history.join(last, [key, "version"]).drop("version")


def to_messages(stream: DataFrame, path: str, checkpoint: str, trigger: str | None = TRIGGER,
                servers: str | None = None, topic: str | None = None) -> StreamingQuery:
    """One JSON text per row, to files or (with ``servers`` and ``topic``) to Kafka."""
    messages = stream.select(to_message(*stream.columns).alias("value"))
    writer = messages.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if topic:
        return _trigger(writer.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic),
                        trigger).start()
    return _trigger(writer.format("text"), trigger).start(path)


def to_console(stream: DataFrame, checkpoint: str, trigger: str | None = TRIGGER, rows: int = 20) -> StreamingQuery:
    """Print batches, for looking at a stream by hand."""
    writer = stream.writeStream.format("console").option("numRows", rows).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


_METRICS = ("query string, batch bigint, at string, input_rows bigint, input_rate double,"
            "processed_rate double, duration_ms bigint, watermark string")


def _metrics_row(p) -> tuple:
    duration = (p["durationMs"] or {}).get("triggerExecution")
    return (str(p["id"]), int(p["batchId"]), str(p["timestamp"]), int(p["numInputRows"]),
            float(p["inputRowsPerSecond"] or 0), float(p["processedRowsPerSecond"] or 0), duration,
            (p["eventTime"] or {}).get("watermark"))


def stream_metrics(query: StreamingQuery) -> DataFrame:
    """Recent progress of a query (Spark keeps a limited number, ``ProgressLog`` all): batch, rows, rates, watermark."""
    return SparkSession.getActiveSession().createDataFrame([_metrics_row(p) for p in query.recentProgress], _METRICS)


@contextmanager
def logged_progress(spark: SparkSession, path: str | None = None, settle_s: float = 20.0):
    """A ``ProgressLog`` that listens while the block runs and then until the progress of its last batches has come."""
    log = ProgressLog(path)
    spark.streams.addListener(log)
    try:
        yield log
        last, until = -1, time.time() + settle_s
        while time.time() < until and (now := log.table().count()) != last:
            last = now
            time.sleep(1)
    finally:
        spark.streams.removeListener(log)
        log.close()


class ProgressLog(StreamingQueryListener):
    """Appends progress and observed metrics (JSON) of the streams it listens to to a table, a row per batch.

    The callbacks only queue their rows, so they never hold a stream up; a thread of
    its own appends what has come every ``flush_s`` seconds as one file. ``table``
    and ``close`` append the rest.
    """

    def __init__(self, path: str | None = None, flush_s: float = 30.0):
        self.session = SparkSession.getActiveSession()
        self.path = path or scratch_path(self.session, "progress")
        self._queued: SimpleQueue = SimpleQueue()
        self._writing, self._closed = threading.Lock(), threading.Event()
        self._append([])
        threading.Thread(target=self._write_on, args=(flush_s,), daemon=True).start()

    def _append(self, rows: list) -> None:
        frame = self.session.createDataFrame(rows, f"{_METRICS}, observed string")
        frame.coalesce(1).write.mode("append").parquet(self.path)

    def _write_on(self, flush_s: float) -> None:
        while not self._closed.wait(flush_s):
            self.flush()

    def flush(self) -> None:
        """Append what is queued."""
        with self._writing:
            rows = []
            while not self._queued.empty():
                rows.append(self._queued.get())
            if rows:
                self._append(rows)

    def close(self) -> None:
        self._closed.set()
        self.flush()

    def table(self) -> DataFrame:
        self.flush()
        return self.session.read.schema(f"{_METRICS}, observed string").parquet(self.path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        observed = {name: row.asDict() for name, row in progress.observedMetrics.items()}
        self._queued.put((*_metrics_row(progress), json.dumps(observed, default=str)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
