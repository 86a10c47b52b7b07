"""Streaming queries over the events table, read back from their sinks, and their batch counterparts."""

from pyspark.sql import functions as F

from ..functions.documents import to_message
from ..operators import resetting as rs
from ..session import scratch_path
from ..sources.streams import only_event_type, parse_data_column, read_stream, with_ingest_meta
from ..streaming import run, stateful, windows as win
from .registry import VIEWS, query, stamp, table_path


#: files one batch may take in, which bounds what a busy key can bring at once
FILES_PER_BATCH = 256


def events_stream(t):
    """The events table as a stream; as a pattern the path may be one file or a folder of files."""
    path = table_path(t.sf_dir, "events")
    return read_stream(t.spark, "file", path=f"{path[:-1]}[{path[-1]}]", schema=t.events.schema,
                       max_files=FILES_PER_BATCH)


def stream_of(t, view: str):
    """A view of the events table as a stream."""
    return events_stream(t).selectExpr(*VIEWS[view][1])


def partitions(t) -> int:
    return t.spark.sparkContext.defaultParallelism


def monitored(frame):
    """Responses with their event time in epoch milliseconds."""
    return frame.where("event_type = 'http_response'").select(
        "id", "path", "status_code", "processing_time_ms", "event_timestamp",
        F.unix_millis("event_timestamp").alias("event_ms"))


LEVEL = ("CASE WHEN temperature > 35 THEN 'HIGH_HEAT' WHEN temperature < -10 THEN 'EXTREME_COLD' "
         "WHEN wind_speed > 100 THEN 'HIGH_WIND' ELSE 'NORMAL' END")
PLAUSIBLE = ("temperature BETWEEN -50 AND 60 AND humidity BETWEEN 0 AND 100 AND pressure BETWEEN 800 AND 1200 "
             "AND station_id IS NOT NULL")


@query("s11_json_stream", "SELECT event_id, event_type, value FROM events WHERE event_type = 'click'")
def _(t):
    enveloped = events_stream(t).select(to_message("event_id", "event_type", "value").alias("data"))
    clicks = only_event_type(enveloped, "click")
    return run.run_available(parse_data_column(clicks, "event_id bigint, event_type string, value double"), "json-stream")


WINDOW_SQL = f"""
WITH r AS (SELECT *, {LEVEL} AS level FROM {{readings}} WHERE {PLAUSIBLE}),
w AS (SELECT *, time_bucket(INTERVAL 10 MINUTE, r.timestamp, TIMESTAMP '2000-01-01') AS ws FROM r)
SELECT station_id, {stamp('ws')} AS window_start, {stamp('ws + INTERVAL 10 MINUTE')} AS window_end,
  ROUND(AVG(temperature), 4) AS avg_temperature, ROUND(MIN(temperature), 4) AS min_temperature, ROUND(MAX(temperature), 4) AS max_temperature,
  ROUND(AVG(humidity), 4) AS avg_humidity, ROUND(AVG(pressure), 4) AS avg_pressure, ROUND(AVG(wind_speed), 4) AS avg_wind_speed,
  MAX(wind_speed) AS max_wind_speed, COUNT(*) AS measurement_count, COUNT(*) FILTER (WHERE level <> 'NORMAL') AS raised
FROM w GROUP BY station_id, ws"""


def _raised(stats):
    raised = F.aggregate(F.filter("alerts", lambda a: a["level"] != "NORMAL"), F.lit(0).cast("bigint"), lambda x, a: x + a["n"])
    return stats.withColumn("raised", raised).drop("alerts")


@query("x02_window_stats", f"""
SELECT * FROM ({WINDOW_SQL})
WHERE window_end <= (SELECT {stamp("MAX(r.timestamp) - INTERVAL 2 MINUTE")} FROM {{readings}} r)""")
def window_stats_query(t):
    stream = win.enrich_stream(win.with_lateness(stream_of(t, "readings"), "timestamp"))
    return _raised(run.run_available(win.window_stats(stream), "window-stats", partitions(t)))


@query("x02_window_stats_batch", WINDOW_SQL)
def _(t):
    return _raised(win.window_stats(win.enrich_stream(t.readings)))


@query("x02_sliding_window_batch", f"""
WITH r AS (SELECT *, {LEVEL} AS level FROM {{readings}} WHERE {PLAUSIBLE}),
w AS (SELECT r.*, time_bucket(INTERVAL 5 MINUTE, r.timestamp, TIMESTAMP '2000-01-01') - k * INTERVAL 5 MINUTE AS ws FROM r, range(2) x(k))
SELECT station_id, {stamp('ws')} AS window_start, COUNT(*) AS measurement_count, ROUND(MAX(temperature), 4) AS max_temperature
FROM w GROUP BY station_id, ws""")
def _(t):
    return win.window_stats(win.enrich_stream(t.readings), slide="5 minutes").select(
        "station_id", "window_start", "measurement_count", "max_temperature")


HTTP_SQL = f"""
WITH w AS (SELECT *, time_bucket(INTERVAL 5 MINUTE, event_timestamp, TIMESTAMP '2000-01-01') AS ws FROM {{http}} WHERE event_type = 'http_response')
SELECT path AS endpoint, {stamp('ws')} AS window_start, {stamp('ws + INTERVAL 5 MINUTE')} AS window_end, COUNT(*) AS request_count,
  ROUND(AVG(processing_time_ms), 3) AS avg_processing_time,
  ROUND(COUNT(*) FILTER (WHERE status_code >= 400) * 100.0E0 / COUNT(*), 4) AS error_rate FROM w GROUP BY path, ws"""


@query("x03_http_window_metrics", f"""
SELECT * FROM ({HTTP_SQL}) WHERE window_end <= (
  SELECT {stamp("MAX(event_timestamp) - INTERVAL 5 SECOND")} FROM {{http}} WHERE event_type = 'http_response')""", digits=4)
def _(t):
    metrics = win.http_window_metrics(stream_of(t, "http"))
    return run.run_available(metrics, "http-windows", partitions(t)).withColumn(
        "avg_processing_time", F.round("avg_processing_time", 3))


@query("x04_enrich_stream", f"""
SELECT id, station_id, {LEVEL} AS alert_level,
  ROUND(CASE WHEN temperature < 27 THEN temperature ELSE -42.379 + 2.04901523 * temperature + 10.14333127 * humidity END, 4) AS heat_index
FROM {{readings}} WHERE {PLAUSIBLE}""")
def _(t):
    enriched = win.enrich_stream(win.with_lateness(stream_of(t, "readings"), "timestamp"))
    return run.run_available(enriched.select("id", "station_id", "alert_level", "heat_index"), "enriched")


def _chain_sql(window_ms: int) -> str:
    """Window start and running figures by walking each path's events one after the other."""
    return f"""
WITH RECURSIVE e AS (SELECT id, path, status_code, epoch_us(event_timestamp) // 1000 AS ms,
    row_number() OVER (PARTITION BY path ORDER BY epoch_us(event_timestamp) // 1000, id) AS rn FROM {{http}} WHERE event_type = 'http_response'),
chain AS (SELECT path, rn, ms AS start FROM e WHERE rn = 1
  UNION ALL SELECT e.path, e.rn, CASE WHEN e.ms - c.start > {window_ms} THEN e.ms ELSE c.start END FROM chain c JOIN e ON e.path = c.path AND e.rn = c.rn + 1),
w AS (SELECT e.*, c.start, COUNT(*) OVER run AS n, CAST(SUM(CASE WHEN status_code >= 400 THEN 1 ELSE 0 END) OVER run AS BIGINT) AS errors
  FROM e JOIN chain c ON e.path = c.path AND e.rn = c.rn WINDOW run AS (PARTITION BY e.path, c.start ORDER BY e.rn))"""


HOURS_6 = 6 * 3600 * 1000
REQUEST_SQL = _chain_sql(HOURS_6) + " SELECT id, path AS endpoint, ms AS event_ms, n AS request_count FROM w"


@query("x06_request_monitor", REQUEST_SQL)
def _(t):
    stream = monitored(stream_of(t, "http"))
    out = run.run_available(stateful.request_monitor(stream, window_ms=HOURS_6, ttl_ms=10 ** 12), "requests", partitions(t), idle_batches=False)
    return out.where("record = 'metrics'").select("id", "endpoint", "event_ms", "request_count")


@query("x06_request_counts_batch", REQUEST_SQL)
def _(t):
    counted = rs.request_counts(monitored(t.http), "path", "event_ms", "id", HOURS_6)
    return counted.select("id", F.col("path").alias("endpoint"), "event_ms", "request_count")


ALERT_SQL = _chain_sql(HOURS_6) + f""",
over_limit AS (SELECT id, path, ms, n, row_number() OVER (PARTITION BY path ORDER BY rn) AS k FROM w WHERE n > 2),
kept AS (SELECT path, k, ms AS last, TRUE AS fires FROM over_limit WHERE k = 1
  UNION ALL SELECT o.path, o.k, CASE WHEN o.ms - a.last > {4 * HOURS_6} THEN o.ms ELSE a.last END, o.ms - a.last > {4 * HOURS_6}
  FROM kept a JOIN over_limit o ON o.path = a.path AND o.k = a.k + 1)
SELECT o.id, o.path AS endpoint, o.ms AS event_ms, o.n AS request_count FROM over_limit o JOIN kept a ON a.path = o.path AND a.k = o.k WHERE a.fires"""


@query("x07_rate_alerts", ALERT_SQL)
def _(t):
    monitor = stateful.request_monitor(monitored(stream_of(t, "http")), threshold=2, window_ms=HOURS_6,
                                       suppress_ms=4 * HOURS_6, ttl_ms=10 ** 12)
    out = run.run_available(monitor, "rate-alerts", partitions(t), idle_batches=False)
    return out.where("record = 'HIGH_REQUEST_RATE'").select("id", "endpoint", "event_ms", "request_count")


@query("x07_rate_alerts_batch", ALERT_SQL)
def _(t):
    counted = rs.request_counts(monitored(t.http), "path", "event_ms", "id", HOURS_6)
    alerts = rs.rate_alerts(counted, "path", "event_ms", "id", threshold=2, suppress_ms=4 * HOURS_6)
    return alerts.select("id", F.col("path").alias("endpoint"), "event_ms", "request_count")


ERROR_SQL = _chain_sql(4 * HOURS_6) + """
SELECT id, path AS endpoint, n AS total_requests, errors AS error_requests, ROUND(errors * 100.0E0 / n, 2) AS error_rate_percent,
  n >= 10 AND errors * 100.0E0 / n > 10 AS is_alert FROM w"""


@query("x08_error_rate_monitor", ERROR_SQL)
def _(t):
    monitor = stateful.error_rate_monitor(monitored(stream_of(t, "http")), window_ms=4 * HOURS_6, ttl_ms=10 ** 12)
    out = run.run_available(monitor, "error-rates", partitions(t), idle_batches=False)
    return out.groupBy("id", "endpoint", "total_requests", "error_requests", "error_rate_percent").agg(
        F.bool_or(F.col("record") == "HIGH_ERROR_RATE").alias("is_alert"))


@query("x08_error_rates_batch", ERROR_SQL)
def _(t):
    rates = rs.error_rates(monitored(t.http), "path", "event_ms", "id", "status_code", window_ms=4 * HOURS_6)
    return rates.select("id", F.col("path").alias("endpoint"), "total_requests", "error_requests",
                        "error_rate_percent", "is_alert")


@query("x11_file_sink", "SELECT weather_condition, COUNT(*) AS n, SUM(id)::BIGINT AS ids FROM {readings} GROUP BY weather_condition")
def _(t):
    path, checkpoint = scratch_path(t.spark, "file-sink"), scratch_path(t.spark, "file-sink-checkpoint")
    for _attempt in range(2):  # the second run finds nothing new
        run.write_stream(stream_of(t, "readings"), path, checkpoint, ["weather_condition"], trigger=None).awaitTermination()
    return t.spark.read.parquet(path).groupBy("weather_condition").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query("x14_latest_view", f"""
SELECT id, station_id, {stamp('r.timestamp')} AS timestamp, ROUND(temperature, 4) AS temperature FROM {{readings}} r
QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY r.timestamp DESC, id DESC) = 1""")
def _(t):
    path, checkpoint = scratch_path(t.spark, "latest"), scratch_path(t.spark, "latest-checkpoint")
    stream = stream_of(t, "readings").select("id", "station_id", "timestamp", "temperature")
    run.latest_view(stream, "station_id", "timestamp", "id", path, checkpoint, trigger=None).awaitTermination()
    return run.read_latest_view(t.spark, path, "station_id", "timestamp", "id")


@query("x14_latest_view_expiry", f"""
SELECT id, station_id, {stamp('r.timestamp')} AS timestamp, ROUND(temperature, 4) AS temperature FROM {{readings}} r
WHERE r.timestamp > (SELECT MAX(n.timestamp) FROM {{readings}} n) - INTERVAL 20 MINUTE
QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY r.timestamp DESC, id DESC) = 1""")
def _(t):
    # the readings as files of their own, one a batch
    source = scratch_path(t.spark, "readings")
    t.readings.select("id", "station_id", "timestamp", "temperature").repartitionByRange(12, "timestamp", "id").write.parquet(source)
    stream = read_stream(t.spark, "file", path=source, schema=t.spark.read.parquet(source).schema, max_files=1)
    path, checkpoint = scratch_path(t.spark, "latest"), scratch_path(t.spark, "latest-checkpoint")
    run.latest_view(stream, "station_id", "timestamp", "id", path, checkpoint, trigger=None, ttl_s=1200, compact_every=4).awaitTermination()
    return run.read_latest_view(t.spark, path, "station_id", "timestamp", "id", as_of=run.NEWEST, ttl_s=1200)


@query("x15_bounded_history", """
SELECT id, station_id AS key FROM {readings} r QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY epoch_us(r.timestamp) // 1000 DESC, id DESC) <= 10""")
def _(t):
    stream = stream_of(t, "readings").select("id", "station_id", F.unix_millis("timestamp").alias("event_ms"),
                                             F.col("temperature").alias("value"))
    history = run.run_available(stateful.bounded_history(stream, "station_id", 10), "history", partitions(t))
    return run.newest_version(history).select("id", "key")


@query("x18_stream_progress", """
SELECT COUNT(*) AS input_rows, CAST(1 AS BIGINT) AS queries, true AS lasted FROM {readings}""")
def _(t):
    path, checkpoint = scratch_path(t.spark, "watched"), scratch_path(t.spark, "watched-checkpoint")
    with run.logged_progress(t.spark) as log:
        query_id = run.write_stream(stream_of(t, "readings"), path, checkpoint, trigger=None)
        query_id.awaitTermination()
    mine = log.table().where(F.col("query") == str(query_id.id))
    return mine.agg(F.sum("input_rows").alias("input_rows"), F.count_distinct("query").alias("queries"),
                    (F.sum("duration_ms") > 0).alias("lasted"))


@query("x17_json_messages", """
SELECT path AS endpoint, COUNT(*) AS windows FROM (SELECT DISTINCT path, time_bucket(INTERVAL 5 MINUTE, event_timestamp, TIMESTAMP '2000-01-01') AS ws
  FROM {http} WHERE event_type = 'http_response') WHERE ws + INTERVAL 5 MINUTE <= (
  SELECT MAX(event_timestamp) - INTERVAL 5 SECOND FROM {http} WHERE event_type = 'http_response') GROUP BY path""")
def _(t):
    path, checkpoint = scratch_path(t.spark, "messages"), scratch_path(t.spark, "messages-checkpoint")
    with run.started_with(t.spark, partitions(t)):
        run.to_messages(win.http_window_metrics(stream_of(t, "http")), path, checkpoint, trigger=None).awaitTermination()
    read = t.spark.read.text(path).select(F.get_json_object("value", "$.endpoint").alias("endpoint"))
    return read.groupBy("endpoint").agg(F.count("*").alias("windows"))


@query("x10_event_time_monitor", REQUEST_SQL)
def _(t):
    stream = monitored(stream_of(t, "http").withWatermark("event_timestamp", "1 minute"))
    monitor = stateful.request_monitor(stream, time_mode="EventTime", window_ms=HOURS_6)
    out = run.run_available(monitor, "event-time", partitions(t))
    return out.where("record = 'metrics'").select("id", "endpoint", "event_ms", "request_count")


@query("x12_fan_out", f"""
SELECT 'raw' AS sink, COUNT(*) AS n FROM {{readings}} UNION ALL SELECT 'plausible', COUNT(*) FROM {{readings}} WHERE {PLAUSIBLE}""")
def _(t):
    stream, root = stream_of(t, "readings"), scratch_path(t.spark, "fan-out")
    sinks = {"raw": (stream, ["weather_condition"]), "plausible": (win.enrich_stream(stream), ())}
    run.await_all(t.spark, run.fan_out(sinks, root, scratch_path(t.spark, "fan-out-checkpoint"), trigger=None))
    counts = [t.spark.read.parquet(f"{root}/{name}").agg(F.lit(name).alias("sink"), F.count("*").alias("n")) for name in sinks]
    return counts[0].unionByName(counts[1])


@query("x13_two_stateful_jobs", _chain_sql(HOURS_6) + """
SELECT path AS endpoint, COUNT(*) AS metrics, SUM(CASE WHEN n >= 3 AND errors * 100.0E0 / n > 10 THEN 1 ELSE 0 END)::BIGINT AS error_alerts FROM w GROUP BY path""")
def _(t):
    root = scratch_path(t.spark, "two-jobs")
    settings = {"window_ms": HOURS_6, "ttl_ms": 10 ** 12}
    jobs = {"requests": lambda s: stateful.request_monitor(s, **settings),
            "errors": lambda s: stateful.error_rate_monitor(s, min_requests=3, **settings)}
    with run.started_with(t.spark, partitions(t), idle_batches=False):
        run.await_all(t.spark, run.fan_out_state(monitored(stream_of(t, "http")), jobs, root,
                                                 scratch_path(t.spark, "two-jobs-checkpoint"), trigger=None))
    metrics = t.spark.read.parquet(f"{root}/requests").where("record = 'metrics'").groupBy("endpoint").agg(F.count("*").alias("metrics"))
    alerts = t.spark.read.parquet(f"{root}/errors").groupBy("endpoint").agg(
        F.count_if(F.col("record") == "HIGH_ERROR_RATE").alias("error_alerts"))
    return metrics.join(alerts, "endpoint")


@query("x16_micro_batches", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type")
def _(t):
    path = scratch_path(t.spark, "micro")

    def keep(batch, batch_id):  # by batch id, so that a replayed batch replaces itself
        batch.groupBy("event_type").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    run.micro_batch(events_stream(t), keep, scratch_path(t.spark, "micro-checkpoint"), trigger=None).awaitTermination()
    return t.spark.read.parquet(path).groupBy("event_type").agg(F.sum("n").alias("n"))


@query("d28_ingest_metadata", "SELECT COUNT(*) AS n, COUNT(*) AS dated, CAST(1 AS BIGINT) AS sources FROM events")
def _(t):
    rows = run.run_available(with_ingest_meta(events_stream(t)), "ingest")
    suffix = F.regexp_extract("source_file", r"\.(\w+)$", 1)
    return rows.agg(F.count("*").alias("n"), F.count("arrival_time").alias("dated"), F.count_distinct(suffix).alias("sources"))
