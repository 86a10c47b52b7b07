import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkloom.plans import http_monitor, weather_stream
from sparkloom.session import complete_folders, scratch_path
from sparkloom.sources.streams import only_event_type, read_stream
from sparkloom.streaming import run, stateful, windows as win

READING = ("id bigint, station_id string, timestamp timestamp, temperature double, humidity double, pressure double, wind_speed double")
EVENT = "id bigint, path string, status_code int, processing_time_ms double, event_ms bigint, at timestamp"
START = dt.datetime(2024, 1, 1)


def reading(i, minute, station="s", temperature=20.0):
    return (i, station, START + dt.timedelta(minutes=minute), temperature, 50.0, 1000.0, 5.0)


def event(i, ms, status=200, path="/a"):
    return (i, path, status, 1.0, ms, START + dt.timedelta(milliseconds=ms))


class Feed:
    """Files that arrive one after the other, each a micro-batch of its own."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.n = spark, folder, schema, 0

    def add(self, rows):
        import os
        import time

        before = set(os.listdir(self.folder)) if os.path.isdir(self.folder) else set()
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.folder)
        self.n += 1
        for name in set(os.listdir(self.folder)) - before:  # arrival order is the file time
            stamp = time.time() - 1000 + self.n
            os.utime(f"{self.folder}/{name}", (stamp, stamp))
        return self

    def stream(self):
        return read_stream(self.spark, "file", path=self.folder, schema=self.schema, max_files=1)


@pytest.fixture
def feed(spark, tmp_path):
    return lambda schema: Feed(spark, str(tmp_path / "feed"), schema)


def drain(spark, frame, path, checkpoint, **kw):
    with run.started_with(spark, 2, **kw):
        run.write_stream(frame, path, checkpoint, trigger=None).awaitTermination()


def test_late_rows_are_dropped_and_open_windows_held_back(spark, feed):
    f = feed(READING).add([reading(1, 1), reading(2, 2, temperature=36.0)]).add([reading(3, 30)]).add([reading(6, 31)])
    f.add([reading(4, 3), reading(5, 29.5)])
    stats = win.window_stats(win.enrich_stream(win.with_lateness(f.stream(), "timestamp")))
    rows = {r.window_start: r for r in run.run_available(stats, "late", 2).collect()}
    first = rows[START]
    assert first.measurement_count == 2  # row 4 came after its window was closed
    assert {(a.level, a.n) for a in first.alerts} == {("NORMAL", 1), ("HIGH_HEAT", 1)}
    assert START + dt.timedelta(minutes=30) not in rows  # still open


def test_sliding_windows(spark, feed):
    f = feed(READING).add([reading(1, 7)])
    stats = win.window_stats(win.enrich_stream(f.stream().withWatermark("timestamp", "0 seconds")), slide="5 minutes")
    batch = win.window_stats(win.enrich_stream(spark.createDataFrame([reading(1, 7)], READING)), slide="5 minutes")
    assert batch.count() == 2 and stats.isStreaming


def test_restart_continues_and_adds_nothing_twice(spark, feed, tmp_path):
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    f = feed(EVENT).add([event(i, i * 1000) for i in range(5)])
    for step in range(3):
        if step == 1:
            f.add([event(10, 6000), event(11, 400_000)])
        drain(spark, stateful.request_monitor(f.stream()), out, cp, idle_batches=False)
    counts = {r.id: r.request_count for r in spark.read.parquet(out).collect()}
    assert counts == {0: 1, 1: 2, 2: 3, 3: 4, 4: 5, 10: 6, 11: 1}  # state survived the restart; a new window began


def test_rate_alert_once_per_hour(spark, feed):
    rows = [event(i, i) for i in range(150)] + [event(200 + i, 1_000_000 + i) for i in range(150)]
    rows += [event(400 + i, 3_600_101 + i) for i in range(150)]
    f = feed(EVENT).add(rows)
    out = run.run_available(stateful.request_monitor(f.stream()), "alerts", 2, idle_batches=False)
    alerts = [(r.id, r.request_count) for r in out.where("record = 'HIGH_REQUEST_RATE'").orderBy("event_ms").collect()]
    assert alerts == [(100, 101), (500, 101)]


def test_alerts_stay_suppressed_across_batches(spark, feed):
    f = feed(EVENT).add([event(i, i) for i in range(120)]).add([event(200 + i, 200 + i) for i in range(5)])
    out = run.run_available(stateful.request_monitor(f.stream()), "alerts2", 2, idle_batches=False)
    assert [r.id for r in out.where("record = 'HIGH_REQUEST_RATE'").collect()] == [100]


@pytest.mark.parametrize("n,errors,alert", [(10, 2, True), (9, 9, False), (10, 1, False), (20, 3, True)])
def test_error_rate(spark, feed, n, errors, alert):
    # errors first, so that the rate only falls afterwards
    f = feed(EVENT).add([event(i, i, 500 if i < errors else 200) for i in range(n)])
    out = run.run_available(stateful.error_rate_monitor(f.stream()), "errors", 2, idle_batches=False)
    last = out.where(F.col("id") == n - 1).where("record = 'error_metrics'").first()
    assert (last.total_requests, last.error_requests, last.error_rate_percent) == (n, errors, round(errors / n * 100, 2))
    assert (out.where("record = 'HIGH_ERROR_RATE'").count() > 0) is alert


def test_state_expires_after_its_time_to_live(spark, feed, tmp_path):
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    f = feed(EVENT).add([event(1, 0)])
    monitor = lambda: stateful.request_monitor(f.stream(), ttl_ms=1)
    drain(spark, monitor(), out, cp, idle_batches=False)
    f.add([event(2, 1)])
    drain(spark, monitor(), out, cp, idle_batches=False)
    assert sorted((r.id, r.request_count) for r in spark.read.parquet(out).collect()) == [(1, 1), (2, 1)]


def test_event_time_timer_frees_the_window_but_not_the_suppression(spark, feed):
    f = feed(EVENT).add([event(1, 0), event(2, 10)]).add([event(3, 20_000, path="/b")]).add([event(4, 20_001), event(5, 20_002)])
    stream = f.stream().withWatermark("at", "1 second")
    out = run.run_available(stateful.request_monitor(stream, time_mode="EventTime", window_ms=10_000, threshold=1), "timers", 2)
    counts = {r.id: r.request_count for r in out.where("record = 'metrics'").collect()}
    assert counts == {1: 1, 2: 2, 3: 1, 4: 1, 5: 2}
    assert [r.id for r in out.where("record = 'HIGH_REQUEST_RATE'").collect()] == [2]


def test_two_stateful_jobs_from_one_source(spark, feed, tmp_path):
    f = feed(EVENT).add([event(i, i, 500) for i in range(12)])
    jobs = {"requests": stateful.request_monitor, "errors": stateful.error_rate_monitor}
    with run.started_with(spark, 2, idle_batches=False):
        run.await_all(spark, run.fan_out_state(f.stream(), jobs, str(tmp_path / "o"), str(tmp_path / "c"), trigger=None))
    assert spark.read.parquet(str(tmp_path / "o/requests")).count() == 12
    assert spark.read.parquet(str(tmp_path / "o/errors")).where("record = 'HIGH_ERROR_RATE'").count() == 3


def test_bounded_history_over_batches(spark, feed):
    schema = "id bigint, key string, event_ms bigint, value double"
    f = feed(schema).add([(i, "a", i, 1.0) for i in range(5)]).add([(9, "a", 2, 1.0), (10, "a", 50, 1.0), (11, "b", 1, 1.0)])
    history = run.run_available(stateful.bounded_history(f.stream(), "key", 3), "history", 2)
    kept = {(r.key, r.id) for r in run.newest_version(history).collect()}
    assert kept == {("a", 3), ("a", 4), ("a", 10), ("b", 11)}


def test_latest_view_over_batches_with_expiry(spark, feed, tmp_path):
    f = feed(READING).add([reading(1, 0, "a"), reading(2, 0, "b")]).add([reading(3, 90, "a"), reading(4, 80, "a")])
    path = str(tmp_path / "view")
    run.latest_view(f.stream(), "station_id", "timestamp", "id", path, str(tmp_path / "cp"), trigger=None).awaitTermination()
    view = run.read_latest_view(spark, path, "station_id", "timestamp", "id")
    assert {(r.station_id, r.id) for r in view.collect()} == {("a", 3), ("b", 2)}
    fresh = run.read_latest_view(spark, path, "station_id", "timestamp", "id", as_of=START + dt.timedelta(minutes=100))
    assert [r.id for r in fresh.collect()] == [3]


def test_expired_keys_leave_the_stored_view(spark, feed, tmp_path):
    """Twelve batches of ever new stations: what is stored stays bounded, expired stations are deleted, late ones do not stay."""
    f = feed(READING)
    for i in range(12):
        f.add([reading(10 * i + 1, 30 * i, f"s{i}"), reading(10 * i + 2, 30 * i + 1, "steady"), reading(10 * i + 3, 30 * i - 200, "late")])
    path = str(tmp_path / "view")
    stream = f.stream()
    run.latest_view(stream, "station_id", "timestamp", "id", path, str(tmp_path / "cp"), trigger=None, ttl_s=3600,
                    compact_every=3).awaitTermination()
    view = run.read_latest_view(spark, path, "station_id", "timestamp", "id", as_of=run.NEWEST)
    assert {(r.station_id, r.id) for r in view.collect()} == {("s10", 101), ("s11", 111), ("steady", 112)}
    folders = {k: complete_folders(spark, f"{path}/{k}") for k in ("snapshot", "manifest", "delta")}
    assert folders == {"snapshot": ["batch=11", "batch=8"], "manifest": ["batch=11", "batch=8"], "delta": []}
    assert spark.read.parquet(f"{path}/snapshot/batch=11").count() == 3
    assert spark.read.parquet(f"{path}/snapshot/batch=8").count() <= 6


def test_replayed_batches_leave_the_snapshot_alone(spark, feed, tmp_path):
    f = feed(READING).add([reading(1, 0, "a")]).add([reading(2, 1, "b")])
    path = str(tmp_path / "view")
    for checkpoint in ("one", "two"):  # a new checkpoint replays both batches
        run.latest_view(f.stream(), "station_id", "timestamp", "id", path, str(tmp_path / checkpoint), trigger=None,
                        compact_every=2).awaitTermination()
        view = run.read_latest_view(spark, path, "station_id", "timestamp", "id")
        assert {(r.station_id, r.id) for r in view.collect()} == {("a", 1), ("b", 2)}
    assert complete_folders(spark, f"{path}/snapshot") == ["batch=1"] and complete_folders(spark, f"{path}/nothing") == []


def test_event_type_filter_ignores_spacing(spark):
    df = spark.createDataFrame([('{"event_type":"http_response"}',), ('{"event_type": "http_request"}',), ("x",)], "data string")
    assert only_event_type(df, "http_response").count() == 1


def test_weather_stream_writes_both_sinks(spark, feed, tmp_path):
    f = feed("data string")
    text = '{"station_id": "s1", "timestamp": "2024-01-01T00:0%d:00Z", "temperature": 20, "humidity": 50, "pressure": 1000, "wind_speed": 1}'
    f.add([(text % i,) for i in range(3)] + [("broken",)])
    f.add([(text.replace("T00", "T05") % 0,)])
    readings = weather_stream.parse_readings(f.stream())
    with run.started_with(spark, 2):
        run.await_all(spark, weather_stream.weather_stream(readings, str(tmp_path / "o"), str(tmp_path / "c"), trigger=None))
    assert spark.read.parquet(str(tmp_path / "o/enriched")).count() == 4
    assert spark.read.parquet(str(tmp_path / "o/windows")).first().measurement_count == 3


def test_http_defaults(spark):
    df = spark.createDataFrame([('{"event_type": "http_response"}', START, 5)], "data string, arrival_time timestamp, sequence_number int")
    row = http_monitor.response_events(df).first()
    assert (row.path, row.status_code, row.processing_time_ms) == ("unknown", 200, 0.0)


def test_micro_batches_console_and_progress(spark, feed, tmp_path):
    f = feed(READING).add([reading(1, 0)]).add([reading(2, 1)])
    seen = []
    log = run.ProgressLog()
    spark.streams.addListener(log)
    try:
        counted = f.stream().observe("rows", F.count("*").alias("n"))
        query = run.micro_batch(counted, lambda df, i: seen.append((i, df.count())), scratch_path(spark, "micro"), trigger=None)
        query.awaitTermination()
        assert seen == [(0, 1), (1, 1)]
        metrics = run.stream_metrics(query)
        assert metrics.agg(F.sum("input_rows")).first()[0] >= 2
    finally:
        spark.streams.removeListener(log)
    run.to_console(f.stream(), scratch_path(spark, "console"), trigger=None).awaitTermination()
