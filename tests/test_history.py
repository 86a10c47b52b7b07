"""Row-history windows against pandas, with runs small enough to hand rows on."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkloom.operators import resetting, windows

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def readings(spark):
    rng, rows, n = random.Random(3), [], 0
    for sensor, count, gap in (("hot", 400, 200), ("slow", 40, 9000), ("single", 1, 1)):
        at = START
        for _ in range(count):
            at += dt.timedelta(seconds=rng.randint(0, gap))
            rows.append((n, sensor, at, round(rng.uniform(-10, 30), 3)))
            n += 1
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "id bigint, sensor string, at timestamp, t double")


def expected(readings, make):
    pdf = readings.toPandas().sort_values(["sensor", "at", "id"])
    pdf["x"] = pdf.groupby("sensor")["t"].transform(make)
    return {int(i): (None if pd.isna(x) else x) for i, x in zip(pdf["id"], pdf["x"])}


@pytest.mark.parametrize("run_rows", [24, 60, 10_000])
@pytest.mark.parametrize("slot_seconds", [60, 1800, 10 * 86400])
def test_lag_over_runs(readings, run_rows, slot_seconds):
    got = windows.lags(readings, ["sensor"], "at", "id", "t", [1, 24], slot_seconds=slot_seconds, run_rows=run_rows)
    rows = got.select("id", "temp_lag_24").collect()
    assert len(rows) == readings.count()
    assert {r[0]: r[1] for r in rows} == expected(readings, lambda s: s.shift(24))


def test_rolling_mean_is_null_until_full(readings):
    got = windows.rolling(readings, ["sensor"], "at", "id", "t", [12], slot_seconds=600, run_rows=30)
    want = expected(readings, lambda s: s.rolling(12).mean())
    for r in got.select("id", "temp_mean_12").collect():
        assert r[1] == (None if want[r[0]] is None else pytest.approx(want[r[0]]))


def test_a_hot_key_is_spread_over_runs(readings):
    runs = windows.with_lookback(readings, ["sensor"], "at", 6, "id", slot_seconds=600, run_rows=50)
    sizes = [r["count"] for r in runs.where("sensor = 'hot'").groupBy("_run").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 120


def test_a_crowded_slot_is_cut(readings):
    runs = windows.with_lookback(readings, ["sensor"], "at", 6, "id", slot_seconds=10 * 86400, run_rows=50)
    sizes = [r["count"] for r in runs.where("sensor = 'hot'").groupBy("_run").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 200


def test_lookback_refuses_runs_smaller_than_the_frame(readings):
    with pytest.raises(ValueError):
        windows.with_lookback(readings, ["sensor"], "at", 24, "id", run_rows=10)


def walk(events, window):
    out, start, n = {}, None, 0
    for ms, i in sorted(events):
        if start is None or ms - start > window:
            start, n = ms, 0
        n += 1
        out[i] = (start, n)
    return out


@pytest.mark.parametrize("slot_windows", [2, 3, 12])
@pytest.mark.parametrize("seed", range(4))
def test_reset_windows_equal_a_walk(spark, seed, slot_windows, monkeypatch):
    rng, events, at = random.Random(seed), [], 1_700_000_000_000
    for i in range(300):
        at += rng.choice([0, 1, 50, 300, 999, 1000, 1001, 5000, 90_000])
        events.append((at, i))
    df = spark.createDataFrame([("/a", m, i) for m, i in events] + [("/b", events[0][0], 900)], "path string, ms bigint, id bigint")
    starts = {r["_ms"]: r["window_start"] for r in resetting.window_starts(df, "path", "ms", 1000, slot_windows).where("_k = '/a'").collect()}
    assert starts == {m: walk(events, 1000)[i][0] for m, i in events}


def test_reset_boundary_is_exclusive(spark):
    df = spark.createDataFrame([("/a", 0, 1), ("/a", 300_000, 2), ("/a", 300_001, 3)], "path string, ms bigint, id bigint")
    counts = {r.id: r.request_count for r in resetting.request_counts(df, "path", "ms", "id").collect()}
    assert counts == {1: 1, 2: 2, 3: 1}


def test_composed_exit_tables_equal_the_walk():
    """Tables of neighbouring slots compose to that of both, and stay within the event times of one window."""
    rng = np.random.default_rng(6)
    for case in range(60):
        window = int(rng.integers(3, 60))
        times = np.unique(rng.integers(0, 400, rng.integers(3, 200)))
        cuts = np.unique(rng.integers(1, len(times), rng.integers(1, 6)))
        whole = None
        for part in np.split(times, cuts):
            table = resetting.exit_table(part, window)
            whole = table if whole is None else resetting.compose(whole, table, window)
        assert len(whole) <= (times < times[0] + window).sum() + 1
        for start in range(int(times[0]) - window, int(times[0])):
            leaves = resetting.chain_starts(times, window, start)[-1]
            at, met = resetting._look_up(whole, np.array([start + window]))
            assert (whole["leaves"].iloc[at[0]] if met[0] else start) == leaves, (case, start)


@pytest.mark.parametrize("slot_times, group_rows", [(200, 300), (5000, 100_000)])
def test_a_heartbeat_key_is_spread_over_bounded_groups(spark, slot_times, group_rows, monkeypatch):
    """One key with an event every 10 ms, whose chains never meet, beside ordinary keys and a null one."""
    events = [("beat", 10 * i, i) for i in range(20_000)] + [(None, 777 * i, 50_000 + i) for i in range(50)]
    events += [(f"k{i % 7}", 431 * i, 60_000 + i) for i in range(700)]
    df = spark.createDataFrame(events, "path string, ms bigint, id bigint")
    groups = []
    real = resetting._grouped

    def seen(exits, rows):
        found, whole = real(exits, rows)
        joined = resetting._in_groups(exits, found).groupBy("_k", "_group").count()
        most = exits.groupBy("_k", "_slot").count().agg(F.max("count")).first()[0]
        groups.append((joined.agg(F.max("count")).first()[0], max(rows, 4 * most) + most, whole))
        return found, whole

    monkeypatch.setattr(resetting, "_grouped", seen)
    got = resetting.window_starts(df, "path", "ms", 1000, 12, slot_times=slot_times, group_rows=group_rows)
    sizes = got.count()
    assert sizes == len({(k, m) for k, m, _ in events})
    starts = {(r["_k"], r["_ms"]): r["window_start"] for r in got.collect()}
    for key in ("beat", None, "k3"):
        mine = [(m, i) for k, m, i in events if k == key]
        expected = walk(mine, 1000)
        assert all(starts[key, m] == expected[i][0] for m, i in mine)
    assert all(rows <= bound for rows, bound, _ in groups) and groups[-1][2]
    assert len(groups) > 1 if group_rows == 300 else len(groups) == 1
