import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from sparkloom.functions import documents as doc, numbers as num, text as txt, timeparts as tp, weather as wx
from sparkloom.ml import forecast, textprep
from sparkloom.operators import cleaning, validation as val
from sparkloom.operators.joins import lookup
from sparkloom.operators.statistics import confusion, histogram, regression_metrics, score_tool_calls
from sparkloom.plans import tool_calls, usage
from sparkloom.sources import envelope

NOW = "2024-02-01 00:00:00"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_weather_corners(spark):
    t, h, w = F.lit(26.99), F.lit(50.0), F.lit(4.8)
    assert one(spark, wx.heat_index(t, h)) == 26.99
    assert one(spark, wx.heat_index(F.lit(27.0), F.lit(40.0), "stream")) == pytest.approx(-42.379 + 2.04901523 * 27 + 10.14333127 * 40)
    assert one(spark, wx.wind_chill(F.lit(10.0), w)) != 10.0
    assert one(spark, wx.wind_chill(F.lit(10.1), w)) == 10.1
    assert one(spark, wx.wind_chill(F.lit(5.0), F.lit(4.7))) == 5.0
    assert one(spark, wx.dew_point(F.lit(20.0), F.lit(0.0))) is None
    assert one(spark, wx.dew_point(F.lit(20.0), F.lit(100.0), 2)) == 20.0


@pytest.mark.parametrize("t,w,level", [(35.0, 0.0, "NORMAL"), (35.1, 200.0, "HIGH_HEAT"), (-10.0, 0.0, "NORMAL"),
                                       (-10.1, 0.0, "EXTREME_COLD"), (0.0, 100.0, "NORMAL"), (0.0, 100.1, "HIGH_WIND")])
def test_alert_level(spark, t, w, level):
    assert one(spark, wx.alert_level(F.lit(t), F.lit(w))) == level


@pytest.mark.parametrize("t,w,kinds", [(40.0, 80.0, []), (40.1, 0.0, [("temperature", "medium")]), (45.1, 80.1, [("temperature", "high"), ("wind", "high")]),
                                       (-20.0, 0.0, []), (-20.1, 0.0, [("temperature", "medium")])])
def test_reading_alerts(spark, t, w, kinds):
    found = one(spark, wx.reading_alerts(F.lit("s"), F.lit(t), F.lit(w), F.lit(NOW)))
    assert [(a.alert_type, a.severity) for a in found] == kinds


def test_bounds_are_inclusive_and_null_fails(spark):
    cols = "station_id string, timestamp string, temperature double, humidity double, pressure double, wind_speed double, wind_direction double"
    good = [("s", NOW, -50.0, 0.0, 800.0, 200.0, 0.0), ("s", NOW, 60.0, 100.0, 1200.0, -1.0, 360.0)]
    bad = [("s", NOW, -50.1, 0.0, 800.0, 0.0, 0.0), ("s", NOW, 0.0, 100.1, 800.0, 0.0, 0.0), ("s", NOW, 0.0, 0.0, 799.9, 0.0, 0.0),
           ("s", NOW, 0.0, 0.0, 800.0, 200.1, 0.0), ("s", NOW, 0.0, 0.0, 800.0, 0.0, 360.1), (None, NOW, 0.0, 0.0, 800.0, 0.0, 0.0),
           ("s", None, 0.0, 0.0, 800.0, 0.0, 0.0), ("s", NOW, None, 0.0, 800.0, 0.0, 0.0)]
    df = spark.createDataFrame(good + bad, cols)
    assert cleaning.valid_readings(df).count() == 2


def test_validation_messages(spark):
    df = spark.createDataFrame([(61.0, 0.0, 1000.0, 201.0, 10.0), (0.05, 0.01, 1000.0, 1.0, 10.0)],
                               "temperature double, humidity double, pressure double, wind_speed double, wind_direction double")
    hot, odd = val.validate(df, val.reading_rules()).collect()
    assert hot.errors == ["Temperature 61.0°C out of range [-50.0, 60.0]", "Wind speed 201.0 km/h exceeds maximum 200.0"]
    assert odd.is_valid and odd.warnings == ["Suspiciously low readings - possible sensor malfunction"]


def test_measurement_and_sensor_and_fish_rules(spark):
    schema = ("station_id string, timestamp timestamp, temperature double, humidity double, pressure double, wind_speed double,"
              "wind_direction double, location struct<latitude: double, longitude: double>")
    at = dt.datetime(2024, 1, 1)
    rows = [("s", at, None, None, None, None, None, None), (None, None, 101.0, -1.0, 700.0, -1.0, 361.0, (None, 181.0))]
    blank, broken = val.validate(spark.createDataFrame(rows, schema), val.measurement_rules()).collect()
    assert blank.is_valid and len(broken.errors) == 9
    sensors = spark.createDataFrame([(" ", 20.0), ("a", None), ("a", 100.1), ("a", 100.0)], "sensor_id string, temperature double")
    assert [len(r.errors) for r in val.validate(sensors, val.sensor_rules()).collect()] == [1, 1, 1, 0]
    warned = val.validate(sensors, val.sensor_rules("warning")).collect()[2]
    assert warned.is_valid and warned.warnings == ["Temperature value out of reasonable range: 100.1"]
    fish = spark.createDataFrame([("Pike", 1.0), ("Shark", 0.0), ("Pike", 100.1)], "species string, length1 double")
    assert [len(r.errors) for r in val.validate(fish, val.fish_rules(measures=["length1"])).collect()] == [0, 2, 1]


def test_contract_check_names_absent_columns(spark):
    with pytest.raises(ValueError, match="b"):
        val.check_dataset(spark.range(1), ["id", "b"])


CALL = {"name": "convert_units", "arguments": {"value": 12, "to": "mi"}}


@pytest.mark.parametrize("text,expected", [
    (json.dumps([CALL]), [CALL]),
    (json.dumps(CALL), [CALL]),
    ('I would do this [{"name": "sum_rows", "arguments": {"n": 2}}], is that fine?', [{"name": "sum_rows", "arguments": {"n": 2}}]),
    ("no list in this answer", []),
    ('[{"arguments": {}}]', []),
    ('[{"name": "a"}, 5]', []),
    ('[{"name": "a", "argum', []),
    ('[{"name": "a"}] trailing ]', []),
    ('{"name": "a"} and }', []),
    ('{"name": "a"} and {', [{"name": "a"}]),
    ("[]", []),
    ("] [", []),
    (None, []),
])
def test_parse_tool_calls(spark, text, expected):
    found = spark.createDataFrame([(text,)], "t string").select(txt.parse_tool_calls("t").alias("c")).first().c
    assert [(c.name, None if c.arguments is None else json.loads(c.arguments)) for c in found] == \
        [(c["name"], c.get("arguments")) for c in expected]


def test_dataset_row_validity(spark):
    rows = [("where is it", '[{"name": "locate"}]'), (None, "[1]"), ("", "{}"), ("where", "{1"), ("where", "")]
    df = spark.createDataFrame(rows, "query string, tools string")
    assert [r.ok for r in df.select(txt.valid_dataset_row("query", "tools").alias("ok")).collect()] == [True, False, False, False, False]


@pytest.mark.parametrize("truth,predicted,same_tools,same_calls,total", [
    ('[{"name": "a", "arguments": {"x": 1, "y": 2}}]', '[{"arguments": {"y": 2, "x": 1}, "name": "a"}]', 1.0, 1.0, 1),
    ('[{"name": "a", "arguments": {"x": 1}}]', '[{"name": "a", "arguments": {"x": 3}}]', 1.0, 0.0, 1),
    ('[{"name": "a"}, {"name": "b"}]', '[{"name": "b"}, {"name": "a"}]', 1.0, 0.0, 1),
    ('[{"arguments": {}}]', "[]", 0.0, 0.0, 1),
    ('[{"arguments": {}}]', '[{"name": ""}]', 1.0, 0.0, 1),
    ("[5]", "[]", 0.0, 0.0, 1),
    ('{"name": "a"}', '[{"name": "a"}]', 0.0, 0.0, 1),
    ('[{"name": "a", "name": "b"}]', '[{"name": "b"}]', 1.0, 1.0, 1),
    ("[]", "[]", 1.0, 1.0, 1),
    ("[] x", "[]", None, None, 0),
    (None, "[]", None, None, 0),
])
def test_call_scores(spark, truth, predicted, same_tools, same_calls, total):
    scores = score_tool_calls(spark.createDataFrame([(truth, predicted)], "a string, p string"), "a", "p").first()
    assert (scores.tool_accuracy, scores.exact_match, scores.total_samples) == (same_tools, same_calls, total)


def test_salted_join_refuses_unmatched_dimension_rows(spark):
    fact, dim = spark.range(5).withColumn("v", F.col("id")), spark.range(3, 9).withColumn("w", F.col("id"))
    for how in ("inner", "left"):
        assert sorted(map(str, lookup(fact, dim, "id", how, 4).collect())) == sorted(map(str, lookup(fact, dim, "id", how).collect()))
    for how in ("right", "full", "outer"):
        with pytest.raises(ValueError):
            lookup(fact, dim, "id", how, 4)


def test_tool_prompt_layout(spark):
    tools = '[{"name": "b", "a": {"z": 1, "é": []}}]'
    row = spark.createDataFrame([("find it", tools, '[{"name":"b"}]')], "q string, t string, a string").select(
        txt.tool_prompt("q", "t").alias("p"), txt.tool_prompt("q", "t", "a").alias("full")).first()
    assert json.dumps(json.loads(tools), indent=2) in row.p
    assert row.p.endswith("User Query: find it\n\nTool Calls:") and row.full == row.p + ' [{"name": "b"}]'


def test_fill_answers_one_row_each(spark):
    df = spark.createDataFrame([(1, "q", "[]"), (2, "q", "bad"), (3, "q", "[]")], "id bigint, query string, tools string")
    responses = spark.createDataFrame([(1, 'x [{"name": "a\\"b", "arguments": {"k": 1}}]'), (2, '[{"name": "a"}]')], "id bigint, r string")
    got = {r.id: r.my_answers for r in tool_calls.answered(df, responses, "id", "r").collect()}
    assert json.loads(got[1]) == [{"name": 'a"b', "arguments": {"k": 1}}] and got[2] == got[3] == "[]"


def test_training_set_splits_in_order(spark):
    df = spark.createDataFrame([(i, "q", "[]", "[]" if i != 3 else "oops") for i in range(11)], "id bigint, query string, tools string, answers string")
    got = {r.id: r.is_train for r in textprep.tool_training_set(df.withColumn("at", F.col("id")), "at", "id").collect()}
    assert got == {i: i < 9 for i in range(11) if i != 3}


def test_envelopes(spark):
    rows = [("sensors/s1/temperature", '{"temp": 21.5, "hum": 40, "timestamp": "2024-01-01T00:00:00Z"}'), ("x", "{}"), ("iot/s2/a", "garbage")]
    df = spark.createDataFrame(rows, "topic string, payload string")
    a, b, c = envelope.parse_envelope(df, now=NOW).collect()
    assert (a.sensor_id, a.temperature, a.humidity, a.location, a.timestamp) == ("s1", 21.5, 40.0, "unknown", dt.datetime(2024, 1, 1))
    assert (b.sensor_id, b.temperature, b.timestamp) == ("unknown", 0.0, dt.datetime(2024, 2, 1)) and c.sensor_id == "s2"
    plain = spark.createDataFrame([("sensor/temperature/S9", " 21.5 "), ("a/b", "3"), ("a/b/+", "7"), ("a", "junk"),
                                   ("a", '{"sensor_id": "j", "temperature": 1.5}')], "topic string, payload string")
    got = [(r.sensor_id, r.temperature) for r in envelope.parse_payload(plain, now=NOW).collect()]
    assert got == [("S9", 21.5), ("unknown", 3.0), ("default", 7.0), ("j", 1.5)]
    record = envelope.parse_record(spark.createDataFrame([("weather/st/data", '{"temperature": 1, "unit": "c"}')], "topic string, payload string"), now=NOW).first()
    assert (record.station_id, record.pressure, record.metadata) == ("st", 0.0, {"unit": "c"})


def test_maps_and_times(spark):
    df = spark.createDataFrame([({"a": "1"},), ({},), (None,)], "m map<string,string>")
    got = df.select(doc.map_to_json("m").alias("j"), doc.enrich_map("m", {"a": F.lit(2), "b": F.lit("x")}).alias("e")).collect()
    assert [r.j for r in got] == ['{"a":"1"}', None, None] and all(r.e == {"a": "2", "b": "x"} for r in got)
    assert one(spark, tp.parse_ts(F.lit("2024-01-01T02:00:00+02:00"))) == dt.datetime(2024, 1, 1)
    assert one(spark, tp.parse_ts(F.lit("no"))) is None
    assert one(spark, num.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0))) == pytest.approx(20015.09, abs=0.01)


def test_metrics_edge_cases(spark):
    df = spark.createDataFrame([(0.0, 1.0), (10.0, 9.0)], "y double, p double")
    row = regression_metrics(df, "y", "p").first()
    assert (row.mse, row.mae, row.mape) == (1.0, 1.0, 10.0) and row.r2 == pytest.approx(0.96)
    flat = histogram(spark.createDataFrame([(3.0,)] * 4, "v double"), "v", 4).collect()
    assert sum(r["count"] for r in flat) == 4
    grid = confusion(spark.createDataFrame([("a", "b")], "y string, p string"), "y", "p").collect()
    assert {(r.actual, r.predicted): r["count"] for r in grid} == {("a", "a"): 0, ("a", "b"): 1, ("b", "a"): 0, ("b", "b"): 0}


def test_cost_recommendations(spark):
    costs = spark.createDataFrame([(dt.datetime(2024, 1, d), "s", 20.0, 1.0) for d in range(1, 31)], "day timestamp, service string, cost double, usage double")
    jobs = spark.createDataFrame([("a", s) for s in ["Completed"] * 2 + ["Failed"] + ["InProgress"] * 4], "name string, status string")
    summary = usage.usage_summary(costs, jobs, 700.0)
    assert summary.first().budget_status == "WARNING"
    assert [r.recommendation.split(" (")[0] for r in usage.recommendations(summary).orderBy("position").collect()] == [
        "High daily average cost", "Multiple jobs running"]
    calm = usage.usage_summary(costs.limit(1), jobs.limit(2), 0.0)
    assert usage.recommendations(calm).count() == 4 and calm.first().budget_pct == 0.0


def test_recursive_forecast_by_hand(spark):
    """Every hour of two sensors, features worked out in Python, each scored by the fitted stages alone."""
    start = dt.datetime(2024, 1, 30, 12)
    rows = [(100 * s + i, f"s{s}", start + dt.timedelta(hours=i), None if (s, i) == (0, 35) else 10.0 * s + (i * 7 % 13), 40.0 + i)
            for s in (0, 1) for i in range(40)]
    rows += [(900 + i, "short", start + dt.timedelta(hours=i), 1.0, 50.0) for i in range(23)]
    readings = spark.createDataFrame(rows, "id bigint, key string, ts timestamp, temperature double, humidity double")
    features = forecast.recursive_features(readings, "key", "ts", "id")
    model = forecast.train_sensor_model(features, forecast.RECURSIVE_FEATURES, "ts", "id", trees=4, depth=4)
    found = forecast.forecast_recursive(readings, model, "key", "ts", "id", days=1)
    got = {(r.key, r.timestamp): r.temperature for r in found.collect()}
    assert len(got) == 48 and {k for k, _ in got} == {"s0", "s1"}
    past = {s: [r[3] for r in rows if r[1] == s and r[3] is not None][-24:] for s in ("s0", "s1")}
    last = start + dt.timedelta(hours=39)
    for hour in range(1, 4):
        at = last + dt.timedelta(hours=hour)
        made = [(s, at.hour, at.weekday(), at.month, at.timetuple().tm_yday, v[-1], v[-2], v[-24], sum(v[-3:]) / 3,
                 sum(v[-6:]) / 6, sum(v[-12:]) / 12, 79.0) for s, v in past.items()]
        frame = spark.createDataFrame(made, ["key", *forecast.RECURSIVE_FEATURES])
        for r in model.stages.transform(frame).collect():
            assert got[r.key, at] == pytest.approx(r.prediction, abs=0.00501)
            past[r.key] = [*past[r.key], r.prediction]


def test_recursive_forecast_of_nothing(spark):
    readings = spark.createDataFrame([(i, "a", dt.datetime(2024, 1, 1, i % 24), float(i), 1.0) for i in range(40)],
                                     "id bigint, key string, ts timestamp, temperature double, humidity double")
    model = forecast.train_sensor_model(forecast.recursive_features(readings, "key", "ts", "id"),
                                        forecast.RECURSIVE_FEATURES, "ts", "id", trees=2, depth=2)
    assert forecast.forecast_recursive(readings.where("id < 0"), model, "key", "ts", "id").collect() == []
