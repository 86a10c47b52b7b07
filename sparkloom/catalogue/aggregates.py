"""Aggregates, statistics and evaluation metrics."""

from pyspark.sql import functions as F

from ..functions import weather as wx
from ..functions.timeparts import calendar_parts
from ..operators import aggregates as agg, statistics as st
from ..operators.cleaning import apply_mapping, valid_readings
from .cleaning import VALID
from .registry import query, stamp

PROCESSED = [
    ("station_id", "string", "station_id", "string"),
    ("timestamp", "timestamp", "measurement_time", "timestamp"),
    ("temperature", "double", "temperature_celsius", "double"),
    ("humidity", "double", "humidity_percent", "double"),
    ("pressure", "double", "pressure_hpa", "double"),
    ("wind_speed", "double", "wind_speed_kmh", "double"),
]


def processed(t):
    frame = apply_mapping(valid_readings(t.readings), PROCESSED)
    return calendar_parts(frame, "measurement_time").withColumn("data_quality_score", F.lit(100.0))


@query("a01_flight_count", "SELECT TailNum, COUNT(*) AS count FROM {flights} WHERE TailNum IS NOT NULL GROUP BY TailNum")
def _(t):
    return agg.count_per_key(t.flights, "TailNum")


@query("a02_longest_weather_delay", "SELECT CAST(MAX(WeatherDelay) AS BIGINT) AS longest FROM {flights} WHERE Month < 4")
def _(t):
    return agg.max_where(t.flights, "WeatherDelay", F.col("Month") < 4, "longest")


@query("a03_avg_and_count", """
SELECT UniqueCarrier, ROUND(AVG(ArrDelay), 4) AS avg_delay, COUNT(*) AS flights FROM {flights} GROUP BY UniqueCarrier""")
def _(t):
    return agg.avg_and_count(t.flights, "UniqueCarrier", "ArrDelay", "avg_delay", "flights")


@query("a04_multi_agg", """
SELECT Species, ROUND(AVG(Weight), 4) AS "avg_Weight", ROUND(SUM(Length1), 4) AS "sum_Length1" FROM {fish} GROUP BY Species""")
def _(t):
    return agg.multi_agg(t.fish, "Species", {"Weight": "avg", "Length1": "sum"})


@query("a05_median_distance", "SELECT quantile_cont(CAST(Distance AS DOUBLE), 0.5) AS median FROM {flights}")
def _(t):
    return st.percentile_of(t.flights, "Distance", 0.5, "median")


@query("a05_carrier_delay_p95", "SELECT ROUND(quantile_cont(CAST(CarrierDelay AS DOUBLE), 0.95), 4) AS p95 FROM {flights}")
def _(t):
    return st.percentile_of(t.flights, "CarrierDelay", 0.95, "p95")


@query("a05_percentile_per_key", """
SELECT Species, ROUND(quantile_cont(Weight, 0.95), 4) AS p95 FROM {fish} GROUP BY Species""")
def _(t):
    return st.percentile_of(t.fish, "Weight", 0.95, "p95", ["Species"])


@query("a06_ratio", """
SELECT path, ROUND(COUNT(*) FILTER (WHERE status_code >= 400) * 100.0E0 / COUNT(*), 4) AS error_rate FROM {http} GROUP BY path""")
def _(t):
    return agg.ratio_where(t.http, "path", F.col("status_code") >= 400, "error_rate", 100.0)


ROLLUP_SQL = f"""
SELECT station_id, year, month, day, hour, CASE WHEN GROUPING(hour) = 1 THEN 'daily' ELSE 'hourly' END AS aggregation_level,
  ROUND(AVG(temperature), 4) AS avg_temperature, ROUND(MIN(temperature), 4) AS min_temperature,
  ROUND(MAX(temperature), 4) AS max_temperature, ROUND(AVG(humidity), 4) AS avg_humidity,
  ROUND(AVG(pressure), 4) AS avg_pressure, ROUND(AVG(wind_speed), 4) AS avg_wind_speed, MAX(wind_speed) AS max_wind_speed,
  100.0E0 AS avg_data_quality, COUNT(*) AS measurement_count
FROM (SELECT *, year(timestamp) AS year, month(timestamp) AS month, day(timestamp) AS day, hour(timestamp) AS hour
      FROM {{readings}} WHERE {VALID})
GROUP BY GROUPING SETS ((station_id, year, month, day, hour), (station_id, year, month, day))"""


@query("a07_station_rollup", ROLLUP_SQL)
def station_rollup(t):
    return agg.rollup_readings(processed(t))


@query("a08_bucket_stats", f"""
SELECT station_id, {stamp("date_trunc('hour', timestamp)")} AS bucket,
  ROUND(AVG(temperature), 2) AS temperature_mean, ROUND(MIN(temperature), 2) AS temperature_min,
  ROUND(MAX(temperature), 2) AS temperature_max, ROUND(stddev_samp(temperature), 2) AS temperature_std,
  ROUND(AVG(humidity), 2) AS humidity_mean, MIN(humidity) AS humidity_min, MAX(humidity) AS humidity_max
FROM {{readings}} GROUP BY station_id, date_trunc('hour', timestamp)""")
def _(t):
    return agg.bucket_stats(t.readings, "station_id", "timestamp")


DESCRIBE_SQL = " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, COUNT({c}) AS count, ROUND(AVG({c}), 4) AS mean, ROUND(stddev_samp({c}), 4) AS std,
  ROUND(MIN({c}), 4) AS min, ROUND(quantile_cont({c}, 0.25), 4) AS q1, ROUND(quantile_cont({c}, 0.5), 4) AS median,
  ROUND(quantile_cont({c}, 0.75), 4) AS q3, ROUND(MAX({c}), 4) AS max FROM {{fish}}""" for c in ("Weight", "Length1", "Height"))


@query("a09_describe", DESCRIBE_SQL)
def _(t):
    return st.describe(t.fish, ["Weight", "Length1", "Height"])


@query("a10_value_counts", """
SELECT event_type, COUNT(*) AS count, ROUND(COUNT(*) * 100.0E0 / (SELECT COUNT(*) FROM events), 4) AS percentage
FROM events GROUP BY event_type""")
def _(t):
    return agg.value_counts(t.events, "event_type")


@query("a11_n_distinct", "SELECT COUNT(DISTINCT station_id) AS n_stations FROM {readings}")
def _(t):
    return agg.n_distinct(t.readings, "station_id", "n_stations")


@query("a11_distinct_list", "SELECT DISTINCT station_id FROM {readings}")
def _(t):
    return agg.distinct_values(t.readings, "station_id")


NUMERIC = ["Weight", "Length1", "Length2", "Width"]
CORR_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, ROUND(corr({a}, {b}), 4) AS corr FROM {{fish}}" for a in NUMERIC for b in NUMERIC)


@query("a12_corr_matrix", CORR_SQL)
def _(t):
    return st.corr_matrix(t.fish, NUMERIC)


@query("a12_corr_with_target", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, ROUND(corr({c}, Weight), 4) AS corr, ROUND(abs(corr({c}, Weight)), 4) AS abs_corr FROM {{fish}}"
    for c in NUMERIC[1:]))
def _(t):
    return st.corr_with_target(t.fish, NUMERIC[1:], "Weight")


@query("a14_least_squares", """
SELECT ROUND(COALESCE(regr_intercept(y, x), 0.0), 4) AS intercept, ROUND(COALESCE(regr_slope(y, x), 0.0), 4) AS slope
FROM (SELECT DepDelay AS x, AVG(WeatherDelay) AS y FROM {flights} WHERE DepDelay >= 0 GROUP BY DepDelay)""")
def _(t):
    return st.least_squares(t.flights, "DepDelay", "WeatherDelay")


@query("a15_latest_per_key", f"""
SELECT id, station_id, {stamp('r.timestamp')} AS timestamp, ROUND(temperature, 4) AS temperature FROM {{readings}} r
QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY r.timestamp DESC, id DESC) = 1""")
def _(t):
    return agg.latest_per_key(t.readings.select("id", "station_id", "timestamp", "temperature"), "station_id", "timestamp", "id")


@query("a16_avg_of_latest", """
SELECT COUNT(*) AS stations, ROUND(AVG(temperature), 4) AS avg_temperature, ROUND(AVG(wind_speed), 4) AS avg_wind_speed
FROM (SELECT * FROM {readings} r QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY r.timestamp DESC, id DESC) = 1)""")
def _(t):
    return agg.avg_of_latest(t.readings, "station_id", "timestamp", "id", ["temperature", "wind_speed"])


@query("a17_avg_since", """
SELECT station_id, ROUND(AVG(temperature), 4) AS avg_temperature FROM {readings}
WHERE timestamp > TIMESTAMP '2024-01-28 12:00:00' - INTERVAL 24 HOUR GROUP BY station_id""")
def _(t):
    return agg.avg_since(t.readings, "station_id", "temperature", "timestamp", "2024-01-28 12:00:00", 24)


@query("a19_sensor_stats", """
SELECT station_id, COUNT(*) AS data_points, ROUND(AVG(temperature), 2) AS average_temperature,
  ROUND(MIN(temperature), 4) AS min_temperature, ROUND(MAX(temperature), 4) AS max_temperature,
  ROUND(arg_max(temperature, r.timestamp), 4) AS latest_temperature FROM {readings} r GROUP BY station_id""")
def _(t):
    return agg.sensor_stats(t.readings, "station_id", "temperature", "timestamp", "id")


@query("a20_dataset_summary", f"""
SELECT COUNT(*) AS total_measurements, COUNT(DISTINCT station_id) AS station_count, ROUND(MIN(temperature), 4) AS min_temperature,
  ROUND(MAX(temperature), 4) AS max_temperature, ROUND(AVG(temperature), 4) AS avg_temperature,
  {stamp('MAX(r.timestamp)')} AS latest_measurement FROM {{readings}} r""")
def _(t):
    return agg.dataset_summary(t.readings, "station_id", "temperature", "timestamp")


@query("a21_collect_values", """
SELECT station_id, string_agg(level || ':' || n, ',' ORDER BY level) AS alerts, CAST(SUM(n) AS BIGINT) AS total FROM (
  SELECT station_id, CASE WHEN temperature > 35 THEN 'HIGH_HEAT' WHEN temperature < -10 THEN 'EXTREME_COLD'
    WHEN wind_speed > 100 THEN 'HIGH_WIND' ELSE 'NORMAL' END AS level, COUNT(*) AS n FROM {readings} GROUP BY 1, 2)
GROUP BY station_id""")
def _(t):
    leveled = t.readings.select("station_id", wx.alert_level("temperature", "wind_speed").alias("level"))
    grouped = agg.collect_values(leveled, ["station_id"], "level", "alerts")
    text = F.array_join(F.transform("alerts", lambda a: F.concat_ws(":", a["value"], a["n"].cast("string"))), ",")
    total = F.aggregate("alerts", F.lit(0).cast("bigint"), lambda acc, a: acc + a["n"])
    return grouped.select("station_id", text.alias("alerts"), total.alias("total"))


@query("a23_histogram", """
SELECT b AS bin, ROUND(lo + b * w, 4) AS bin_start, ROUND(lo + (b + 1) * w, 4) AS bin_end,
  (SELECT COUNT(*) FROM {fish} f WHERE least(19, floor((f.Weight - lo) / w)) = b) AS count
FROM (SELECT MIN(Weight) AS lo, (MAX(Weight) - MIN(Weight)) / 20 AS w FROM {fish}), range(20) r(b)""")
def _(t):
    return st.histogram(t.fish, "Weight", 20)


@query("a24_error_by_bin", """
SELECT CAST(greatest(1, least(5, ceil((actual - lo) / w))) AS BIGINT) AS bin, ROUND(AVG(abs(predicted - actual)), 4) AS mean_abs_error, COUNT(*) AS n
FROM {scored}, (SELECT MIN(actual) AS lo, (MAX(actual) - MIN(actual)) / 5 AS w FROM {scored}) GROUP BY 1""")
def _(t):
    return st.error_by_bin(t.scored, "actual", "predicted")


@query("a25_box_stats", """
SELECT Species, ROUND(MIN(Weight), 4) AS min, ROUND(quantile_cont(Weight, 0.25), 4) AS q1, ROUND(quantile_cont(Weight, 0.5), 4) AS median,
  ROUND(quantile_cont(Weight, 0.75), 4) AS q3, ROUND(MAX(Weight), 4) AS max FROM {fish} GROUP BY Species""")
def _(t):
    return st.box_stats(t.fish, "Species", "Weight")


@query("a26_regression_metrics", """
SELECT COUNT(*) AS n, ROUND(AVG(pow(actual - predicted, 2)), 2) AS mse, ROUND(sqrt(AVG(pow(actual - predicted, 2))), 4) AS rmse,
  ROUND(AVG(abs(actual - predicted)), 4) AS mae, ROUND(1 - AVG(pow(actual - predicted, 2)) / var_pop(actual), 4) AS r2,
  ROUND(AVG(abs(actual - predicted) / actual) * 100, 4) AS mape FROM {scored}""")
def _(t):
    return st.regression_metrics(t.scored, "actual", "predicted").withColumn("mse", F.round("mse", 2))


@query("a26_overfit_check", """
SELECT ROUND(a.r2, 4) AS train_r2, ROUND(b.r2, 4) AS test_r2, ROUND(a.r2 - b.r2, 4) AS r2_difference, a.r2 - b.r2 > 0.1 AS overfit
FROM (SELECT 1 - AVG(pow(actual - predicted, 2)) / var_pop(actual) AS r2 FROM {scored} WHERE row_id % 5 <> 0) a,
     (SELECT 1 - AVG(pow(actual - predicted, 2)) / var_pop(actual) AS r2 FROM {scored} WHERE row_id % 5 = 0) b""")
def _(t):
    train, test = t.scored.where("row_id % 5 <> 0"), t.scored.where("row_id % 5 = 0")
    return st.overfit_check(st.regression_metrics(train, "actual", "predicted"), st.regression_metrics(test, "actual", "predicted"))


@query("a27_classification_metrics", """
WITH c AS (SELECT label, called, confidence FROM {scored}),
k AS (SELECT DISTINCT label AS k FROM c),
per AS (SELECT k, COUNT(*) FILTER (WHERE label = k AND called = k) * 1.0E0 AS tp, COUNT(*) FILTER (WHERE label = k) * 1.0E0 AS sup,
               COUNT(*) FILTER (WHERE called = k) * 1.0E0 AS cal FROM c, k GROUP BY k),
s AS (SELECT *, tp / cal AS p, tp / sup AS r, 2 * tp / (cal + sup) AS f FROM per)
SELECT ROUND(SUM(tp) / SUM(sup), 4) AS accuracy, ROUND(SUM(p * sup) / SUM(sup), 4) AS precision, ROUND(SUM(r * sup) / SUM(sup), 4) AS recall,
  ROUND(SUM(f * sup) / SUM(sup), 4) AS f1, ROUND(AVG(p), 4) AS macro_precision, ROUND(AVG(r), 4) AS macro_recall,
  ROUND(AVG(f), 4) AS macro_f1, CAST(SUM(sup) AS BIGINT) AS n, (SELECT ROUND(AVG(confidence), 4) FROM c) AS mean_confidence FROM s""")
def _(t):
    return st.classification_metrics(t.scored, "label", "called", "confidence")


@query("a27_class_report", """
WITH k AS (SELECT DISTINCT label AS label FROM {scored})
SELECT k.label AS label, ROUND(COUNT(*) FILTER (WHERE c.label = k.label AND called = k.label) * 1.0E0 / COUNT(*) FILTER (WHERE called = k.label), 4) AS precision,
  ROUND(COUNT(*) FILTER (WHERE c.label = k.label AND called = k.label) * 1.0E0 / COUNT(*) FILTER (WHERE c.label = k.label), 4) AS recall,
  COUNT(*) FILTER (WHERE c.label = k.label) AS support FROM {scored} c, k GROUP BY k.label""")
def _(t):
    return st.class_report(t.scored, "label", "called").select("label", "precision", "recall", "support")


@query("a28_confusion", """
WITH seen AS (SELECT DISTINCT event_type AS c FROM events),
pairs AS (SELECT event_type AS a, CASE WHEN event_id % 3 = 0 THEN 'click' ELSE event_type END AS p FROM events)
SELECT x.c AS actual, y.c AS predicted, (SELECT COUNT(*) FROM pairs WHERE a = x.c AND p = y.c) AS count FROM seen x, seen y""")
def _(t):
    guess = F.when(F.col("event_id") % 3 == 0, "click").otherwise(F.col("event_type"))
    return st.confusion(t.events.select(F.col("event_type").alias("a"), guess.alias("p")), "a", "p")


@query("a29_tool_call_scores", """
SELECT ROUND(AVG(CASE WHEN event_id % 7 = 0 OR event_id % 5 <> 0 THEN 1.0E0 ELSE 0.0E0 END), 4) AS tool_accuracy,
  ROUND(AVG(CASE WHEN event_id % 7 <> 0 AND event_id % 5 <> 0 THEN 1.0E0 ELSE 0.0E0 END), 4) AS exact_match, COUNT(*) AS total_samples
FROM events WHERE event_id % 11 <> 0""")
def _(t):
    return st.score_tool_calls(t.calls, "answers", "predicted")


@query("a30_usage_per_day", """
SELECT CAST(CAST(day AS DATE) AS VARCHAR) AS day, service, ROUND(SUM(cost), 4) AS cost, ROUND(SUM(usage), 4) AS usage
FROM {usage} u GROUP BY CAST(day AS DATE), service""")
def _(t):
    return agg.usage_rollup(t.usage, "day", "service", "cost", "usage")


@query("a30_usage_total", """
SELECT ROUND(SUM(cost), 2) AS total_cost, ROUND(SUM(cost) / 30, 2) AS average_daily_cost, COUNT(DISTINCT CAST(day AS DATE)) AS days_with_data
FROM {usage} u""")
def _(t):
    total = agg.usage_total(agg.usage_rollup(t.usage, "day", "service", "cost", "usage"), 30)
    return total.withColumns({"total_cost": F.round("total_cost", 2), "average_daily_cost": F.round("average_daily_cost", 2)})


@query("a31_endpoint_report", """
SELECT path, COUNT(*) AS total_invocations, ROUND(AVG(processing_time_ms), 2) AS average_latency_ms,
  COUNT(*) FILTER (WHERE status_code >= 400) AS total_errors,
  ROUND(COUNT(*) FILTER (WHERE status_code >= 400) * 100.0E0 / COUNT(*), 2) AS error_rate FROM {http} GROUP BY path""")
def _(t):
    failed = F.when(F.col("status_code") >= 400, 1).otherwise(0)
    return agg.endpoint_report(t.http, "path", "processing_time_ms", F.lit(1), failed)


@query("a32_job_stats", """
SELECT COUNT(*) AS total_jobs, COUNT(*) FILTER (WHERE status = 'Completed') AS completed_jobs,
  COUNT(*) FILTER (WHERE status = 'Failed') AS failed_jobs, COUNT(*) FILTER (WHERE status = 'InProgress') AS running_jobs,
  ROUND(COUNT(*) FILTER (WHERE status = 'Completed') * 100.0E0 / COUNT(*), 4) AS success_rate,
  ROUND(COUNT(*) FILTER (WHERE status = 'Failed') * 1.0E0 / COUNT(*), 4) AS failure_rate,
  COUNT(*) FILTER (WHERE status = 'Failed') * 5 > COUNT(*) AS high_failure_rate FROM {jobs}""")
def _(t):
    return agg.job_stats(t.jobs, "status")


@query("a33_label_counts", "SELECT CAST(quality AS BIGINT) AS label, COUNT(*) AS count FROM labels GROUP BY quality")
def _(t):
    return agg.count_per_key(t.labels.withColumnRenamed("quality", "label"), "label")
