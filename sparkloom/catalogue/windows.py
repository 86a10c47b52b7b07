"""Row-history and latest-per-key windows."""

from pyspark.sql import functions as F

from .. import fixed_values as fx
from ..operators import order_stats, windows as ops
from ..operators.aggregates import value_counts
from .registry import query, stamp

OVER = "OVER (PARTITION BY station_id ORDER BY r.timestamp, id)"
#: small runs, so that the hand-over between runs is exercised on small tables too
SIZING = {"slot_seconds": 6 * 3600, "run_rows": 200}


def sensor(t):
    return t.readings.select("id", "station_id", "timestamp", "temperature", "humidity")


@query("w01_lags", "SELECT id, " + ", ".join(
    f"ROUND(lag(temperature, {n}) {OVER}, 4) + 0.0 AS temp_lag_{n}" for n in fx.LAG_STEPS) + " FROM {readings} r")
def _(t):
    frame = ops.lags(sensor(t), ["station_id"], "timestamp", "id", "temperature", fx.LAG_STEPS, **SIZING)
    return frame.select("id", *[f"temp_lag_{n}" for n in fx.LAG_STEPS])


def _rolling_sql(n):
    frame = f"OVER (PARTITION BY station_id ORDER BY r.timestamp, id ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return (f"CASE WHEN COUNT(*) {frame} = {n} THEN ROUND(AVG(temperature) {frame}, 4) END AS temp_mean_{n}, "
            f"CASE WHEN COUNT(*) {frame} = {n} THEN ROUND(stddev_samp(temperature) {frame}, 4) END AS temp_std_{n}")


@query("w02_rolling", "SELECT id, " + ", ".join(_rolling_sql(n) for n in fx.ROLLING_WIDTHS) + " FROM {readings} r")
def _(t):
    frame = ops.rolling(sensor(t), ["station_id"], "timestamp", "id", "temperature", fx.ROLLING_WIDTHS, **SIZING)
    return frame.drop("station_id", "timestamp", "temperature", "humidity")


@query("w03_diffs", f"""
SELECT id, ROUND(temperature - lag(temperature, 1) {OVER}, 4) + 0.0 AS temp_diff_1,
       ROUND(temperature - lag(temperature, 24) {OVER}, 4) + 0.0 AS temp_diff_24 FROM {{readings}} r""")
def _(t):
    frame = ops.diffs(sensor(t), ["station_id"], "timestamp", "id", "temperature", fx.DIFF_STEPS)
    return frame.select("id", "temp_diff_1", "temp_diff_24")


@query("w04_latest_n", f"""
SELECT id, station_id, {stamp('r.timestamp')} AS timestamp FROM {{readings}} r
QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY r.timestamp DESC, id DESC) <= 20""")
def _(t):
    return ops.latest_n(t.readings.select("id", "station_id", "timestamp"), ["station_id"], "timestamp", "id", 20)


@query("w05_first_per_group", """
SELECT id, weather_condition, ROUND(temperature, 4) AS temperature FROM {readings}
QUALIFY row_number() OVER (PARTITION BY weather_condition ORDER BY id) = 1""")
def _(t):
    return ops.first_per_group(t.readings.select("id", "weather_condition", "temperature"), "weather_condition", "id")


@query("w06_ordered_split", """
SELECT id, row_number() OVER (ORDER BY r.timestamp, id) <= floor(0.8 * COUNT(*) OVER ()) AS is_train FROM {readings} r""")
def _(t):
    frame = t.readings.select("id", F.unix_micros("timestamp").alias("at"))
    return order_stats.first_fraction(frame, "at", "id", 0.8).select("id", "is_train")


STATE_SQL = """
WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY r.timestamp DESC, id DESC) AS rn FROM {readings} r),
h AS (SELECT * FROM ranked WHERE rn <= 24),
g AS (SELECT station_id, COUNT(*) AS rows, MAX(h.timestamp) AS last_ts, MAX(temperature) FILTER (WHERE rn = 1) AS v1,
  MAX(humidity) FILTER (WHERE rn = 1) AS h1, """ + ", ".join(
    f"MAX(temperature) FILTER (WHERE rn = {n}) AS v{n}" for n in (2, 3, 6, 12, 24)) + ", " + ", ".join(
    f"AVG(temperature) FILTER (WHERE rn <= {n}) AS m{n}, stddev_pop(temperature) FILTER (WHERE rn <= {n}) AS s{n}"
    for n in fx.ROLLING_WIDTHS) + " FROM h GROUP BY station_id) SELECT station_id, rows, " + stamp("last_ts") + " AS last_ts, " + ", ".join(
    f"ROUND(COALESCE(v{n}, v1), 4) + 0.0 AS temp_lag_{n}" for n in fx.LAG_STEPS) + ", " + ", ".join(
    f"ROUND(m{n}, 4) + 0.0 AS temp_rolling_mean_{n}, ROUND(s{n}, 4) AS temp_rolling_std_{n}" for n in fx.ROLLING_WIDTHS) + """,
  ROUND(COALESCE(v1 - v2, 0), 4) + 0.0 AS temp_diff_1, ROUND(COALESCE(v1 - v24, 0), 4) + 0.0 AS temp_diff_24,
  h1 AS humidity_lag_1, ROUND(v1 / (h1 + 1e-6), 1) AS temp_humidity_ratio FROM g"""


@query("w07_latest_state", STATE_SQL)
def _(t):
    return ops.latest_state(t.readings, "station_id", "timestamp", "id", "temperature", "humidity", fx.LAG_STEPS,
                            fx.ROLLING_WIDTHS, fx.DEFAULT_HUMIDITY, fx.RATIO_EPSILON).withColumn(
        "temp_humidity_ratio", F.round("temp_humidity_ratio", 1))


@query("w08_share", """
SELECT lang, COUNT(*) AS count, ROUND(COUNT(*) * 100.0E0 / (SELECT COUNT(*) FROM documents), 4) AS percentage FROM documents GROUP BY lang""")
def _(t):
    return value_counts(t.documents, "lang")


@query("w09_trend", f"""
SELECT {stamp('r.timestamp')} AS timestamp, ROUND(temperature, 4) AS temperature, humidity, pressure FROM {{readings}} r
WHERE station_id = '8' AND r.timestamp > TIMESTAMP '2024-01-28 12:00:00' - INTERVAL 240 HOUR""")
def _(t):
    return ops.trend(t.readings, "station_id", "8", "timestamp", "2024-01-28 12:00:00", 240,
                     ["temperature", "humidity", "pressure"])


def _stats_sql(limit):
    kept = f"WHERE rn <= {limit}" if limit else ""
    return f"""
SELECT station_id, ROUND(MAX(temperature) FILTER (WHERE rn = 1), 4) AS latest_temperature, ROUND(AVG(temperature), 4) AS avg_temperature_720h,
  ROUND(MIN(temperature), 4) AS min_temperature_720h, ROUND(MAX(temperature), 4) AS max_temperature_720h, COUNT(*) AS data_points_720h
FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY r.timestamp DESC, id DESC) AS rn FROM {{readings}} r
      WHERE r.timestamp > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 720 HOUR) {kept} GROUP BY station_id"""


@query("a18_station_stats", _stats_sql(50))
def _(t):
    return ops.station_stats(t.readings, "station_id", "temperature", "timestamp", "id", "2024-01-31 00:00:00", 720, 50)


@query("a18_station_stats_all", _stats_sql(None))
def _(t):
    return ops.station_stats(t.readings, "station_id", "temperature", "timestamp", "id", "2024-01-31 00:00:00", 720, None)
