"""Filters, projections, filling and validation."""

from pyspark.sql import functions as F

from .. import fixed_values as fx
from ..functions.text import valid_dataset_row
from ..operators import cleaning as ops, validation as val
from .registry import query, stamp

VALID = ("temperature BETWEEN -50 AND 60 AND humidity BETWEEN 0 AND 100 AND pressure BETWEEN 800 AND 1200 "
         "AND wind_speed <= 200 AND wind_direction BETWEEN 0 AND 360 AND station_id IS NOT NULL "
         "AND timestamp IS NOT NULL")


@query("f01_not_null", """
SELECT FlightNum, Leg, TailNum, UniqueCarrier FROM {flights}
WHERE TailNum IS NOT NULL AND UniqueCarrier IS NOT NULL""")
def _(t):
    return ops.not_null(t.flights.select("FlightNum", "Leg", "TailNum", "UniqueCarrier"), ["TailNum", "UniqueCarrier"])


@query("f02_cancelled_for_security", "SELECT FlightNum, Dest FROM {flights} WHERE CancellationCode = 'D'")
def _(t):
    return ops.where_equal(t.flights, "CancellationCode", "D", ["FlightNum", "Dest"])


@query("f03_range", "SELECT FlightNum, Leg, Month FROM {flights} WHERE Month < 4")
def _(t):
    return ops.where_range(t.flights, "Month", hi=4).select("FlightNum", "Leg", "Month")


@query("f04_conjunction", "SELECT FlightNum, Leg, UniqueCarrier FROM {flights} WHERE Origin = 'A3' AND Dest = 'A5'")
def _(t):
    return ops.where_all(t.flights, {"Origin": "A3", "Dest": "A5"}).select("FlightNum", "Leg", "UniqueCarrier")


@query("f05_valid_readings", f"""
SELECT id, station_id, ROUND(temperature, 4) AS temperature, humidity, pressure, wind_speed, wind_direction
FROM {{readings}} WHERE {VALID}""")
def _(t):
    return ops.valid_readings(t.readings).select(
        "id", "station_id", "temperature", "humidity", "pressure", "wind_speed", "wind_direction")


WEATHER_MAPPING = [
    ("station_id", "string", "station_id", "string"),
    ("timestamp", "timestamp", "measurement_time", "timestamp"),
    ("temperature", "double", "temperature_celsius", "double"),
    ("humidity", "double", "humidity_percent", "double"),
    ("metadata", "string", "metadata_json", "string"),
    ("weather_condition", "string", "condition_code", "int"),
]


@query("f06_mapping", f"""
SELECT station_id, {stamp('timestamp')} AS measurement_time, ROUND(temperature, 4) AS temperature_celsius,
       humidity AS humidity_percent, metadata AS metadata_json,
       CAST(TRY_CAST(weather_condition AS INTEGER) AS BIGINT) AS condition_code
FROM {{readings}}""")
def _(t):
    return ops.apply_mapping(t.readings, WEATHER_MAPPING)


@query("f07_flatten", "SELECT id, station_id, ROUND(temperature, 4) AS temperature FROM {readings}")
def _(t):
    nested = t.readings.select(F.struct("id", "station_id", "temperature").alias("weather_data"))
    return ops.flatten(nested, "weather_data")


@query("f08_between_closed", f"""
SELECT id, {stamp('timestamp')} AS timestamp FROM {{readings}}
WHERE timestamp >= TIMESTAMP '2024-01-05 00:00:00' AND timestamp <= TIMESTAMP '2024-01-20 12:00:00'""")
def _(t):
    return ops.between_times(t.readings.select("id", "timestamp"), "timestamp",
                             "2024-01-05 00:00:00", "2024-01-20 12:00:00")


@query("f08_between_open", f"""
SELECT doc_order AS id, {stamp('timestamp')} AS timestamp FROM (
  SELECT o_orderkey AS doc_order, CAST(o_orderdate AS TIMESTAMP) AS timestamp FROM orders)
WHERE timestamp > TIMESTAMP '1996-01-01' AND timestamp < TIMESTAMP '1997-01-01'""")
def _(t):
    orders = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("timestamp").alias("timestamp"))
    return ops.between_times(orders, "timestamp", "1996-01-01", "1997-01-01", closed=False)


@query("f09_last_hours", f"""
SELECT id, station_id, {stamp('timestamp')} AS timestamp FROM {{readings}}
WHERE timestamp > TIMESTAMP '2024-01-28 12:00:00' - INTERVAL 24 HOUR""")
def _(t):
    return ops.last_hours(t.readings.select("id", "station_id", "timestamp"), "timestamp", 24, "2024-01-28 12:00:00")


@query("f10_drop_incomplete", """
SELECT FlightNum, Leg, ArrDelay, WeatherDelay, CarrierDelay FROM {flights}
WHERE ArrDelay IS NOT NULL AND WeatherDelay IS NOT NULL AND CarrierDelay IS NOT NULL""")
def _(t):
    return ops.drop_incomplete(t.flights.select("FlightNum", "Leg", "ArrDelay", "WeatherDelay", "CarrierDelay"))


@query("f11_fill_const", """
SELECT FlightNum, Leg, COALESCE(WeatherDelay, 0) AS WeatherDelay, COALESCE(CarrierDelay, 0) AS CarrierDelay
FROM {flights}""")
def _(t):
    return ops.fill_const(t.flights.select("FlightNum", "Leg", "WeatherDelay", "CarrierDelay"), 0,
                          ["WeatherDelay", "CarrierDelay"])


@query("f12_fill_mean", """
SELECT row_id, ROUND(COALESCE(Height, (SELECT AVG(Height) FROM {fish})), 4) AS Height FROM {fish}""")
def _(t):
    return ops.fill_mean(t.fish.select("row_id", "Height"), ["Height"])


@query("f12_fill_mean_per_key", """
SELECT row_id, f.Species, ROUND(COALESCE(Height, m), 4) AS Height
FROM {fish} f JOIN (SELECT Species, AVG(Height) AS m FROM {fish} GROUP BY Species) g ON f.Species = g.Species""")
def _(t):
    return ops.fill_mean(t.fish.select("row_id", "Species", "Height"), ["Height"], ["Species"])


@query("f13_fill_median", """
SELECT row_id, ROUND(COALESCE(Height, (SELECT quantile_cont(Height, 0.5) FROM {fish})), 4) AS Height FROM {fish}""")
def _(t):
    return ops.fill_median(t.fish.select("row_id", "Height"), ["Height"])


@query("f14_to_number", """
SELECT id, TRY_CAST(predicted AS DOUBLE) AS as_number, TRY_CAST(CAST(id AS VARCHAR) AS DOUBLE) AS id_number
FROM {calls}""")
def _(t):
    frame = t.calls.select("id", F.col("predicted").alias("as_number"), F.col("id").cast("string").alias("id_number"))
    return ops.to_number(frame, ["as_number", "id_number"])


@query("f15_normalise_fields", """
SELECT id, COALESCE(Height, temp, 0.0) AS temperature, COALESCE(hum, 0.0) AS humidity, 'unknown' AS location FROM (
  SELECT row_id AS id, Height, CASE WHEN row_id % 3 = 0 THEN Width END AS temp,
         CASE WHEN row_id % 5 = 0 THEN Length1 END AS hum FROM {fish})""")
def _(t):
    frame = t.fish.select(
        F.col("row_id").alias("id"), F.col("Height").alias("temperature"),
        F.when(F.col("row_id") % 3 == 0, F.col("Width")).alias("temp"),
        F.when(F.col("row_id") % 5 == 0, F.col("Length1")).alias("hum"))
    filled = ops.normalise_fields(frame, {"temperature": ["temp"], "humidity": ["hum"]},
                                  {"temperature": 0.0, "humidity": 0.0, "location": "unknown"})
    return ops.drop_cols(filled, ["temp", "hum"])


@query("f16_validate", """
SELECT id, CAST((t IS NOT NULL)::INT + (h IS NOT NULL)::INT + (p IS NOT NULL)::INT + (w IS NOT NULL)::INT + (d IS NOT NULL)::INT AS BIGINT) AS n_errors,
  CAST(suspicious::INT AS BIGINT) AS n_warnings, concat_ws(', ', t, h, p, w, d) = '' AS is_valid, concat_ws(', ', t, h, p, w, d) AS broken
FROM (SELECT id, CASE WHEN temperature < -50 OR temperature > 60 THEN 'Temperature' END AS t,
    CASE WHEN humidity < 0 OR humidity > 100 THEN 'Humidity' END AS h,
    CASE WHEN pressure < 800 OR pressure > 1200 THEN 'Pressure' END AS p,
    CASE WHEN wind_speed > 200 THEN 'Wind speed' END AS w,
    CASE WHEN wind_direction < 0 OR wind_direction > 360 THEN 'Wind direction' END AS d,
    abs(temperature) < 0.1 AND abs(humidity) < 0.1 AS suspicious FROM {readings})""")
def _(t):
    checked = val.validate(t.readings, val.reading_rules())
    label = F.transform("errors", lambda m: F.regexp_extract(m, r"^([A-Za-z ]+?) -?\d", 1))
    return checked.select("id", F.size("errors").alias("n_errors"), F.size("warnings").alias("n_warnings"),
                          "is_valid", F.array_join(label, ", ").alias("broken"))


@query("f17_constraints", """
SELECT id, errors, errors = '' AS is_valid FROM (
  SELECT id, concat_ws(', ',
    CASE WHEN temperature > 100 THEN 'Temperature must be less than 100°C' END,
    CASE WHEN humidity > 100 THEN 'Humidity cannot exceed 100%' END,
    CASE WHEN pressure < 800 THEN 'Pressure must be greater than 800 hPa' END,
    CASE WHEN pressure > 1200 THEN 'Pressure must be less than 1200 hPa' END,
    CASE WHEN wind_direction > 360 THEN 'Wind direction cannot exceed 360 degrees' END,
    CASE WHEN lat IS NULL THEN 'Latitude cannot be null' END,
    CASE WHEN abs(lat) > 90 THEN 'Latitude must be between -90 and 90 degrees' END) AS errors
  FROM (SELECT *, CASE WHEN id % 9 = 0 THEN NULL ELSE wind_speed - 100 END AS lat FROM {readings}))""")
def _(t):
    lat = F.when(F.col("id") % 9 != 0, F.col("wind_speed") - 100)
    located = t.readings.withColumn("location", F.struct(lat.alias("latitude"), F.lit(10.0).alias("longitude")))
    checked = val.validate(located, val.measurement_rules())
    return checked.select("id", val.joined_errors().alias("errors"), "is_valid")


@query("f18_validation_counts", f"""
SELECT COUNT(*) AS received, COUNT(*) FILTER (WHERE ok) AS valid, COUNT(*) FILTER (WHERE NOT ok) AS invalid
FROM (SELECT {VALID} AND id % 50 <> 0 AS ok FROM {{readings}})""")
def _(t):
    checked = val.validate(t.readings, val.reading_rules())
    return val.validation_counts(checked, parsed=F.col("id") % 50 != 0)


@query("f19_sensor_validation", """
SELECT id, concat_ws('; ',
    CASE WHEN sensor_id IS NULL OR trim(sensor_id) = '' THEN 'Sensor ID cannot be null or empty' END,
    CASE WHEN abs(temperature) > 100 THEN 'Temperature value out of reasonable range' END) AS errors
FROM (SELECT id, temperature, CASE WHEN id % 19 = 0 THEN '  ' ELSE station_id END AS sensor_id FROM {readings})""")
def _(t):
    sensors = t.readings.select("id", "temperature",
                                F.when(F.col("id") % 19 == 0, "  ").otherwise(F.col("station_id")).alias("sensor_id"))
    checked = val.validate(sensors, val.sensor_rules())
    return checked.select("id", F.regexp_replace(val.joined_errors("; "), r": -?[\d.E]+", "").alias("errors"))


@query("f20_fish_rules", """
SELECT row_id, CAST(CAST(NOT known AS INT) + CAST(h IS NULL OR h <= 0 AS INT) + CAST(w <= 0 AS INT)
  + CAST(COALESCE(l2 > 100, FALSE) AS INT) AS BIGINT) AS n_errors
FROM (SELECT row_id, Species IN ('Bream','Roach','Whitefish','Parkki','Perch','Pike','Smelt') AS known,
             Height AS h, Width AS w, Length2 * 2 AS l2
      FROM (SELECT row_id, CASE row_id % 3 WHEN 0 THEN 'Bream' WHEN 1 THEN 'Pike' ELSE Species END AS Species,
                   Height, Width, Length2 FROM {fish}))""")
def _(t):
    species = F.when(F.col("row_id") % 3 == 0, "Bream").when(F.col("row_id") % 3 == 1, "Pike").otherwise(F.col("Species"))
    frame = t.fish.select("row_id", species.alias("species"), F.col("Height").alias("height"),
                          F.col("Width").alias("width"), (F.col("Length2") * 2).alias("length2"))
    checked = val.validate(frame, val.fish_rules(measures=["height", "width", "length2"]))
    return checked.select("row_id", F.size("errors").alias("n_errors"))


@query("f21_valid_dataset_row", """
SELECT id, query <> '' AND json_valid(tools) AS is_valid FROM {calls}""")
def _(t):
    return t.calls.select("id", valid_dataset_row("query", "tools").alias("is_valid"))


@query("f22_dataset_contract", """
SELECT column_name, total, missing, ROUND(missing * 100.0E0 / total, 4) AS missing_pct,
       CASE WHEN missing * 2 > total THEN 'mostly missing' ELSE 'ok' END AS verdict
FROM (SELECT COUNT(*) AS total, COUNT(*) - COUNT(TailNum) AS a, COUNT(*) - COUNT(CancellationCode) AS b,
             COUNT(*) - COUNT(Distance) AS c FROM {flights}) s,
LATERAL (VALUES ('TailNum', a), ('CancellationCode', b), ('Distance', c)) v(column_name, missing)""")
def _(t):
    return val.check_dataset(t.flights, ["TailNum", "CancellationCode", "Distance"])


@query("f23_text_length", "SELECT doc_id FROM documents WHERE length(text) BETWEEN 1 AND 512")
def _(t):
    return ops.text_length_ok(t.documents, "text").select("doc_id")


@query("f24_drop_and_reorder", "SELECT Dest, Origin, FlightNum, Leg FROM {flights}")
def _(t):
    return ops.drop_cols(t.flights.select("FlightNum", "Leg", "Origin", "Dest", "Month"), ["Month"]).select(
        "Dest", "Origin", "FlightNum", "Leg")


@query("k08_quarantine", f"""
SELECT COUNT(*) FILTER (WHERE ok) AS valid, COUNT(*) FILTER (WHERE NOT ok) AS rejected,
       COUNT(DISTINCT station_id) FILTER (WHERE NOT ok) AS stations_rejected
FROM (SELECT *, {VALID} AS ok FROM {{readings}})""")
def _(t):
    valid, rejected = val.split_valid(val.validate(t.readings, val.reading_rules()))
    return rejected.agg(F.count("*").alias("rejected"), F.count_distinct("station_id").alias("stations_rejected")) \
        .withColumn("valid", valid.agg(F.count("*").alias("n")).scalar())


@query("a13_missing_profile", """
SELECT column_name, total, missing, ROUND(missing * 100.0E0 / total, 4) AS missing_pct
FROM (SELECT COUNT(*) AS total, COUNT(*) - COUNT(Height) AS a, COUNT(*) - COUNT(Weight) AS b FROM {fish}) s,
LATERAL (VALUES ('Height', a), ('Weight', b)) v(column_name, missing)""")
def _(t):
    return val.missing_profile(t.fish, ["Height", "Weight"])


@query("a22_quality_score", f"""
SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE {VALID}) AS valid,
       ROUND(COUNT(*) FILTER (WHERE {VALID}) * 100.0E0 / COUNT(*), 4) AS quality_score,
       COUNT(*) FILTER (WHERE {VALID}) * 100.0E0 / COUNT(*) < 95 AS below_target
FROM {{readings}}""")
def _(t):
    return val.quality_score(t.readings, ops.within_bounds(fx.READING_BOUNDS, fx.READING_KEYS))
