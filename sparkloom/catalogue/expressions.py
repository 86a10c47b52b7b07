"""Scalar expressions."""

from pyspark.sql import functions as F

from ..functions import documents as doc, numbers as num, text as txt, timeparts as tp, weather as wx
from .registry import query, stamp

LINEAR = "-42.379 + 2.04901523 * temperature + 10.14333127 * humidity"
FULL = (LINEAR + " - 0.22475541 * temperature * humidity - 0.00683783E0 * temperature * temperature"
        " - 0.05481717E0 * humidity * humidity + 0.00122874E0 * temperature * temperature * humidity"
        " + 0.00085282E0 * temperature * humidity * humidity"
        " - 0.00000199E0 * temperature * temperature * humidity * humidity")


@query("d01_heat_index", f"""
SELECT id, ROUND(CASE WHEN temperature < 27 THEN temperature ELSE {LINEAR} END, 4) AS stream,
       ROUND(CASE WHEN temperature < 27 THEN temperature ELSE {LINEAR} - 0.22475541 * temperature * humidity END, 4) AS batch,
       ROUND(CASE WHEN temperature < 27 THEN temperature ELSE {FULL} END, 1) AS full_index
FROM {{readings}}""")
def _(t):
    return t.readings.select(
        "id",
        wx.heat_index("temperature", "humidity", "stream").alias("stream"),
        wx.heat_index("temperature", "humidity", "batch").alias("batch"),
        F.round(wx.heat_index("temperature", "humidity", "full", digits=6), 1).alias("full_index"))


@query("d02_wind_chill", """
SELECT id, ROUND(CASE WHEN temperature > 10 OR wind_speed < 4.8 THEN temperature
  ELSE 13.12 + 0.6215 * temperature - 11.37 * pow(wind_speed, 0.16) + 0.3965 * temperature * pow(wind_speed, 0.16) END, 4) AS wind_chill
FROM {readings}""")
def _(t):
    return t.readings.select("id", wx.wind_chill("temperature", "wind_speed").alias("wind_chill"))


@query("d03_dew_point", """
SELECT id, ROUND(237.7 * g / (17.27 - g), 4) AS dew_point
FROM (SELECT id, CASE WHEN humidity > 0 THEN 17.27 * temperature / (237.7 + temperature) + ln(humidity / 100.0) END AS g
      FROM {readings})""")
def _(t):
    return t.readings.select("id", wx.dew_point("temperature", "humidity").alias("dew_point"))


@query("d04_alert_level", """
SELECT id, CASE WHEN temperature > 35 THEN 'HIGH_HEAT' WHEN temperature < -10 THEN 'EXTREME_COLD'
  WHEN wind_speed > 100 THEN 'HIGH_WIND' ELSE 'NORMAL' END AS alert_level FROM {readings}""")
def _(t):
    return t.readings.select("id", wx.alert_level("temperature", "wind_speed").alias("alert_level"))


@query("d05_delay_labels", """
SELECT FlightNum, Leg, CASE WHEN ArrDelay > 15 THEN 1.0E0 ELSE 0.0E0 END AS delayed,
  CASE WHEN ArrDelay > 15 THEN 'Delayed' WHEN ArrDelay < -10 THEN 'Early' ELSE 'OnTime' END AS delay_category
FROM {flights}""")
def _(t):
    return t.flights.select("FlightNum", "Leg", num.delay_label("ArrDelay").alias("delayed"),
                            num.delay_category("ArrDelay").alias("delay_category"))


@query("d06_alerts", f"""
SELECT id, 'temp_' || station_id || '_1735732800' AS alert_id, 'Extreme temperature: ' || temperature || '°C' AS message,
       station_id, 'temperature' AS alert_type, CASE WHEN abs(temperature) > 45 THEN 'high' ELSE 'medium' END AS severity,
       {stamp('timestamp')} AS timestamp FROM {{readings}} WHERE temperature > 40 OR temperature < -20
UNION ALL
SELECT id, 'wind_' || station_id || '_1735732800', 'High wind speed: ' || wind_speed || ' km/h', station_id, 'wind', 'high', {stamp('timestamp')} FROM {{readings}} WHERE wind_speed > 80""")
def _(t):
    alerts = wx.reading_alerts("station_id", "temperature", "wind_speed", "timestamp", now="2025-01-01 12:00:00")
    return t.readings.select("id", F.inline(alerts)).select("id", "alert_id", "message", "station_id", "alert_type", "severity", "timestamp")


@query("d07_error_flag", "SELECT id, path, status_code >= 400 AS is_error FROM {http}")
def _(t):
    return t.http.select("id", "path", num.is_error("status_code").alias("is_error"))


@query("d08_calendar_parts", """
SELECT id, year(timestamp) AS year, month(timestamp) AS month, day(timestamp) AS day, hour(timestamp) AS hour,
       isodow(timestamp) - 1 AS day_of_week, dayofyear(timestamp) AS day_of_year FROM {readings}""")
def _(t):
    return tp.calendar_parts(t.readings.select("id", "timestamp"), "timestamp",
                             ("year", "month", "day", "hour", "day_of_week", "day_of_year")).drop("timestamp")


@query("d09_cyclic", """
SELECT id, ROUND(sin(2 * pi() * h / 24), 4) + 0.0 AS hour_sin, ROUND(cos(2 * pi() * h / 24), 4) + 0.0 AS hour_cos,
       ROUND(sin(2 * pi() * w / 7), 4) + 0.0 AS day_sin, ROUND(cos(2 * pi() * w / 7), 4) + 0.0 AS day_cos,
       ROUND(sin(2 * pi() * m / 12), 4) + 0.0 AS month_sin, ROUND(cos(2 * pi() * m / 12), 4) + 0.0 AS month_cos
FROM (SELECT id, hour(timestamp) AS h, isodow(timestamp) - 1 AS w, month(timestamp) AS m FROM {readings})""")
def _(t):
    parts = tp.calendar_parts(t.readings.select("id", "timestamp"), "timestamp", ("hour", "day_of_week", "month"))
    for column, period, prefix in (("hour", 24, "hour"), ("day_of_week", 7, "day"), ("month", 12, "month")):
        parts = tp.with_cyclic(parts, column, period, prefix)
    return parts.drop("timestamp", "hour", "day_of_week", "month")


@query("d10_ratios", """
SELECT row_id, ROUND(Length2 / NULLIF(Length1, 0), 4) AS l2_l1, ROUND(Length3 / (Width + 1e-6), 4) AS l3_width FROM {fish}""")
def _(t):
    return t.fish.select("row_id", num.ratio("Length2", "Length1").alias("l2_l1"),
                         num.ratio("Length3", "Width", 1e-6).alias("l3_width"))


@query("d11_haversine", """
SELECT iata, ROUND(2 * 6371 * atan2(sqrt(a), sqrt(1 - a)), 3) AS km FROM (
  SELECT iata, pow(sin(radians(lat - 10) / 2), 2)
    + cos(radians(10)) * cos(radians(lat)) * pow(sin(radians(long - 20) / 2), 2) AS a FROM {airports})""")
def _(t):
    return t.airports.select("iata", F.round(num.haversine_km("lat", "long", F.lit(10.0), F.lit(20.0)), 3).alias("km"))


@query("d12_parse_ts", f"""
SELECT id, CASE WHEN id % 10 = 0 THEN '2024-01-01 00:00:00.000000' ELSE {stamp("timestamp")} END AS parsed FROM {{readings}}""")
def _(t):
    iso = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    text = F.when(F.col("id") % 10 == 0, "yesterday").otherwise(iso)
    return t.readings.select("id", tp.parse_ts(text, F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("parsed"))


@query("d13_json_field", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 'unknown' AS path, CAST(200 AS BIGINT) AS status_code
FROM events""")
def _(t):
    return t.events.select("event_id", doc.json_field("props", "k", "bigint", 0).alias("k"),
                           doc.json_field("props", "path", "string", "unknown").alias("path"),
                           doc.json_field("props", "status_code", "int", 200).alias("status_code"))


@query("d14_rest_as_map", "SELECT event_id, event_type AS kind, 'c' AS unit, CAST(2 AS BIGINT) AS n FROM events")
def _(t):
    payload = F.to_json(F.struct(F.col("value").alias("temperature"), F.col("event_type").alias("kind"),
                                 F.lit("c").alias("unit")))
    rest = t.events.select("event_id", doc.rest_as_map(payload, ["temperature"]).alias("m"))
    return rest.select("event_id", F.col("m")["kind"].alias("kind"), F.col("m")["unit"].alias("unit"), F.size("m").alias("n"))


@query("d15_map_json", "SELECT event_id, json_extract_string(props, '$.k') AS k, "
       "CASE WHEN event_id % 4 <> 0 THEN concat('{\"k\":\"', json_extract_string(props, '$.k'), '\"}') END AS text FROM events")
def _(t):
    as_map = doc.json_to_map("props")
    emptied = F.map_filter(as_map, lambda k, v: F.col("event_id") % 4 != 0)
    return t.events.select("event_id", as_map["k"].alias("k"), doc.map_to_json(emptied).alias("text"))


@query("d16_enrich_map", """
SELECT event_id, json_extract_string(props, '$.k') AS k, '1.0.0' AS version, event_type AS kind, CAST(3 AS BIGINT) AS n FROM events""")
def _(t):
    enriched = doc.enrich_map(doc.json_to_map("props"), {"version": F.lit("1.0.0"), "kind": F.col("event_type")})
    return t.events.select("event_id", enriched.alias("m")).select(
        "event_id", F.col("m")["k"].alias("k"), F.col("m")["version"].alias("version"),
        F.col("m")["kind"].alias("kind"), F.size("m").alias("n"))


@query("d17_topic_part", """
SELECT event_id, CAST(user_id AS VARCHAR) AS second, event_type AS last, CAST(user_id AS VARCHAR) AS before_last, 'unknown' AS missing FROM events""")
def _(t):
    topic = F.concat_ws("/", F.lit("sensors"), F.col("user_id").cast("string"), F.col("event_type"))
    return t.events.select("event_id", doc.topic_part(topic, 1).alias("second"), doc.topic_part(topic, -1).alias("last"),
                           doc.topic_part(topic, -2).alias("before_last"), doc.topic_part(topic, 7).alias("missing"))


@query("d18_ids_and_keys", """
SELECT id, strftime(timestamp, 'rec_%Y%m%d_%H%M%S') AS record_id, strftime(timestamp, '%Y') AS year,
       strftime(timestamp, '%m') AS month, strftime(timestamp, '%d') AS day FROM {readings}""")
def _(t):
    keyed = tp.date_keys(t.readings.select("id", "timestamp"), "timestamp")
    return keyed.withColumn("record_id", tp.make_id("rec", "timestamp")).drop("timestamp")


@query("d19_rounding", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, floor(l_quantity / 2 + 0.5) AS half_up,
       CASE WHEN l_quantity % 4 = 1 THEN floor(l_quantity / 2) ELSE floor(l_quantity / 2 + 0.5) END AS half_even
FROM lineitem""")
def _(t):
    half = F.col("l_quantity") / 2
    return t.lineitem.select("l_orderkey", "l_linenumber", num.round_to(half, 0).alias("half_up"),
                             num.round_to(half, 0, "half_even").alias("half_even"))


@query("d20_error_columns", """
SELECT row_id, ROUND(abs(predicted - actual), 4) AS abs_error, ROUND(abs(predicted - actual) / actual * 100, 4) AS pct_error
FROM {scored}""")
def _(t):
    return t.scored.select("row_id", num.absolute_error("actual", "predicted").alias("abs_error"),
                           num.percent_error("actual", "predicted").alias("pct_error"))


@query("d21_band", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CASE WHEN x > 0.9 THEN 'outstanding' WHEN x > 0.85 THEN 'excellent' WHEN x > 0.7 THEN 'good'
  WHEN x > 0.5 THEN 'moderate' ELSE 'poor' END AS band FROM (SELECT l_orderkey, l_linenumber, l_quantity / 50 AS x FROM lineitem)""")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", num.band(F.col("l_quantity") / 50).alias("band"))


@query("d22_budget_status", """
SELECT o_orderkey, ROUND(CASE WHEN lim > 0 THEN spent / lim * 100 ELSE 0 END, 4) AS pct,
  CASE WHEN lim <= 0 OR spent / lim * 100 < 80 THEN 'OK' WHEN spent / lim * 100 < 100 THEN 'WARNING' ELSE 'EXCEEDED' END AS status
FROM (SELECT o_orderkey, o_totalprice AS spent, CASE WHEN o_orderkey % 10 = 0 THEN 0.0E0 ELSE 300007.0E0 END AS lim FROM orders)""")
def _(t):
    limit = F.when(F.col("o_orderkey") % 10 == 0, 0.0).otherwise(300007.0)
    return t.orders.select("o_orderkey", num.budget_pct("o_totalprice", limit).alias("pct"),
                           num.budget_status("o_totalprice", limit).alias("status"))


@query("d23_prompt_completion", """
SELECT doc_id, md5('Classify the sentiment of the following text: ' || text) AS prompt_hash,
  CASE code WHEN 0 THEN 'negative' WHEN 1 THEN 'positive' ELSE CAST(code AS VARCHAR) END AS completion
FROM (SELECT d.doc_id, text, quality + 2 * toxic AS code FROM documents d JOIN labels l ON d.doc_id = l.doc_id)""")
def _(t):
    code = F.col("label") + 2 * F.col("toxic")
    return t.labelled.select("doc_id", F.md5(txt.prompt("text")).alias("prompt_hash"),
                             txt.completion(code).alias("completion"))


@query("d24_tool_prompt", r"""
WITH v AS (SELECT event_id AS id, event_type AS kind, props FROM events WHERE event_id % 17 <> 0 AND event_id % 13 <> 0),
p AS (SELECT id, concat('You are an AI assistant with access to the following tools:', chr(10), chr(10), '[', chr(10), '  {', chr(10),
    '    "name": "', kind, '",', chr(10), '    "description": "d"', chr(10), '  }', chr(10), ']', chr(10), chr(10),
    'Based on the user''s query, determine which tool(s) to call and with what arguments.', chr(10),
    'Your response should be a JSON array of tool calls in the format:', chr(10),
    '[{"name": "tool_name", "arguments": {"param": "value"}}]', chr(10), chr(10), 'User Query: find ', kind, chr(10), chr(10), 'Tool Calls:') AS prompt,
  concat('[{"name": "', kind, '", "arguments": ', props, '}]') AS answers FROM v)
SELECT id, md5(prompt) AS prompt_hash, CAST(length(prompt) + 1 + length(answers) AS BIGINT) AS training_chars FROM p""")
def _(t):
    valid = t.calls.where(txt.valid_dataset_row("query", "tools"))
    return valid.select("id", F.md5(txt.tool_prompt("query", "tools")).alias("prompt_hash"),
                        F.length(txt.tool_prompt("query", "tools", "answers")).alias("training_chars"))


@query("d25_tool_calls", """
SELECT id, CASE WHEN id % 11 = 0 THEN '' WHEN id % 7 = 0 THEN kind WHEN id % 5 = 0 THEN 'other' ELSE kind END AS names,
       CAST(CASE WHEN id % 11 = 0 THEN 0 ELSE 1 END AS BIGINT) AS n_calls,
       CASE WHEN id % 11 = 0 THEN NULL WHEN id % 7 = 0 THEN '{}' ELSE replace(props, ' ', '') END AS arguments
FROM (SELECT event_id AS id, event_type AS kind, props FROM events)""")
def _(t):
    wrapped = F.concat(F.lit("Here you are: "), F.col("predicted"), F.lit(" - done."))
    calls = t.calls.select("id", txt.parse_tool_calls(wrapped).alias("calls"))
    return calls.select("id", F.array_join(F.transform("calls", lambda c: c["name"]), ",").alias("names"),
                        F.size("calls").alias("n_calls"),
                        F.try_element_at("calls", F.lit(1))["arguments"].alias("arguments"))


@query("d26_forecast_bounds", """
SELECT id, day, ROUND(greatest(0.6E0, 1.0E0 - 0.1E0 * day), 2) AS confidence, ROUND(temperature - (1 + 0.5 * day), 2) AS low,
       ROUND(temperature + (1 + 0.5 * day), 2) AS high
FROM (SELECT id, ROUND(temperature, 1) AS temperature, id % 7 AS day FROM {readings})""")
def _(t):
    frame = t.readings.select("id", F.round("temperature", 1).alias("temperature"), (F.col("id") % 7).alias("day"))
    low, high = num.forecast_bounds("temperature", "day")
    return frame.select("id", "day", num.forecast_confidence("day").alias("confidence"), low.alias("low"), high.alias("high"))


@query("d29_to_message", """
SELECT id, path, CAST(status_code AS BIGINT) AS status_code FROM {http}""")
def _(t):
    messages = t.http.select(doc.to_message("id", "path", "status_code").alias("message"))
    parsed = F.from_json("message", "id bigint, path string, status_code int").alias("m")
    return messages.select(parsed).select("m.*")


@query("d30_constants", """
SELECT id, '2024-02-01 00:00:00.000000' AS processing_timestamp, 100.0E0 AS data_quality_score, 'hourly' AS aggregation_level FROM {readings}""")
def _(t):
    return tp.with_constants(t.readings.select("id"), now="2024-02-01 00:00:00", data_quality_score=100.0,
                             aggregation_level="hourly")
