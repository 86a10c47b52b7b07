"""Scans and round trips through sinks."""

import uuid

from pyspark.sql import functions as F

from ..functions.documents import json_to_map
from ..functions.text import completion, prompt
from ..session import scratch_path
from ..schemas import LABELLED_TEXT
from ..sinks import lake, tables
from ..sources import envelope, files
from ..sources.streams import read_stream
from .registry import query, stamp, table_path


@query("s03_temp_view", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type")
def _(t):
    files.register(t.events, "sparkloom_events")
    return t.spark.sql("SELECT event_type, count(*) AS n FROM sparkloom_events GROUP BY event_type")


@query("s02_csv_with_mark", """
SELECT p_partkey, p_brand, ROUND(p_retailprice, 2) AS price FROM part""")
def _(t):
    # the header of each file begins with a byte-order mark
    path = scratch_path(t.spark, "marked")
    part = t.part.select(F.col("p_partkey").cast("bigint").alias("\ufeffp_partkey"), "p_brand", F.round("p_retailprice", 2).alias("price"))
    part.write.option("header", True).csv(path)
    back = files.read_csv(t.spark, path)
    return back.select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "p_brand", F.col("price").cast("double").alias("price"))


@query("s05_json_documents", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(t):
    # documents of about 500 customers, each an array over several lines
    path, rows = scratch_path(t.spark, "documents"), t.customer.select(F.col("c_custkey").cast("bigint"), "c_name", "c_mktsegment")
    parts = -(-rows.count() // 500) or 1
    one = rows.groupBy(F.pmod(F.xxhash64("c_custkey"), F.lit(parts)).alias("part")).agg(
        F.regexp_replace(F.to_json(F.collect_list(F.struct("c_custkey", "c_name", "c_mktsegment"))), r"\},\{", "},\n {").alias("value"))
    one.write.partitionBy("part").option("lineSep", "\n").text(path)
    return files.read_json_multiline(t.spark, path, "c_custkey bigint, c_name string, c_mktsegment string").drop("part")


@query("k11_catalog_tables", f"""
SELECT station_id, strftime(r.timestamp, '%Y') AS year, strftime(r.timestamp, '%m') AS month, strftime(r.timestamp, '%d') AS day,
  COUNT(*) AS n FROM {{readings}} r GROUP BY ALL""")
def _(t):
    # tables made twice, folders added behind the catalog's back and found again
    name, root = f"sparkloom_{uuid.uuid4().hex[:8]}", scratch_path(t.spark, "catalog")
    for _ in range(2):
        tables.create_tables(t.spark, name, root)
    rows = t.readings.select("station_id", F.col("timestamp").alias("measurement_time"),
                             *(F.date_format("timestamp", f).alias(k) for k, f in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))))
    lake.write_lake(rows, f"{root}/processed_weather")
    tables.refresh_table(t.spark, name, "processed_weather")
    return files.read_table(t.spark, name, "processed_weather").groupBy("station_id", "year", "month", "day").agg(F.count("*").alias("n"))


@query("s08_parquet_scan", "SELECT l_returnflag, COUNT(*) AS n, ROUND(SUM(l_quantity), 2) AS quantity FROM lineitem GROUP BY l_returnflag")
def _(t):
    scan = files.read_parquet(t.spark, table_path(t.sf_dir, "lineitem"))
    return scan.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("s12_envelope", f"""
SELECT CAST(user_id AS VARCHAR) AS sensor_id, value AS temperature, CASE WHEN event_id % 2 = 0 THEN 0.0E0 ELSE 40.5E0 END AS humidity,
  'unknown' AS location, {stamp('ts')} AS timestamp FROM events""")
def _(t):
    name = F.when(F.col("event_id") % 3 == 0, "temp").otherwise("temperature")
    iso = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    payload = F.concat(F.lit('{"'), name, F.lit('": '), F.col("value").cast("string"), F.lit(', "timestamp": "'), iso,
                       F.lit('"'), F.when(F.col("event_id") % 2 == 1, ', "hum": 40.5').otherwise(""), F.lit("}"))
    topic = F.concat_ws("/", F.lit("sensors"), F.col("user_id").cast("string"), F.lit("temperature"))
    return envelope.parse_envelope(t.events.select(topic.alias("topic"), payload.alias("payload")))


@query("s13_payload_fallback", """
SELECT CASE WHEN event_id % 3 = 0 THEN 'default' ELSE 's' || user_id END AS sensor_id, value AS temperature
FROM events WHERE event_id % 3 <> 2""")
def _(t):
    sensor = F.concat(F.lit("s"), F.col("user_id").cast("string"))
    payload = (F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(" "), F.col("value").cast("string")))
               .when(F.col("event_id") % 3 == 1, F.to_json(F.struct(sensor.alias("sensor_id"), F.col("value").alias("temperature"))))
               .otherwise("garbage"))
    messages = t.events.select(payload.alias("payload"), F.lit("sensor/temperature/+").alias("topic"))
    return envelope.parse_payload(messages).select("sensor_id", "temperature")


@query("k01_partitioned_lake", """
SELECT CAST(year(ts) AS BIGINT) AS year, CAST(month(ts) AS BIGINT) AS month, CAST(day(ts) AS BIGINT) AS day, COUNT(*) AS n
FROM events GROUP BY ALL""")
def _(t):
    path = scratch_path(t.spark, "lake")
    keyed = t.events.withColumns({"year": F.year("ts"), "month": F.month("ts"), "day": F.dayofmonth("ts")})
    lake.write_lake(keyed, path)
    return t.spark.read.parquet(path).groupBy("year", "month", "day").agg(F.count("*").alias("n"))


@query("k03_json_lake", """
SELECT event_type AS station, strftime(ts, '%m-%d') AS day, COUNT(*) AS n, SUM(event_id)::BIGINT AS ids FROM events GROUP BY ALL""")
def _(t):
    path = scratch_path(t.spark, "json-lake")
    lake.write_json_lake(t.readings.select("id", "timestamp", "weather_condition"), path, "timestamp", "weather_condition")
    back = t.spark.read.schema("id BIGINT, year STRING, month STRING, day STRING, station STRING").json(path)
    return back.groupBy("station", F.concat_ws("-", "month", "day").alias("day")).agg(
        F.count("*").alias("n"), F.sum("id").alias("ids"))


@query("k04_raw_csv", """
SELECT event_id, props, strftime(ts, '%d') AS day FROM events""")
def _(t):
    path = scratch_path(t.spark, "raw-csv")
    frame = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), json_to_map("props").alias("metadata"))
    lake.land_raw_csv(frame, path, "ts")
    back = files.read_partitioned_csv(t.spark, path, "event_id BIGINT, ts TIMESTAMP, metadata STRING")
    spaced = F.regexp_replace(F.regexp_replace("metadata", r'":"?', '": '), '"}$', "}")
    return back.select("event_id", spaced.alias("props"), "day")


@query("k07_jsonl_export", """
SELECT md5('Classify the sentiment of the following text: ' || text) AS prompt_hash,
       CASE quality WHEN 0 THEN 'negative' ELSE 'positive' END AS completion
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def _(t):
    path = scratch_path(t.spark, "jsonl")
    lake.export_jsonl(t.labelled.select(prompt("text").alias("prompt"), completion("label").alias("completion")), path)
    back = files.read_jsonl(t.spark, path, "prompt STRING, completion STRING")
    return back.select(F.md5("prompt").alias("prompt_hash"), "completion")


@query("k13_range_reprocess", """
SELECT strftime(ts, '%Y-%m-%d') AS day, COUNT(*) AS n FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13' GROUP BY 1""")
def _(t):
    ranged = lake.process_range(t.readings, "timestamp", "2024-01-10", "2024-01-12")
    return ranged.groupBy(F.date_format("timestamp", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))


@query("s01_csv_scan", """
SELECT UniqueCarrier, COUNT(*) AS n, COUNT(TailNum) AS tails, SUM(ArrDelay)::BIGINT AS delay FROM {flights} GROUP BY UniqueCarrier""")
def _(t):
    path = scratch_path(t.spark, "csv")
    columns = ["UniqueCarrier", "TailNum", "ArrDelay"]
    t.flights.select(*columns).write.option("header", True).option("nullValue", "NA").csv(path)
    scan = files.read_csv(t.spark, path, "UniqueCarrier STRING, TailNum STRING, ArrDelay INT")
    return scan.groupBy("UniqueCarrier").agg(F.count("*").alias("n"), F.count("TailNum").alias("tails"), F.sum("ArrDelay").alias("delay"))


@query("s04_json_lines", "SELECT CAST(quality AS BIGINT) AS label, COUNT(*) AS n, SUM(length(text))::BIGINT AS chars FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY quality")
def _(t):
    path = scratch_path(t.spark, "json-lines")
    lake.export_jsonl(t.labelled.select("text", "label"), path)
    back = files.read_jsonl(t.spark, path, LABELLED_TEXT)
    return back.groupBy("label").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@query("s07_partitioned_csv", """
SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, COUNT(*) AS n, COUNT(DISTINCT strftime(ts, '%d')) AS days FROM events
GROUP BY ALL""")
def _(t):
    path = scratch_path(t.spark, "partitioned-csv")
    frame = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), json_to_map("props").alias("metadata"))
    lake.land_raw_csv(frame, path, "ts")
    scan = files.read_partitioned_csv(t.spark, path, "event_id BIGINT, ts TIMESTAMP, metadata STRING")
    return scan.groupBy("year", "month").agg(F.count("*").alias("n"), F.count_distinct("day").alias("days"))


@query("k05_append_records", """
SELECT COUNT(*) AS n, COUNT(*) AS ids, COUNT(*) FILTER (WHERE event_id % 4 <> 0) AS with_metadata, '2024-02-01 00:00:00.000000' AS created_at FROM events""")
def _(t):
    path = scratch_path(t.spark, "appended")
    kept = F.map_filter(json_to_map("props"), lambda k, v: F.col("event_id") % 4 != 0)
    tables.append_records(t.events.select("event_id", kept.alias("metadata")), path, now="2024-02-01 00:00:00")
    return t.spark.read.parquet(path).agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"),
                                          F.count("metadata").alias("with_metadata"), F.max("created_at").alias("created_at"))


@query("k12_incremental_read", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type")
def _(t):
    path, checkpoint = scratch_path(t.spark, "incremental"), scratch_path(t.spark, "incremental-checkpoint")
    source = table_path(t.sf_dir, "events")
    for _run in range(2):  # the second run finds no new files
        stream = read_stream(t.spark, "file", path=f"{source[:-1]}[{source[-1]}]", schema=t.events.schema)
        lake.process_new(t.spark, stream, path, checkpoint, lambda df: df)
    return t.spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("n"))
