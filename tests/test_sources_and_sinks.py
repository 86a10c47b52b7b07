import datetime as dt
import gzip
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from sparkloom import schemas
from sparkloom.ml import models as mod, neighbours
from sparkloom.ml.features import assemble
from sparkloom.plans import bi, weather_batch
from sparkloom.session import scratch_path
from sparkloom.sinks import lake, tables
from sparkloom.sources import files, streams
from sparkloom.streaming import run

AT = dt.datetime(2024, 3, 9, 5, 0)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def write(path, text, mode="w", encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode, encoding=encoding) as f:
        f.write(text)
    return path


def test_csv_na_is_null_and_bom_is_skipped(spark, folder):
    row = "2008,7,2,3,733,735,858,852,DL,1551,N957DL,85,77,42,6,-2,CAE,ATL,191,15,28,0,,0,NA,NA,NA,NA,NA"
    header = ("Year,Month,DayofMonth,DayOfWeek,DepTime,CRSDepTime,ArrTime,CRSArrTime,UniqueCarrier,FlightNum,TailNum,ActualElapsedTime,"
              "CRSElapsedTime,AirTime,ArrDelay,DepDelay,Origin,Dest,Distance,TaxiIn,TaxiOut,Cancelled,CancellationCode,Diverted,"
              "CarrierDelay,WeatherDelay,NASDelay,SecurityDelay,LateAircraftDelay")
    path = write(f"{folder}/flights.csv", f"{header}\n{row}\n")
    typed = files.read_csv(spark, path, schemas.FLIGHTS).first()
    assert (typed.TailNum, typed.ArrDelay, typed.WeatherDelay) == ("N957DL", 6, None)
    inferred = files.read_csv(spark, path)
    assert dict(inferred.dtypes)["Distance"] == "int" and inferred.first().CarrierDelay is None
    fish = write(f"{folder}/fish.csv", "Species,Weight\nBream,242\n", encoding="utf-8-sig")
    assert files.read_csv(spark, fish).columns == ["Species", "Weight"]


def test_json_lines_and_documents(spark, folder):
    lines = write(f"{folder}/a.jsonl", '{"text": "a", "label": 1}\n{"text": "b"}\n')
    assert [tuple(r) for r in files.read_jsonl(spark, lines, schemas.LABELLED_TEXT).collect()] == [("a", 1), ("b", None)]
    whole = write(f"{folder}/b.json", json.dumps([{"text": "a", "label": 1}, {"text": "b", "label": 0}], indent=1))
    assert files.read_json_multiline(spark, whole, schemas.LABELLED_TEXT).count() == 2


def test_partitioned_gzip_csv_keeps_zero_padded_keys(spark, folder):
    for day in ("08", "09"):
        part = f"{folder}/raw/year=2024/month=03/day={day}"
        os.makedirs(part)
        with gzip.open(f"{part}/x.csv.gz", "wt") as f:
            f.write("station_id,temperature\ns1,1.5\n")
    df = files.read_partitioned_csv(spark, f"{folder}/raw", "station_id STRING, temperature DOUBLE")
    assert {tuple(r) for r in df.collect()} == {("s1", 1.5, "2024", "03", "08"), ("s1", 1.5, "2024", "03", "09")}
    plan = df.where("day = '09'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day" in plan.split("PartitionFilters")[1]


def test_rows_views_and_tables(spark, folder):
    df = files.register(files.from_rows(spark, [(1, "a")], ["id", "name"]), "people_view")
    assert spark.sql("SHOW TABLES LIKE 'people_view'").count() == 1 and df.count() == 1
    name = f"weather_{uuid.uuid4().hex[:8]}"
    for _ in range(2):  # the second call finds everything in place
        assert tables.create_tables(spark, name, f"{folder}/{name}") == list(tables.WEATHER_TABLES)
    facts = spark.createDataFrame([("s1", AT, 1.0)], "station_id string, measurement_time timestamp, temperature_celsius double")
    lake.write_lake(facts.withColumns({"year": F.lit("2024"), "month": F.lit("03"), "day": F.lit("09")}), f"{folder}/{name}/processed_weather")
    # partitions written behind the catalog's back appear after a refresh
    assert files.read_table(spark, name, "processed_weather").count() == 0
    tables.refresh_table(spark, name, "processed_weather")
    row = files.read_table(spark, name, "processed_weather").first()
    assert (row.station_id, row.heat_index_celsius, row.day) == ("s1", None, "09")
    assert tables.known_partitions(spark, name, "processed_weather").first()[0] == "year=2024/month=03/day=09"


def test_schema_changes_are_merged(spark, folder):
    spark.range(2).write.parquet(f"{folder}/a")
    spark.range(2).withColumn("extra", F.lit("x")).write.parquet(f"{folder}/b")
    assert tables.merged_schema(spark, [f"{folder}/a", f"{folder}/b"]).columns == ["id", "extra"]


def test_jdbc_round_trip_with_pushed_predicate(spark):
    url = f"jdbc:derby:memory:db{uuid.uuid4().hex[:8]};create=true"
    df = spark.createDataFrame([("s1", 1.5), ("s2", 40.0)], "station string, t double")
    tables.write_jdbc(df, url, "readings", mode="overwrite", writers=1)
    tables.write_jdbc(df, url, "readings")
    back = files.read_jdbc(spark, url, "readings", "t > 10")
    assert back.count() == 2
    assert "PushedFilters: [*IsNotNull(t), *GreaterThan(t" in back._jdf.queryExecution().executedPlan().toString()


def test_record_keys(spark):
    df = spark.createDataFrame([({"a": "1"},), ({},)], "metadata map<string,string>")
    rows = tables.with_record_keys(df, now=AT).collect()
    assert len({r.id for r in rows}) == 2 and [r.metadata for r in rows] == ['{"a":"1"}', None] and rows[0].created_at == AT


def test_lake_folders(spark, folder):
    df = spark.createDataFrame([("s1", AT, {"k": "é"})], "station_id string, ts timestamp, metadata map<string,string>")
    lake.write_json_lake(df, f"{folder}/json", "ts", "station_id")
    assert os.listdir(f"{folder}/json/year=2024/month=03/day=09") == ["station=s1"]
    lake.land_raw_csv(df, f"{folder}/csv", "ts")
    back = files.read_partitioned_csv(spark, f"{folder}/csv", "station_id STRING, ts TIMESTAMP, metadata STRING").first()
    assert json.loads(back.metadata) == {"k": "é"} and back.ts == AT
    lake.export_jsonl(df.select("station_id", "metadata"), f"{folder}/lines")
    text = [open(f"{folder}/lines/{f}", encoding="utf-8").read() for f in os.listdir(f"{folder}/lines") if f.endswith(".json")]
    assert any("é" in t for t in text)


def test_rewriting_a_range_leaves_other_days(spark, folder):
    days = spark.createDataFrame([(i, dt.datetime(2024, 3, d)) for i, d in enumerate((1, 1, 2, 3))], "id bigint, ts timestamp")
    keyed = days.withColumns({"year": F.date_format("ts", "yyyy"), "month": F.date_format("ts", "MM"), "day": F.date_format("ts", "dd")})
    lake.write_lake(keyed, f"{folder}/lake")
    fixed = lake.process_range(keyed, "ts", "2024-03-01", "2024-03-01").withColumn("id", F.col("id") + 100)
    for _ in range(2):
        lake.rewrite_range(fixed, f"{folder}/lake")
    assert sorted(r.id for r in spark.read.parquet(f"{folder}/lake").collect()) == [2, 3, 100, 101]


def test_process_new_takes_only_unseen_files(spark, folder):
    os.makedirs(f"{folder}/in")
    for n in (1, 2):
        spark.range(n * 10, n * 10 + 3).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        source = streams.read_stream(spark, "file", path=f"{folder}/in", schema="id BIGINT")
        lake.process_new(spark, source, f"{folder}/out", f"{folder}/cp", lambda df: df.where("id % 10 < 2"))
        assert spark.read.parquet(f"{folder}/out").count() == 2 * n


def test_bi_export_counts(spark, folder):
    facts = spark.createDataFrame([("a", None), ("b", 2)], "name string, n int")
    preds = spark.createDataFrame([(0.0, 1.0)], "actual double, predicted double")
    got = bi.bi_datasets(facts, preds, spark.range(3), folder, "test", "actual", "predicted", AT)
    assert {r.dataset: r.records for r in got.collect()} == {"facts": 2, "predictions": 1, "metrics": 3}
    back = spark.read.option("header", True).csv(f"{folder}/facts").collect()
    assert {r.n for r in back} == {"0.0", "2.0"} and back[0].data_source == "test"


def test_metrics_table_grows_by_run(spark, folder):
    for _ in range(2):
        table = tables.record_metrics(spark, f"{folder}/metrics", "job", {"total": 10, "valid": 7})
    assert table.count() == 4


def test_weather_batch_counts_each_run_on_its_own(spark, folder):
    rows = [("s1", "2024-01-01T05:00:00Z", 20.0, 50.0, 1000.0, 5.0, 10.0, "fine", "{}"),
            ("s1", "2024-01-01T06:00:00Z", 99.0, 50.0, 1000.0, 5.0, 10.0, "odd", "{}"), ("s1", "never", 20.0, 50.0, 1000.0, 5.0, 10.0, "odd", "{}")]
    raw = spark.createDataFrame(rows, schemas.RAW_WEATHER)
    for _ in range(2):
        metrics = weather_batch.weather_batch(raw, folder)
    assert metrics["records"] == 3 and metrics["valid_records"] == 1 and metrics["quality_score"] == pytest.approx(100 / 3)
    fact = spark.read.parquet(f"{folder}/processed").first()
    assert (fact.month, fact.day, fact.hour, fact.data_quality_score) == (1, 1, 5, 100.0)
    assert spark.read.parquet(f"{folder}/aggregated").count() == 4


def test_weather_batch_reads_its_source_twice(spark, folder):
    """Also with one clock for two runs, counts are those of the run."""
    rows = [(f"s{i % 3}", f"2024-01-0{1 + i % 2}T05:00:00Z", 20.0, 50.0 if i % 4 else 500.0, 1000.0, 5.0, 10.0, "fine", "{}") for i in range(40)]
    read = spark.sparkContext.accumulator(0)

    def counted(parts):
        for pdf in parts:
            read.add(len(pdf))
            yield pdf

    raw = spark.createDataFrame(rows, schemas.RAW_WEATHER)
    raw = raw.mapInPandas(counted, raw.schema)
    for run in (1, 2):
        metrics = weather_batch.weather_batch(raw, folder, "2024-01-05 00:00:00")
        assert (metrics["records"], metrics["valid_records"]) == (40, 30) and read.value == 2 * 40 * run
    assert spark.read.parquet(f"{folder}/aggregated").agg({"measurement_count": "sum"}).first()[0] == 2 * 2 * 30


def test_lake_leaves_one_file_a_folder(spark, folder):
    """Rows scattered over tasks come together by folder."""
    df = spark.range(400).repartition(8).selectExpr("id", "'2024' AS year", "'01' AS month", "CAST(id % 5 AS STRING) AS day")
    lake.write_lake(df, f"{folder}/lake")
    assert len({r.f for r in spark.read.parquet(f"{folder}/lake").selectExpr("input_file_name() AS f").collect()}) == 5


def test_model_round_trip(spark, folder):
    df = assemble(spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], "x double, label double"), ["x"])
    stages = mod.fit_stages(df, [mod.linear()])
    mod.save_model(stages, f"{folder}/model")
    again = mod.load_model(f"{folder}/model").transform(df).orderBy("x").first()
    assert again.prediction == pytest.approx(1.0, abs=1e-6)


def test_ridge_alpha_means_the_same_as_on_one_machine(spark):
    import numpy as np

    xs, ys = np.arange(10.0) - 4.5, 3 * np.arange(10.0)
    df = assemble(spark.createDataFrame(list(zip(xs.tolist(), ys.tolist())), "x double, label double"), ["x"])
    fitted = mod.linear("ridge", 5.0, unit=mod.ridge_unit(df)).fit(df)
    assert fitted.coefficients[0] == pytest.approx((xs @ (ys - ys.mean())) / (xs @ xs + 5.0), rel=1e-6)


def test_nearest_neighbours_equal_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    x, labels = rng.integers(0, 6, (120, 2)).astype(float), rng.integers(0, 3, 120)
    df = spark.createDataFrame([(i, float(a), float(b), int(l)) for i, ((a, b), l) in enumerate(zip(x, labels))], "id bigint, a double, b double, label int")
    train, test = df.where("id < 80"), df.where("id >= 80")
    want = {}
    for i in range(80, 120):
        order = sorted(range(80), key=lambda j: (((x[i] - x[j]) ** 2).sum(), labels[j]))[:5]
        votes = [int(labels[j]) for j in order]
        want[i] = min(set(votes), key=lambda v: (-votes.count(v), v))
    for block_rows in (7, 1000):
        got = neighbours.knn_classify(train, test, ["a", "b"], "label", "id", 5, block_rows)
        assert {r.id: int(r.prediction) for r in got.collect()} == want


def test_kafka_settings_and_unknown_kind(spark):
    options = streams.kafka_options("host:9092", "http-events", max_offsets=500)
    assert options["subscribe"] == "http-events" and options["startingOffsets"] == "latest" and options["maxOffsetsPerTrigger"] == "500"
    with pytest.raises(ValueError):
        streams.read_stream(spark, "socket")


def test_ingest_metadata(spark, folder):
    spark.range(3).coalesce(1).write.parquet(f"{folder}/in")
    source = streams.read_stream(spark, "file", path=f"{folder}/in", schema="id BIGINT")
    rows = run.run_available(streams.with_ingest_meta(source), "meta").collect()
    assert all(r.arrival_time is not None and r.source_file.endswith(".parquet") for r in rows)


def test_scratch_is_shared_and_fresh(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))
