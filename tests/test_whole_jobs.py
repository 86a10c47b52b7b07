"""Registered queries run the job their operator describes, with its own settings."""

import json
import time

import pytest
from pyspark.sql import functions as F

from sparkloom.catalogue import QUERIES
from sparkloom.ml import features as feat, models
from sparkloom.plans import regression, sensor_forecast
from sparkloom.session import scratch_path
from sparkloom.streaming import run

SF = "/root/testdata/sf0.001"


class Called(Exception):
    pass


def call_of(monkeypatch, module, name, query, spark):
    """What a registered query hands to an operator."""
    def spy(*args, **settings):
        raise Called(args, settings)

    monkeypatch.setattr(module, name, spy)
    with pytest.raises(Called) as caught:
        QUERIES[query](spark, SF)
    return caught.value.args


def test_sensor_forecast_has_its_own_settings(spark, monkeypatch):
    args, settings = call_of(monkeypatch, sensor_forecast, "sensor_forecast", "z05_sensor_forecast", spark)
    assert args[1:] == ("station_id", "timestamp", "id") and not settings


def test_regression_has_its_own_settings(spark, monkeypatch):
    args, settings = call_of(monkeypatch, regression, "regression_run", "z07_regression", spark)
    assert args[1:] == (["predicted", "confidence"], "species", "actual", "row_id") and not settings


def test_grid_search_covers_the_grids_of_the_job(spark, monkeypatch):
    args, settings = call_of(monkeypatch, models, "grid_search", "m13_grid_search", spark)
    assert {name: len(grid) for name, (_, grid) in args[1].items()} == {"linear": 4, "ridge": 8, "lasso": 8, "forest": 4}
    assert settings == {"folds": 5}


def test_the_search_chooses_terms_in_its_folds(spark, tmp_path):
    """Degree and number of terms are searched; the terms are those of the rows a model learns from."""
    rows = [(i, float(i % 7), float(i % 5), float((i * i) % 11), (i % 7 - 3.0) * (i % 5 - 2.0) + 0.01 * (i % 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, a double, b double, c double, label double")
    train = feat.assemble(df, ["a", "b", "c"], "measures").cache()
    plain = models.linear("linear")
    pipeline, grid = regression.searched(plain, [{}], 3, degrees=(1, 2), ks=(1, 2, 50))
    assert sorted((m[pipeline.getStages()[1].degree], m[pipeline.getStages()[1].k]) for m in grid) == [
        (1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 6)]
    found = models.grid_search(train, {"linear": (pipeline, grid)}, folds=3)
    best = found.best.stages[1]
    assert best.getOrDefault("degree") == 2 and "0,1" in best.getOrDefault("terms") and found.best_metric < 0.01
    assert best.names(["a", "b", "c"])[best.getOrDefault("terms").index("0,1")] == "a_x_b"
    worst = max(found.scores.collect(), key=lambda r: r.mean_metric)
    assert "degree=1" in worst.parameters
    models.save_model(found.best, str(tmp_path / "model"))
    back = models.load_model(str(tmp_path / "model"))
    both = [[r.prediction for r in m.transform(train).orderBy("id").collect()] for m in (found.best, back)]
    assert both[0] == both[1]
    constant = feat.assemble(df.selectExpr("1.0D AS a", "label", "b"), ["a", "b"], "measures")
    assert pipeline.copy({pipeline.getStages()[1].k: 1}).fit(constant).stages[1].getOrDefault("terms") == ["1"]


def test_words_of_one_text_weigh(spark):
    train = spark.createDataFrame([("good alpha", 1.0), ("good beta", 1.0), ("bad gamma", 0.0)], "text string, label double")
    idf = models.text_model(train).stages[2]
    assert sum(x > 0 for x in idf.idf.toArray()[[i for i, n in enumerate(idf.docFreq) if n == 1]]) == 4


def test_progress_is_appended_to_a_table(spark, tmp_path):
    source = str(tmp_path / "in")
    for k in range(3):
        spark.range(k + 1).coalesce(1).write.mode("append").parquet(source)
    log = run.ProgressLog(scratch_path(spark, "progress"))
    assert log.table().count() == 0
    spark.streams.addListener(log)
    try:
        stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(source)
        query = run.micro_batch(stream.observe("rows", F.count("*").alias("n")), lambda df, i: df.count(),
                                scratch_path(spark, "batches"), trigger=None)
        query.awaitTermination()
        end = time.time() + 60
        while log.table().where("input_rows > 0").count() < 3 and time.time() < end:
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(log)
    rows = log.table().where("input_rows > 0").collect()
    assert sorted(r.batch for r in rows) == [0, 1, 2] and sum(r.input_rows for r in rows) == 6
    assert all("rows" in json.loads(r.observed) for r in rows)
