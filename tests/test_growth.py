"""What grows faster than the input on larger tables."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from sparkloom.ml import features as feat, forecast, forests, models, moments, selection
from sparkloom.operators import joins, resetting, windows
from sparkloom.operators.attach import BROADCAST_ROWS, attach
from sparkloom.plans import regression
from sparkloom.streaming import stateful


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_dimension_is_not_broadcast_by_the_size_of_its_file(spark, tmp_path):
    spark.range(20_000).selectExpr("id AS k", "id % 7 AS v").coalesce(1).write.parquet(str(tmp_path / "dim"))
    dim, fact = spark.read.parquet(str(tmp_path / "dim")), spark.range(500_000).selectExpr("id % 20000 AS k", "id AS n")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        assert "BroadcastHashJoin" in _plan(joins.lookup(fact, dim, "k"))
        salted = joins.lookup(fact, dim, "k", salt=64)
        assert "SortMergeJoin" in _plan(salted)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert salted.agg(F.count("*"), F.sum("v")).first() == joins.lookup(fact, dim, "k").agg(F.count("*"), F.sum("v")).first()


def test_crowded_slots_are_cut_by_their_number_of_event_times(spark):
    rng = np.random.default_rng(3)
    ms = np.unique(np.r_[rng.integers(0, 12_000_000, 900), 5_000_000 + rng.integers(0, 2_000, 600)])
    rows = spark.createDataFrame([("a", int(m)) for m in ms] + [("b", int(m)) for m in ms[::40]], "k string, ms bigint")
    times = rows.select(F.col("k").alias("_k"), F.col("ms").alias("_ms"), F.lit(0).cast("bigint").alias("_slot"),
                        F.lit(12_000_000).cast("bigint").alias("_width"))
    slots = resetting._in_slots(times, 100).groupBy("_k", "_slot").agg(
        F.count("*").alias("n"), F.min("_ms").alias("lo"), F.max("_ms").alias("hi")).orderBy("_k", "_slot").collect()
    assert max(s.n for s in slots) <= 100
    # spans of 100 ms, as many as nearly each event time by itself, were 900 and more
    assert len(slots) < 150
    assert all(x.hi < y.lo for x, y in zip(slots, slots[1:]) if x["_k"] == y["_k"])
    found = resetting.window_starts(rows, "k", "ms", 1_000_000, slot_times=100, group_rows=50).collect()
    for key, at in (("a", ms), ("b", ms[::40])):
        starts = dict(zip(at.tolist(), resetting.chain_starts(at, 1_000_000, None).tolist()))
        assert {r["_ms"]: r.window_start for r in found if r["_k"] == key} == starts


def _readings(spark, keys, rows):
    return spark.range(keys * rows).selectExpr(f"id % {keys} AS k", f"timestamp_seconds(id DIV {keys} * 600) AS ts", "id", "id * 0.5D AS v")


def test_figures_of_many_keys_are_not_sent_to_every_executor(spark):
    many = spark.range(BROADCAST_ROWS + 1).selectExpr("id AS k", "1 AS one")  # well below the threshold as a file
    rows = spark.range(2_000_000).selectExpr("id % 1000 AS k", "id AS n")
    assert "SortMergeJoin" in _plan(attach(rows, many, ["k"], "_f"))
    assert "BroadcastHashJoin" in _plan(attach(rows, many.where("k < 1000"), ["k"], "_f"))


def test_keys_of_one_run_need_no_slots(spark):
    runs = windows.with_lookback(_readings(spark, 50, 40), ["k"], "ts", 24, "id", run_rows=40)
    assert "Join" not in _plan(runs)
    assert runs.where("_halo OR _run <> 0").count() == 0


def test_busy_and_quiet_keys_look_back_alike(spark):
    quiet, busy = _readings(spark, 30, 20), _readings(spark, 3, 500).selectExpr("k + 100 AS k", "ts", "id + 10000 AS id", "v")
    both = quiet.unionByName(busy).unionByName(quiet.where("k = 0").selectExpr("NULL AS k", "ts", "id + 90000 AS id", "v"))
    cut = windows.lags(both, ["k"], "ts", "id", "v", [1, 24], run_rows=60, slot_seconds=3600).select("id", "temp_lag_1", "temp_lag_24")
    whole = both.selectExpr("id", "lag(v, 1) OVER (PARTITION BY k ORDER BY ts, id)", "lag(v, 24) OVER (PARTITION BY k ORDER BY ts, id)")
    assert {r[0]: tuple(r) for r in cut.collect()} == {r[0]: tuple(r) for r in whole.collect()} and cut.count() == both.count()


def test_rows_to_learn_trees_from_are_dealt_over_all_cores(spark, monkeypatch):
    rows = spark.range(1000).coalesce(1).selectExpr("(id * 37) % 1000 AS label", "id")
    counts = models.dealt(rows).rdd.mapPartitions(lambda part: [[r.label for r in part]]).collect()
    assert [len(c) for c in counts] == [250] * 4 and all(c == sorted(c) for c in counts)
    met = []
    monkeypatch.setattr(models.RandomForestRegressor, "fit", lambda self, df: met.append(df.rdd.getNumPartitions()))
    models.fit(models.forest(), rows)
    assert met == [4]


def test_rows_to_learn_trees_from_come_in_whole_rounds_of_the_cores(spark):
    for parts, dealt in ((5, 4), (7, 8), (9, 8)):
        assert models.dealt(spark.range(0, 1000, 1, parts).withColumnRenamed("id", "label")).rdd.getNumPartitions() == dealt


def test_a_search_fits_shared_stages_once_per_fold(spark, monkeypatch):
    rows = spark.range(300).selectExpr("id % 7 + 0.5D AS a", "id % 5 + 0.0D AS b", "(id % 7) * (id % 5) + id % 3 + 0.0D AS label")
    train = feat.assemble(rows, ["a", "b"], "measures")
    lasso = models.linear("lasso")
    pipeline, grid = regression.searched(lasso, models.ParamGridBuilder().addGrid(lasso.regParam, [0.01, 0.1, 1.0]).build(), 2, ks=(1, 2))
    fits, fit_terms = [], selection.BestTerms._fit
    monkeypatch.setattr(selection.BestTerms, "_fit", lambda self, df: (fits.append(1), fit_terms(self, df))[1])
    found = models.grid_search(train, {"lasso": (pipeline, grid)}, folds=3)
    assert len(grid) == 12 and len(fits) == 3 * 4 + 1  # four choices of terms a fold, and the winner's
    stored = models.materialise(models.dealt(train), "search")
    whole = models.cross_validate(stored, pipeline, grid, 3)
    assert [r.mean_metric for r in found.scores.collect()] == pytest.approx(whole.avgMetrics, rel=1e-9)
    assert [r.std_metric for r in found.scores.collect()] == pytest.approx(whole.stdMetrics, rel=1e-6)
    assert found.best.stages[1].getOrDefault("terms") == whole.bestModel.stages[1].getOrDefault("terms")


def test_rows_remember_their_nodes_while_a_forest_is_learnt():
    assert models.forest().getCacheNodeIds()


class _State:
    held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value


def test_monitors_of_a_busy_key_put_out_slices(monkeypatch):
    monkeypatch.setattr(stateful, "SLICE_ROWS", 100)
    rng = np.random.default_rng(1)
    rows = pd.DataFrame({"path": "a", "event_ms": rng.integers(0, 50_000, 1000), "id": np.arange(1000), "status_code": rng.choice([200, 500], 1000),
                         "processing_time_ms": 1.0})
    for monitor, counter, first in ((stateful.RequestMonitor(threshold=3, window_ms=900, suppress_ms=2000), "request_count", "metrics"),
                                    (stateful.ErrorRateMonitor(window_ms=900, min_requests=3), "total_requests", "error_metrics")):
        monitor.window, monitor.alerted = _State(), _State()
        parts = [rows.iloc[0:400], rows.iloc[400:700], rows.iloc[700:]]
        out = list(monitor.handleInputRows(("a",), iter(parts), None))
        assert max(map(len, out)) == 100
        made = pd.concat(out)
        made = made[made["record"] == first]
        ordered = rows.sort_values(["event_ms", "id"])
        starts = resetting.chain_starts(ordered["event_ms"].to_numpy(), 900, None)
        assert made["id"].tolist() == ordered["id"].tolist()
        assert made[counter].tolist() == (ordered.groupby(starts).cumcount() + 1).tolist()
        if counter == "total_requests":
            assert made["error_requests"].tolist() == (ordered["status_code"] >= 400).astype(int).groupby(starts).cumsum().tolist()


def _rows_to_learn(spark, n=4000):
    rows = spark.range(n).selectExpr("rand(5) * 8 AS a", "floor(rand(6) * 5) + 0.0D AS b", "rand(7) AS c", "id").selectExpr(
        "a", "b", "c", "id", "a * a + 10 * b + rand(8) AS label")
    return models.materialise(feat.assemble(rows, ["a", "b", "c"], "features").coalesce(3), "rows")


def _nodes(model):
    return [t.toDebugString.split("\n", 1)[1] for t in model.trees]


def test_a_forest_learns_from_packed_chunks(spark, monkeypatch):
    monkeypatch.setattr(forests, "CHUNK_ROWS", 300)
    monkeypatch.setattr(forests, "PART_ROWS", 700)
    monkeypatch.setattr(forests, "HISTOGRAM_BYTES", 20_000)
    monkeypatch.setattr(RandomForestRegressor, "_fit", lambda self, df: pytest.fail("learnt in MLlib"))
    rows, learner = _rows_to_learn(spark), models.forest(6, 5, min_leaf=3)
    grown = forests.grow(learner, rows)
    stored = forests.packed(forests._labelled(learner, rows), grown.cuts, grown.sample, grown.rows, grown.mean, 42)
    chunks = list(forests._chunks((pa.RecordBatch.from_pylist([r.asDict()]) for r in stored.collect()), 3))
    assert len(chunks) >= 8 and sum(len(c.y) for c in chunks) == 4000
    for tree in grown.trees:  # by force: each row drawn by itself walks by itself
        count, total, squares = (np.zeros(len(tree.left)) for _ in range(3))
        by_node = {}
        for c in chunks:
            cell = np.searchsorted(c.starts, np.arange(len(c.y)), "right") - 1
            for bins, y, drawn in zip(c.cells.T[cell], c.y, forests.draws(len(c.y), 42, tree.number, c.id), strict=True):
                node, last = 0, -1
                while node != last:
                    count[node] += drawn
                    total[node] += drawn * y
                    squares[node] += drawn * y * y
                    by_node.setdefault(node, []).append((bins, y, drawn))
                    last, node = node, tree.left[node] + int(bins[tree.feature[node]] > tree.cut[node])
        assert np.allclose(count, tree.count) and np.allclose(total, tree.total) and np.allclose(squares, tree.squares)
        bins, y, drawn = map(np.array, zip(*by_node[0]))  # no other cut of that feature drops the variance of the root more
        f, drops = tree.feature[0], {}
        for cut in range(len(grown.cuts[f])):
            sides = [s for s in (bins[:, f] <= cut, bins[:, f] > cut) if drawn[s].sum() >= 3]
            if len(sides) == 2:
                within = sum(drawn[s] @ (y[s] - np.average(y[s], weights=drawn[s])) ** 2 for s in sides)
                drops[cut] = np.average((y - np.average(y, weights=drawn)) ** 2, weights=drawn) - within / drawn.sum()
        assert drops[tree.cut[0]] == pytest.approx(max(drops.values())) == pytest.approx(tree.gain[0])
        assert tree.count[tree.cut == 255].min() >= 3 and tree.level.max() == 5
    model = learner.fit(rows)
    again = grown.model(learner, spark)
    assert _nodes(model) == _nodes(again) and model.numFeatures == 3 and model.getNumTrees == 6
    assert sum(model.featureImportances.toArray()) == pytest.approx(1)


def test_a_forest_foretells_as_well_as_that_of_mllib(spark):
    rows = _rows_to_learn(spark)
    train, test = rows.where("id % 4 <> 0"), rows.where("id % 4 = 0")
    settings = {"numTrees": 30, "maxDepth": 8, "seed": 3}
    own, theirs = (models._evaluator("rmse", "label").evaluate(kind(**settings).fit(train).transform(test)) for kind in (forests.Forest, RandomForestRegressor))
    assert own == pytest.approx(theirs, rel=0.1)
    flat = forests.Forest(numTrees=3).fit(rows.selectExpr("features", "2.5D AS label"))
    assert [t.numNodes for t in flat.trees] == [1, 1, 1] and {r.prediction for r in flat.transform(test).collect()} == {2.5}
    weighed = forests.Forest(numTrees=3, weightCol="b")
    assert not weighed.learns_here(rows) and weighed.fit(rows).getNumTrees == 3  # in MLlib


def test_draws_of_a_tree_are_a_poisson_number():
    found = np.bincount(forests.draws(1_000_000, 1, 2, 3), minlength=4)[:4] / 1e6
    assert found == pytest.approx([np.exp(-1), np.exp(-1), np.exp(-1) / 2, np.exp(-1) / 6], abs=0.002)
    assert (forests.draws(50, 1, 2, 3) != forests.draws(50, 1, 3, 3)).any()


def test_a_search_grows_one_forest_a_fold_and_adds_up_moments(spark, monkeypatch):
    rows = _rows_to_learn(spark, 1500)
    wood, plain = models.forest(4, 3), models.linear("ridge", 1.0, 0.001)
    grids = {"forest": (wood, models.ParamGridBuilder().addGrid(wood.numTrees, [4, 9]).addGrid(wood.maxDepth, [2, 5]).build()),
             "ridge": (plain, models.ParamGridBuilder().addGrid(plain.regParam, [0.001, 0.1, 10.0]).build())}
    grown, added, grow, add = [], [], models.grow, models.moments
    monkeypatch.setattr(models, "dealt", lambda df, label: df)  # folds go by the places of the rows
    monkeypatch.setattr(models, "materialise", lambda df, label: df)
    monkeypatch.setattr(models, "grow", lambda *a: (grown.append(a[0].getNumTrees()), grow(*a))[1])
    monkeypatch.setattr(models, "moments", lambda *a: (added.append(1), add(*a))[1])
    found = models.grid_search(rows.select("features", "label"), grids, folds=3, metric="rmse")
    assert grown == [9, 9, 9] and len(added) == 3 * 2
    scores = {(r.model, r.parameters): r.mean_metric for r in found.scores.collect()}
    for name, (learner, grid) in grids.items():  # each setting by itself, over the same folds
        whole = models.cross_validate(rows.select("features", "label"), learner, grid, 3, "rmse")
        alone = [scores[name, ", ".join(sorted(f"{p.name}={v}" for p, v in params.items()))] for params in grid]
        assert alone == pytest.approx(whole.avgMetrics, rel=1e-9)


@pytest.mark.parametrize("metric", ["mse", "rmse", "mae", "r2"])
def test_errors_of_forests_and_moments_are_those_of_the_evaluator(spark, metric):
    rows = _rows_to_learn(spark, 1200)
    train, held = rows.where("id % 3 <> 0"), rows.where("id % 3 = 0")
    evaluator, wood = models._evaluator(metric, "label"), models.forest(7, 6)
    grown = forests.grow(wood, train)
    smaller = [wood, wood.copy({wood.numTrees: 3}), wood.copy({wood.maxDepth: 2})]
    alone = [x.fit(train) for x in smaller]
    assert _nodes(alone[1]) == _nodes(alone[0])[:3]
    assert grown.errors(smaller, held, metric) == pytest.approx([evaluator.evaluate(m.transform(held)) for m in alone], rel=1e-9)
    if metric != "mae":
        line = models.linear("lasso", 0.1)
        fitted = moments.fit_from_moments(line, moments.moments(train, "features", "label"), spark)
        assert fitted.coefficients.toArray() == pytest.approx(line.fit(train).coefficients.toArray(), rel=1e-9)
        assert moments.moments(held, "features", "label").error(fitted, metric) == pytest.approx(evaluator.evaluate(fitted.transform(held)), rel=1e-9)


def test_moments_of_a_constant_feature_and_of_few_rows(spark):
    rows = spark.range(50).selectExpr("3.0D AS a", "id + 0.0D AS b", "id * 2 + 1.0D AS label")
    train = feat.assemble(rows, ["a", "b"], "features")
    for kind in (models.linear("linear"), models.linear("ridge", 1.0, 0.01)):
        fitted = moments.fit_from_moments(kind, moments.moments(train, "features", "label"), spark)
        plain = kind.fit(train)
        assert fitted.coefficients.toArray() == pytest.approx(plain.coefficients.toArray(), abs=1e-9)
        assert fitted.intercept == pytest.approx(plain.intercept, abs=1e-8)
    assert moments.moments(train.limit(0), "features", "label").n == 0


def test_forecasts_learn_in_mllib(spark, monkeypatch):
    met, fit_stages = [], forecast.fit_stages
    monkeypatch.setattr(forecast, "fit_stages", lambda df, stages: (met.append(type(stages[-1])), fit_stages(df, stages))[1])
    forecast.train_sensor_model(_readings(spark, 2, 30).withColumnRenamed("v", "temperature").withColumn("a", F.col("id") % 5), ["a"], "ts", "id", trees=2, depth=2)
    assert met == [RandomForestRegressor] and type(models.forest()) is forests.Forest
