import random

import numpy as np
import pytest

from sparkloom.ml.features import stratified_split
from sparkloom.operators import order_stats
from sparkloom.operators.order_stats import first_fraction, order_statistics, percentiles


@pytest.mark.parametrize("values", [
    [5.0], [1.0, 2.0], [0.0] * 50, [-3.5, -3.5, 0.0, 1e9, 1e-9],
    [1_000_000.0 + i * 1e-6 for i in range(500)] + [-1e12, 1e12],
    [random.Random(1).lognormvariate(0, 4) * random.Random(i).choice([-1, 1]) for i in range(800)],
])
def test_percentiles_equal_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    probs = [0.0, 0.25, 0.5, 0.95, 1.0]
    row = percentiles(df, "v", probs).first()
    assert row["n"] == len(values)
    expected = np.quantile(values, probs)
    assert [row[f"p_{i}"] for i in range(5)] == pytest.approx(list(expected), rel=1e-12)


def test_percentiles_per_key_with_a_hot_key_and_null_key(spark):
    rng = random.Random(7)
    rows = [("hot", rng.random()) for _ in range(900)] + [(None, float(i)) for i in range(11)] + [("one", 4.0)]
    got = {r["k"]: r["p_0"] for r in percentiles(spark.createDataFrame(rows, "k string, v double"), "v", [0.3], ["k"]).collect()}
    for k in ("hot", None, "one"):
        assert got[k] == pytest.approx(np.quantile([v for key, v in rows if key == k], 0.3))


def test_empty_input_gives_no_row(spark):
    assert percentiles(spark.createDataFrame([], "v double"), "v", [0.5]).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5, 10, 101])
def test_first_fraction_with_ties(spark, n):
    df = spark.createDataFrame([(i, i // 4) for i in range(n)], "id bigint, at bigint")
    marked = {r.id: r.is_train for r in first_fraction(df, "at", "id", 0.8).collect()}
    assert marked == {i: i < int(0.8 * n) for i in range(n)}


def test_stratified_split_is_exact_disjoint_and_repeatable(spark):
    df = spark.createDataFrame([(i, "abc"[0 if i < 60 else 1 + i % 2]) for i in range(100)], "id bigint, s string")
    train, test = stratified_split(df, "id", 0.75, ["s"])
    ids = [r.id for r in train.collect()]
    assert set(ids).isdisjoint(r.id for r in test.collect()) and len(ids) == 45 + 15 + 15
    assert sorted(ids) == sorted(r.id for r in stratified_split(df, "id", 0.75, ["s"])[0].collect())


@pytest.mark.parametrize("values", [
    [1_000.0 + i * 1e-7 for i in range(3000)] + [1_001.0],  # one outlier stretches the bin
    [7.0] * 2500 + [7.0 + i * 1e-9 for i in range(600)] + [7.01],  # most rows share a value inside a crowded bin
    [2.0 ** 60] * 10 + [float(i % 50) for i in range(2000)],
])
def test_crowded_parts_are_narrowed_to_the_end(spark, values, monkeypatch):
    """However values are spread, what one task puts in order stays within the bound."""
    ordered = []
    real = order_stats._running

    def seen(df, by, order):
        if order == "_v":
            ordered.append(df.groupBy(*by).count().agg({"count": "max"}).first()[0])
        return real(df, by, order)

    monkeypatch.setattr(order_stats, "_running", seen)
    df = spark.createDataFrame([(v,) for v in values], "v double")
    at = [0, len(values) // 3, len(values) // 2, len(values) - 2, len(values) - 1]
    row = order_statistics(df, "v", [lambda n, k=k: order_stats.F.lit(k) for k in at], ordered_rows=150).first()
    by_value = sorted(values)
    assert [row[f"value_{i}"] for i in range(5)] == [by_value[k] for k in at]
    assert [row[f"before_{i}"] for i in range(5)] == [by_value.index(by_value[k]) for k in at]
    assert max(ordered) <= 150


@pytest.mark.parametrize("kind", ["bigint", "double", "timestamp", "string"])
def test_first_fraction_where_most_rows_share_the_cut(spark, kind):
    """All but a few rows of a key are tied; the cut among them follows the second column, missing ones first."""
    rng = random.Random(2)
    rows = [("a" if i % 3 else "b", 5 if i % 50 else i % 7, i) for i in range(2000)] + [("c", None, 3), ("c", 1, 4), (None, 2, 9)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, at int, id bigint").selectExpr(
        "k", "at", "id", "CAST(lpad(id, 9, '0') AS STRING) AS t" if kind == "string" else f"CAST(IF(id % 97 = 0, NULL, id) AS {kind}) AS t")
    got = {(r.k, r.id) for r in first_fraction(df, "at", "t", 0.7, ["k"], ordered_rows=100).collect() if r.is_train}
    for key in ("a", "b", "c", None):
        mine = [r for r in rows if r[0] == key and r[1] is not None]
        mine.sort(key=lambda r: (r[1], r[2] % 97 != 0 if kind != "string" else 0, r[2]))
        sure = {r[2] for r in mine[:int(0.7 * len(mine))]}
        found = {i for k, i in got if k == key}
        assert len(found) == len(sure)
        if kind == "string" or not any(r[2] % 97 == 0 for r in mine[int(0.7 * len(mine)) - 1:int(0.7 * len(mine)) + 1]):
            assert found == sure
