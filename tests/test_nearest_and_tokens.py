"""Token ids by dictionary and by join, and nearest neighbours by a metric index, against plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.functions.text import first_tokens, tokens
from sparkloom.ml import neighbours, textprep

TEXTS = ["The cat, the dog.", "", None, "  ...  ", "ÜBER über a-b_c", "one", "!lead trail!", "a " * 300, "x" * 5000, "The cat, the dog."]


def plain_tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


@pytest.mark.parametrize("rows", [1_000_000, 2])
def test_token_ids_by_dictionary_and_by_join(spark, rows, monkeypatch):
    monkeypatch.setattr(textprep, "DICTIONARY_ROWS", rows)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    vocabulary = textprep.fit_vocabulary(df, "text", 4)
    counted = Counter(w for t in TEXTS for w in plain_tokens(t))
    known = {w: i + 2 for i, (w, _) in enumerate(sorted(counted.items(), key=lambda x: (-x[1], x[0]))[:4])}
    got = {r.id: r for r in textprep.encode_tokens(df, "id", "text", vocabulary, 6).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        ids = [known.get(w, 1) for w in plain_tokens(t)][:6]
        assert got[i].input_ids == ids + [0] * (6 - len(ids)) and got[i].attention_mask == [1] * len(ids) + [0] * (6 - len(ids))


def test_dictionary_path_shuffles_no_token(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    encoded = textprep.encode_tokens(df, "id", "text", textprep.fit_vocabulary(df, "text", 4), 6)
    assert "Exchange" not in encoded._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [1, 2, 5, 400])
def test_first_tokens_are_the_first_of_all(spark, n):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    for r in df.select(first_tokens("text", n).alias("a"), F.slice(tokens("text"), 1, n).alias("b")).collect():
        assert r.a == r.b


# ---------------------------------------------------------------- nearest neighbours

def nearest_by_force(train, test, k):
    out = {}
    for key, *x in test:
        if None in x:
            continue
        near = sorted((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)), label) for label, *y in train if None not in y and label is not None)[:k]
        votes = Counter(label for _, label in near)
        if votes:
            out[key] = min(votes, key=lambda v: (-votes[v], v))
    return out


def clusters(seed, n):
    rng = np.random.default_rng(seed)
    centre = rng.uniform(-100, 100, (30, 3))
    return np.round(centre[rng.integers(0, 30, n)] + rng.normal(size=(n, 3)), 1)


@pytest.mark.parametrize("k, cell_rows, max_pivots", [(5, 40, 1024), (1, 20, 7), (7, 100_000, 1024)])
def test_nearest_neighbours_equal_force(spark, k, cell_rows, max_pivots):
    """Clusters, ties, a third of the training rows equal, missing features and labels, far test rows."""
    rng = random.Random(4)
    train = [(float(rng.randrange(3)), *map(float, x)) for x in clusters(1, 900)]
    train += [(float(i % 2), *train[0][1:]) for i in range(400)] + [(1.0, None, 0.0, 0.0), (None, 0.0, 0.0, 0.0)]
    test = [(i, *map(float, x)) for i, x in enumerate(clusters(1, 150))]
    test += [(900, *train[0][1:]), (901, 1e6, -1e6, 0.0), (902, None, 1.0, 1.0), (903, 0.0, 0.0, 0.0)]
    a = spark.createDataFrame(train, "label double, x double, y double, z double")
    b = spark.createDataFrame(test, "id bigint, x double, y double, z double")
    got = {r.id: r.prediction for r in neighbours.knn_classify(a, b, ["x", "y", "z"], "label", "id", k, cell_rows, max_pivots).collect()}
    assert got == nearest_by_force(train, test, k)


def test_few_pairs_are_compared(spark):
    """The index compares a small part of all pairs of test and training rows."""
    train, test = clusters(3, 4000), clusters(3, 1000)
    a = spark.createDataFrame([(float(i % 2), *map(float, x)) for i, x in enumerate(train)], "label double, x double, y double, z double")
    b = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(test)], "id bigint, x double, y double, z double")
    found = neighbours.candidates(a, b, ["x", "y", "z"], "label", "id", 5, cell_rows=40)
    per_group = found.groupBy("_id", F.spark_partition_id(), "_compared").count()
    assert per_group.agg(F.sum("_compared")).first()[0] < 0.1 * len(train) * len(test)
    assert found.select("_id").distinct().count() == len(test)


def test_no_training_rows_no_predictions(spark):
    empty, some = (spark.createDataFrame(rows, "label double, id bigint, x double") for rows in ([], [(1.0, 1, 2.0)]))
    assert neighbours.knn_classify(empty, some, ["x"], "label", "id").count() == 0
    assert neighbours.knn_classify(some, empty, ["x"], "label", "id").count() == 0
    assert neighbours.knn_classify(some, some, ["x"], "label", "id").first().prediction == 1.0
