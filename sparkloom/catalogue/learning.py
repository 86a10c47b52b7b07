"""Feature engineering, models, forecasts and text preparation."""

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..ml import features as feat, forecast as fc, models as mod, neighbours, textprep as prep
from ..operators import cleaning as ops, statistics as st
from ..plans import regression
from ..session import materialise, scratch_path
from .registry import query

SIZES = ["Length1", "Length2", "Length3", "Width"]


def sized(t):
    """Complete measurement rows with a unique id and a vector of scaled sizes."""
    frame = t.scored.select("row_id", "species", F.col("actual").alias("Weight"), F.col("predicted").alias("Length1"),
                            (F.col("confidence") * 10).alias("Length2"), (F.col("row_id") % 97).cast("double").alias("Length3"),
                            (F.col("row_id") % 31).cast("double").alias("Width"))
    return feat.standardise(frame, SIZES)


def vectors(t):
    return feat.assemble(sized(t), SIZES).select("row_id", "species", "features", F.col("Weight").alias("label"))


def parts(marked):
    """Training and test rows of a marked frame, split once."""
    stored = materialise(marked, "split")
    return stored.where("is_train").drop("is_train"), stored.where(~F.col("is_train")).drop("is_train")


@query("m01_assemble", "SELECT COUNT(*) AS n, SUM(Distance + TaxiIn)::DOUBLE AS total FROM {flights}")
def _(t):
    vector = feat.assemble(t.flights, feat.FLIGHT_FEATURES).select(vector_to_array("features").alias("v"))
    return vector.agg(F.count("*").alias("n"), F.round(F.sum(F.col("v")[5] + F.col("v")[6]), 1).alias("total"))


@query("m02_index_by_frequency", """
SELECT event_type, row_number() OVER (ORDER BY COUNT(*) DESC, event_type) - 1.0E0 AS code, COUNT(*) AS n FROM events GROUP BY event_type""")
def _(t):
    indexed = feat.index_category(t.events, "event_type", out="code")
    return indexed.groupBy("event_type", "code").agg(F.count("*").alias("n"))


@query("m02_index_by_name", """
SELECT lang, row_number() OVER (ORDER BY lang) - 1.0E0 AS code, COUNT(*) AS n FROM documents GROUP BY lang""")
def _(t):
    indexed = feat.index_category(t.documents, "lang", "alphabetAsc", "code")
    return indexed.groupBy("lang", "code").agg(F.count("*").alias("n"))


@query("m03_one_hot", """
SELECT event_id, (event_type = 'error')::DOUBLE AS event_type_error, (event_type = 'purchase')::DOUBLE AS event_type_purchase,
  (event_type = 'signup')::DOUBLE AS event_type_signup, (event_type = 'view')::DOUBLE AS event_type_view FROM events""")
def _(t):
    kinds = ["click", "error", "purchase", "signup", "view"]
    return feat.one_hot(t.events.select("event_id", "event_type"), "event_type", kinds).drop("event_type")


@query("m04_standardise", """
SELECT row_id, ROUND((actual - m) / s, 4) + 0.0 AS actual FROM {scored},
  (SELECT AVG(actual) AS m, stddev_pop(actual) AS s FROM {scored})""")
def _(t):
    return feat.standardise(t.scored.select("row_id", "actual"), ["actual"])


@query("m05_poly_features", """
SELECT row_id, ROUND(predicted * confidence, 4) AS predicted_x_confidence, ROUND(predicted * predicted, 1) AS predicted_x_predicted FROM {scored}""")
def _(t):
    terms = feat.poly_features(t.scored, ["predicted", "confidence"], 2).withColumn(
        "predicted_x_predicted", F.round("predicted_x_predicted", 1))
    return terms.select("row_id", "predicted_x_confidence", "predicted_x_predicted")


@query("m05_interactions", """
SELECT row_id, ROUND(confidence * (row_id % 10), 4) AS confidence_x_digit FROM {scored}""")
def _(t):
    frame = t.scored.select("row_id", "confidence", (F.col("row_id") % 10).alias("digit"))
    return feat.poly_features(frame, ["confidence", "digit"], 2, interaction_only=True).select("row_id", "confidence_x_digit")


@query("m06_f_scores", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, ROUND(pow(corr({c}, Weight), 2) / (1 - pow(corr({c}, Weight), 2)) * (COUNT(*) - 2), 2) AS f_score FROM {{fish}}"
    for c in SIZES))
def _(t):
    return feat.f_scores(t.fish, SIZES, "Weight").withColumn("f_score", F.round("f_score", 2))


@query("m07_stratified_split", """
SELECT species, CAST(floor(COUNT(*) * 0.8) AS BIGINT) AS train, COUNT(*) - CAST(floor(COUNT(*) * 0.8) AS BIGINT) AS test FROM {scored} GROUP BY species""")
def _(t):
    marked = feat.mark_stratified(t.scored.select("row_id", "species"), "row_id", 0.8, ["species"])
    return marked.groupBy("species").agg(F.count_if("is_train").alias("train"), F.count_if(~F.col("is_train")).alias("test"))


@query("m08_delay_model")
def _(t):
    known = ops.not_null(t.flights, ["ArrDelay"])
    _model, scored, auc = mod.delay_model(known)
    return st.classification_metrics(scored, "delayed", "prediction").withColumn("auc", F.lit(auc))


@query("m09_fit_stages", "SELECT COUNT(*) AS n, COUNT(DISTINCT COALESCE(UniqueCarrier, '')) AS codes FROM {flights}")
def _(t):
    vector = mod.carrier_features(t.flights).select(vector_to_array("features").alias("v"))
    return vector.agg(F.count("*").alias("n"), F.count_distinct(F.col("v")[0]).alias("codes"))


@query("m10_linear_models")
def _(t):
    train, test = parts(feat.mark_stratified(vectors(t), "row_id", 0.8, ["species"]))
    return mod.compare_models(train, test, {
        "linear": mod.linear("linear"), "ridge": mod.linear("ridge", 1.0, mod.ridge_unit(train)), "lasso": mod.linear("lasso", 0.1)})


@query("m11_tree_models")
def _(t):
    train, test = parts(feat.mark_stratified(vectors(t), "row_id", 0.8, ["species"]))
    return mod.compare_models(train, test, {"forest": mod.forest(), "tree": mod.tree()})


def _classes(t):
    frame = feat.assemble(feat.standardise(t.scored, ["predicted", "confidence"]), ["predicted", "confidence"])
    return parts(feat.mark_stratified(frame.select("row_id", "label", "features", "predicted", "confidence"), "row_id", 0.75, ["label"]))


@query("m12_classifiers")
def _(t):
    train, test = _classes(t)
    return mod.compare_models(train, test, {
        "forest": mod.classifier("forest", numTrees=100), "tree": mod.classifier("tree"), "bayes": mod.classifier("bayes"),
        "svm": mod.classifier("svm")}, task="classification")


@query("m12_nearest_neighbours", """
WITH z AS (SELECT row_id, label, (predicted - AVG(predicted) OVER ()) / stddev_pop(predicted) OVER () AS x,
    (confidence - AVG(confidence) OVER ()) / stddev_pop(confidence) OVER () AS y FROM {scored}),
d AS (SELECT t.row_id, r.label, pow(t.x - r.x, 2) + pow(t.y - r.y, 2) AS d FROM (SELECT * FROM z WHERE row_id % 8 = 0) t, (SELECT * FROM z WHERE row_id % 8 <> 0) r),
near AS (SELECT row_id, label FROM d QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY d, label) <= 5)
SELECT row_id, CASE WHEN SUM(label) >= 3 THEN 1.0E0 ELSE 0.0E0 END AS prediction FROM near GROUP BY row_id""")
def _(t):
    frame = feat.standardise(t.scored.select("row_id", "label", "predicted", "confidence"), ["predicted", "confidence"])
    train, test = frame.where("row_id % 8 <> 0"), frame.where("row_id % 8 = 0")
    return neighbours.knn_classify(train, test, ["predicted", "confidence"], "label", "row_id")


@query("m13_grid_search")
def _(t):
    train = materialise(vectors(t).withColumnRenamed("features", "measures"), "search")
    found = mod.grid_search(train, regression.default_grids(train), folds=5)
    return found.scores.select("model", "parameters", F.round("mean_metric", 2).alias("mean_metric")).withColumn(
        "best_model", F.lit(found.best_name))


def _fold_terms_sql():
    """F-scores of the measures and their products, scaled and scored on the rows outside each fold."""
    names = ["Length1", "Height", "Width"]
    scaled = ", ".join(f"({c} - AVG({c}) OVER w) / stddev_samp({c}) OVER w AS x{i}" for i, c in enumerate(names))
    terms = {"0": "x0", "1": "x1", "2": "x2", "0,1": "x0 * x1", "0,2": "x0 * x2", "1,2": "x1 * x2"}
    scores = " UNION ALL ".join(f"SELECT fold, '{t}' AS term, pow(corr({x}, Weight), 2) AS r FROM z GROUP BY fold" for t, x in terms.items())
    return f"""
WITH z AS (SELECT f.fold, Weight, {scaled} FROM {{fish}}, (SELECT unnest([0, 1, 2]) AS fold) f WHERE row_id % 3 <> f.fold AND Height IS NOT NULL WINDOW w AS (PARTITION BY f.fold)),
s AS ({scores})
SELECT CAST(fold AS BIGINT) AS fold, term FROM s QUALIFY row_number() OVER (PARTITION BY fold ORDER BY r DESC, term) <= 3"""


@query("m13_terms_per_fold", _fold_terms_sql())
def _(t):
    # the stages that a search fits anew in every fold, on the rows outside of it
    stored = materialise(feat.assemble(t.fish.where("Height IS NOT NULL"), ["Length1", "Height", "Width"], "measures").select(
        "row_id", "measures", F.col("Weight").alias("label")), "folds")
    plain = mod.linear("linear")
    pipeline, grid = regression.searched(plain, [{}], 3, degrees=(2,), ks=(3,))
    rows = []
    for fold in range(3):
        fitted = pipeline.copy(grid[0]).fit(stored.where(F.col("row_id") % 3 != fold))
        rows += [(fold, term) for term in fitted.stages[1].getOrDefault("terms")]
    return t.spark.createDataFrame(rows, "fold int, term string")


@query("m14_cv_scores")
def _(t):
    mean, std = mod.cv_scores(materialise(vectors(t), "folds"), mod.linear("linear"))
    return t.spark.range(1).select(F.lit(mean).alias("mean_r2"), F.lit(std).alias("std_r2"))


@query("m16_feature_importance")
def _(t):
    fitted = mod.fit(mod.forest(), vectors(t))
    return mod.feature_importance(fitted, SIZES, t.spark)


@query("t05_rank_coefficients")
def _(t):
    return mod.rank_coefficients(mod.linear("linear").fit(vectors(t)), SIZES, t.spark)


@query("m17_score")
def _(t):
    frame = sized(t).select("row_id", *SIZES, F.col("Weight").alias("label"))
    stages = mod.fit_stages(frame, [VectorAssembler(inputCols=SIZES, outputCol="features"), mod.linear("linear")])
    path = scratch_path(t.spark, "model")
    mod.save_model(stages, path)  # scored by the stored model, as a later job would
    scored = mod.score(frame, mod.load_model(path), 0.97, "linear", "2024-02-01 00:00:00")
    return scored.select("row_id", "predicted_weight", "confidence_score", "model_used", "prediction_id", "timestamp")


def _sensors(t):
    return ops.valid_readings(t.readings).select("id", "station_id", "timestamp", "temperature", "humidity")


@query("m18_forecast_direct")
def _(t):
    readings = _sensors(t)
    features = fc.direct_features(readings, "station_id", "timestamp", "id")
    model = fc.train_sensor_model(features, fc.DIRECT_FEATURES, "timestamp", "id")
    return fc.forecast_direct(readings, model, "station_id", "timestamp", "id")


@query("m19_forecast_recursive")
def _(t):
    readings = _sensors(t)
    features = fc.recursive_features(readings, "station_id", "timestamp", "id")
    model = fc.train_sensor_model(features, fc.RECURSIVE_FEATURES, "timestamp", "id")
    return fc.forecast_recursive(readings, model, "station_id", "timestamp", "id", days=2)


@query("m20_trainable", """
SELECT station_id, COUNT(*) AS rows, COUNT(*) FILTER (WHERE temperature BETWEEN -50 AND 60) AS valid_rows,
  COUNT(*) >= 50 AND COUNT(*) FILTER (WHERE temperature BETWEEN -50 AND 60) >= 30 AS trainable FROM {readings} GROUP BY station_id""")
def _(t):
    return mod.trainable(t.readings, "station_id", F.col("temperature").between(-50, 60))


@query("m21_text_model")
def _(t):
    train, test = parts(feat.mark_stratified(t.labelled.select("doc_id", "text", "label"), "doc_id", 0.8, ["label"]))
    scored = mod.score_text(mod.text_model(train), test)
    accuracy = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy").evaluate(scored)
    return st.classification_metrics(scored, "label", "prediction", "confidence").withColumn("check", F.lit(accuracy))


@query("m22_residuals", """
SELECT row_id, species, ROUND(actual - predicted, 4) + 0.0 AS residual, ROUND(abs(actual - predicted), 4) AS abs_error,
  CAST(greatest(1, least(5, ceil((actual - lo) / w))) AS BIGINT) AS bin
FROM {scored}, (SELECT MIN(actual) AS lo, (MAX(actual) - MIN(actual)) / 5 AS w FROM {scored})""")
def _(t):
    return st.residual_frame(t.scored, "actual", "predicted", "species").select(
        "row_id", "species", "residual", "abs_error", "bin")


@query("m23_tool_training_set", """
SELECT id, row_number() OVER (ORDER BY id) <= floor(0.8 * COUNT(*) OVER ()) AS is_train,
  position('find ' || kind IN 'find ' || kind) = 1 AS has_query
FROM (SELECT event_id AS id, event_type AS kind FROM events WHERE event_id % 17 <> 0 AND event_id % 13 <> 0)""")
def _(t):
    texts = prep.tool_training_set(t.calls.withColumn("order_id", F.col("id")), "order_id", "id")
    return texts.select("id", "is_train", F.contains("text", F.concat(F.lit("User Query: "), "query")).alias("has_query"))


@query("m24_fill_answers", """
SELECT id, CASE WHEN id % 17 = 0 OR id % 13 = 0 OR id % 3 = 0 OR id % 11 = 0 THEN '[]'
  ELSE '[{"name": "' || CASE WHEN id % 7 <> 0 AND id % 5 = 0 THEN 'other' ELSE kind END || '", "arguments": '
    || CASE WHEN id % 7 = 0 THEN '{}' ELSE replace(props, ' ', '') END || '}]' END AS my_answers
FROM (SELECT event_id AS id, event_type AS kind, props FROM events)""")
def _(t):
    calls = t.calls
    answers = prep.answer_calls(calls.where("id % 3 <> 0"), "id", "predicted")
    return prep.fill_answers(calls, answers, "id").select("id", "my_answers")


@query("d27_encode_tokens", """
WITH words AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS token FROM documents),
vocabulary AS (SELECT token, row_number() OVER (ORDER BY COUNT(*) DESC, token) + 1 AS token_id FROM words GROUP BY token
  ORDER BY COUNT(*) DESC, token LIMIT 30000),
cut AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')[1:128]) AS token FROM documents)
SELECT d.doc_id, COALESCE(SUM(COALESCE(token_id, 1)) FILTER (WHERE c.token IS NOT NULL), 0)::BIGINT AS id_sum, COUNT(c.token) AS used,
  CAST(128 AS BIGINT) AS width
FROM documents d LEFT JOIN cut c ON c.doc_id = d.doc_id LEFT JOIN vocabulary v ON v.token = c.token GROUP BY d.doc_id""")
def _(t):
    documents = t.documents.select("doc_id", "text")
    vocabulary = prep.fit_vocabulary(documents, "text", 30000)
    encoded = prep.encode_tokens(documents, "doc_id", "text", vocabulary, 128)

    def total(name):
        return F.aggregate(name, F.lit(0).cast("bigint"), lambda a, x: a + x)

    return encoded.select("doc_id", total("input_ids").alias("id_sum"), total("attention_mask").alias("used"),
                          F.size("input_ids").alias("width"))
