import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.bindings import customers
from tidegate import schemas
from tidegate.functions import rules
from tidegate.operators import evaluate, models

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def flagged(spark):
    people = customers(spark, SMALL)
    noisy = F.when(F.pmod(F.xxhash64("customer_id"), F.lit(7)) == 0, 1 - F.col("label")).otherwise(F.col("label"))
    return rules.with_flags(people.withColumn("label", noisy)).persist()


@pytest.fixture(scope="module")
def model(flagged):
    return models.fit_classifier(flagged, "label", reg_param=0.01)


def test_counted_rows_give_the_same_model(flagged, model):
    rows = VectorAssembler(inputCols=rules.FEATURES, outputCol="features").transform(flagged)
    plain = LogisticRegression(featuresCol="features", labelCol="label", regParam=0.01, standardization=False, threshold=0.3).fit(rows)
    counted = models.fit_classifier(flagged, "label", reg_param=0.0)
    full = LogisticRegression(featuresCol="features", labelCol="label", regParam=0.0).fit(rows)
    a = models.LinearScore.of(counted).apply(flagged).select("customer_id", F.col("probability").alias("a"))
    b = full.transform(rows).select("customer_id", vector_to_array("probability")[1].alias("b"))
    assert a.join(b, "customer_id").agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0] < 1e-3
    assert plain.numFeatures == len(rules.FEATURES)


def test_expression_equals_transform(flagged, model):
    mine = models.LinearScore.of(model).apply(flagged).select("customer_id", F.col("probability").alias("p"), F.col("prediction").alias("y"))
    theirs = model.transform(flagged.drop("label")).select("customer_id", vector_to_array("probability")[1].alias("q"), "prediction")
    both = mine.join(theirs, "customer_id")
    assert both.count() == flagged.count()
    assert both.filter((F.abs(F.col("p") - F.col("q")) > 1e-9) | (F.col("y") != F.col("prediction"))).count() == 0


def test_scores(flagged, model):
    out = models.rate(flagged, model)
    assert out.filter("confidence < 0 OR confidence > 1 OR confidence IS NULL").count() == 0
    assert out.filter(F.col("real_customer_score") != F.round(F.col("confidence") * 10, 1).cast("float")).count() == 0
    assert out.filter((F.col("is_real_customer") == "Y") != (F.col("prediction") == 0)).count() == 0
    real = models.rate(flagged, model, "real")
    assert real.filter(F.col("confidence") != F.col("probability")).count() == 0
    assert "is_real_customer" in models.with_probability_struct(out).schema["real_customer_probability"].dataType.names


def test_saved_model_scores_alike(spark, flagged, model, tmp_path):
    models.save_model(model, str(tmp_path / "m"))
    again = models.load_model(str(tmp_path / "m"))
    assert models.LinearScore.of(again) == models.LinearScore.of(model)


def test_columns_keep_their_names(spark, model):
    df = spark.createDataFrame([(1, "a@test.com", "911")], "id int, Email string, phone_number string")
    out = models.score_customers(df, model)
    assert out.columns[:3] == ["id", "Email", "phone_number"]
    assert (out.first()["email_flag"], out.first()["phone_flag"]) == (1, 1)


def test_single_label_is_refused(flagged):
    with pytest.raises(ValueError):
        models.fit_classifier(flagged.withColumn("label", F.lit(1)), "label")


def test_split_is_repeatable(spark, flagged):
    train, test = models.split_rows(flagged, ["customer_id"])
    other, _ = models.split_rows(flagged.repartition(7), ["customer_id"])
    ids = lambda df: sorted(r[0] for r in df.select("customer_id").collect())
    assert ids(train) == ids(other) and len(ids(train)) + len(ids(test)) == flagged.count()


def test_metrics_equal_mllib(flagged, model):
    scored = models.rate(flagged, model).withColumn("score", F.col("probability")).persist()
    mine = evaluate.metrics(scored.withColumn("prediction", F.col("prediction").cast("int"))).first()
    ready = scored.withColumn("label", F.col("label").cast("double"))
    for name, metric in (("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall"), ("f1", "f1")):
        theirs = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=metric).evaluate(ready.drop("probability"))
        assert mine[name] == pytest.approx(theirs, abs=1e-9)
    theirs = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="probability", numBins=0).evaluate(ready)
    assert evaluate.area_under_roc(scored).first()[0] == pytest.approx(theirs, abs=1e-9)
    curve = evaluate.roc_points(scored).orderBy("score").collect()
    assert (curve[0]["fpr"], curve[0]["tpr"]) == (1.0, 1.0)


def test_prediction_without_actual_rows(spark):
    rows = spark.createDataFrame([(0, 0), (0, 1)], "label int, prediction int")
    out = evaluate.metrics(rows).first()
    assert (out["accuracy"], out["weighted_precision"], out["weighted_recall"]) == (0.5, 1.0, 0.5)


DEMO = [("u1", 1000, 50, 10, 0), ("u2", 5, 1, 1, 0), ("u3", 500, 30, 5, 0), ("u4", 10, 2, 1, 1), ("u5", 800, 40, 8, 0), ("u6", 3, 1, 1, 1)]


def test_clusters_and_anomaly(spark):
    df = spark.createDataFrame(DEMO, "user_id string, purchases long, diversity long, spread long, is_test_user long")
    featured = models.assemble(df, ["purchases", "diversity", "spread"])
    fitted = models.fit_clusters(featured)
    assert [list(c) for c in fitted.clusterCenters()] == [list(c) for c in models.fit_clusters(featured).clusterCenters()]
    out = models.anomaly_scores(fitted.transform(featured), fitted.clusterCenters()).collect()
    for r in out:
        gaps = [sum((a - b) ** 2 for a, b in zip(r["features"], c)) for c in fitted.clusterCenters()]
        assert r["anomaly_score"] == pytest.approx(gaps[r["cluster"]]) and r["cluster"] == gaps.index(min(gaps))


def test_usage_classifier_is_storable(spark):
    df = spark.createDataFrame(DEMO, "user_id string, purchases long, diversity long, spread long, is_test_user long")
    _, predictions = models.fit_usage_classifier(models.assemble(df, ["purchases", "diversity", "spread"]), "is_test_user")
    stored = schemas.conform(models.storable(predictions), schemas.QUALITY_RESULTS)
    assert stored.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.QUALITY_RESULTS] and all(len(r["features"]) == 3 for r in stored.collect())
