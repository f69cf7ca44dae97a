"""Flags, scores, metrics, models and clusters over customers, documents and embeddings."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.bindings import customers, table
from checks.registry import query
from tidegate import schemas
from tidegate.functions import rules
from tidegate.operators import evaluate, models
from tidegate.session import scratch_path, written

# The indicator texts below must equal those of ``tidegate.functions.rules``.
FLAG_SQL = """SELECT *, email_flag + phone_flag + name_flag + dob_flag + address_flag + zip_flag + company_flag AS synthetic_score
FROM (SELECT *,
  CASE WHEN regexp_matches(lower(email), '(test|admin|null|spamtrap|example|private|none|xyz)') THEN 1 ELSE 0 END AS email_flag,
  CASE WHEN phone IN ('9876543210','911','411','5550101234','0','0000000000') THEN 1 ELSE 0 END AS phone_flag,
  CASE WHEN regexp_matches(lower(first_name), '(test|demo|sample|null|placeholder|mickey|mouse)')
    OR regexp_matches(lower(last_name), '(test|demo|sample|null|placeholder|mickey|mouse)') THEN 1 ELSE 0 END AS name_flag,
  CASE WHEN date_of_birth IN ('1900-01-01','1/1/1900') THEN 1 ELSE 0 END AS dob_flag,
  CASE WHEN regexp_matches(lower(address), '(123 test st|unknown|n/a|null|fake|placeholder)') THEN 1 ELSE 0 END AS address_flag,
  CASE WHEN zip_code IN ('00000','12345','99999') THEN 1 ELSE 0 END AS zip_flag,
  CASE WHEN regexp_matches(lower(company_name), '(test|demo|sample|unknown|n/a|null)') THEN 1 ELSE 0 END AS company_flag
  FROM customers)"""

# A model with plain weights, so that both engines can work out its scores.
WEIGHTS = models.LinearScore(tuple(rules.FEATURES), (1.5, 0.75, 1.25, 1.0, 0.5, 0.5, 0.25, 0.5), -2.0, models.SYNTHETIC_THRESHOLD)
MARGIN_SQL = """(-2.0 + email_flag * 1.5 + phone_flag * 0.75 + name_flag * 1.25 + dob_flag * 1.0 + address_flag * 0.5
+ zip_flag * 0.5 + company_flag * 0.25 + synthetic_score * 0.5)"""
POINTS_SQL = f"CAST(4 * {MARGIN_SQL} AS BIGINT)"
CHANCE_SQL = f"(1.0 / (1.0 + exp(-CAST({MARGIN_SQL} AS DOUBLE))))"

_FLAGGED = {"flagged": FLAG_SQL}


@query("customers", "SELECT * FROM flagged", _FLAGGED)
def indicator_flags(spark, d):
    return rules.with_flags(customers(spark, d))


@query("customers", "SELECT synthetic_score, count(*) AS customer_count FROM flagged GROUP BY synthetic_score", _FLAGGED)
def synthetic_score(spark, d):
    flagged = rules.with_flags(customers(spark, d))
    return flagged.groupBy("synthetic_score").agg(F.count("*").alias("customer_count"))


@query(
    "customers",
    """SELECT CASE WHEN label = 0 THEN 0 ELSE 1 END AS synthetic_label, CASE WHEN label = 0 THEN 1 ELSE 0 END AS real_label,
count(*) AS customer_count FROM (SELECT CASE WHEN email IS NULL THEN NULL ELSE label END AS label FROM customers) GROUP BY 1, 2""",
)
def label_map(spark, d):
    label = F.when(F.col("email").isNotNull(), F.col("label"))
    mapped = customers(spark, d).select(
        rules.binary_label(label).alias("synthetic_label"), rules.binary_label(label, "real").alias("real_label")
    )
    return mapped.groupBy("synthetic_label", "real_label").agg(F.count("*").alias("customer_count"))


def _valid_lists(spark, d):
    names = table(spark, d, "customer").filter("c_acctbal > 5000").select(
        F.replace(F.col("c_name"), F.lit("#"), F.lit("")).alias("first_name")
    )
    zips = table(spark, d, "nation").filter("n_regionkey <= 2").select(
        F.lpad((F.col("n_nationkey") * 977).cast("string"), 5, "0").alias("zip_code")
    )
    return names, zips


@query(
    "customers",
    """SELECT *, valid_name_flag + valid_zip_flag - synthetic_score AS hybrid_score FROM (SELECT *,
  CASE WHEN first_name IN (SELECT replace(c_name,'#','') FROM customer WHERE c_acctbal > 5000) THEN 1 ELSE 0 END AS valid_name_flag,
  CASE WHEN zip_code IN (SELECT lpad(CAST(n_nationkey*977 AS VARCHAR),5,'0') FROM nation WHERE n_regionkey <= 2) THEN 1 ELSE 0 END
    AS valid_zip_flag FROM flagged)""",
    _FLAGGED,
)
def hybrid_score(spark, d):
    return rules.with_valid_flags(rules.with_flags(customers(spark, d)), *_valid_lists(spark, d))


@query(
    "customers",
    """SELECT customer_id, coalesce(first_name, '-') AS first_name, coalesce(last_name, '-') AS last_name, coalesce(email, '-') AS email,
  date_of_birth, address, zip_code, company_name, '' AS phone FROM customers""",
)
def role_mapping(spark, d):
    """Landing-file column names mapped to roles; there is no phone column, so that role is empty."""
    landed = customers(spark, d).select(
        "customer_id",
        F.col("first_name").alias("FirstName"),
        F.col("last_name").alias("last"),
        "email",
        F.col("date_of_birth").alias("dob"),
        F.col("address").alias("street_address"),
        F.col("zip_code").alias("postal"),
        F.col("company_name").alias("company"),
    )
    roles = rules.role_columns(landed.columns)
    shown = {r: F.coalesce(c, F.lit("-")) if r in ("first_name", "last_name", "email") else c for r, c in roles.items()}
    return landed.select("customer_id", *[c.alias(r) for r, c in shown.items()])


def _rated(spark, d):
    return models.rate(rules.with_flags(customers(spark, d)), WEIGHTS)


@query(
    "customers",
    f"""SELECT customer_id, round(1.0 - chance, 6) AS confidence, CASE WHEN chance > 0.3 THEN 'N' ELSE 'Y' END AS is_real_customer,
  CAST(round((1.0 - chance) * 10.0, 1) AS FLOAT) AS real_customer_score
FROM (SELECT *, {CHANCE_SQL} AS chance FROM flagged)""",
    _FLAGGED,
)
def fixed_weight_score(spark, d):
    return _rated(spark, d).select(
        "customer_id", F.round("confidence", 6).alias("confidence"), "is_real_customer", "real_customer_score"
    )


_JUDGED = {
    "flagged": FLAG_SQL,
    "judged": f"""SELECT label, CASE WHEN {CHANCE_SQL} > 0.3 THEN 1 ELSE 0 END AS prediction, {POINTS_SQL} AS score FROM flagged""",
}


def _judged(spark, d):
    margin = F.lit(WEIGHTS.intercept)
    for name, weight in zip(WEIGHTS.features, WEIGHTS.coefficients):
        margin = margin + F.col(name) * F.lit(weight)
    return _rated(spark, d).select("label", F.col("prediction").cast("int").alias("prediction"), (4 * margin).cast("long").alias("score"))


@query("customers", "SELECT label, prediction, count(*) AS row_count FROM judged GROUP BY label, prediction", _JUDGED)
def confusion(spark, d):
    return evaluate.confusion(_judged(spark, d))


@query(
    "customers",
    """SELECT round(sum(hit) / sum(actual), 9) AS accuracy, round(sum(actual * p) / sum(actual), 9) AS weighted_precision,
  round(sum(actual * r) / sum(actual), 9) AS weighted_recall,
  round(sum(actual * CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END) / sum(actual), 9) AS f1
FROM (SELECT *, CASE WHEN predicted > 0 THEN hit / predicted ELSE 0 END AS p, CASE WHEN actual > 0 THEN hit / actual ELSE 0 END AS r
  FROM (SELECT c, CAST(count(*) FILTER (label = c) AS DOUBLE) AS actual, CAST(count(*) FILTER (prediction = c) AS DOUBLE) AS predicted,
    CAST(count(*) FILTER (label = c AND prediction = c) AS DOUBLE) AS hit
    FROM judged, (VALUES (0), (1)) AS k(c) GROUP BY c))""",
    _JUDGED,
)
def metrics(spark, d):
    found = evaluate.metrics(_judged(spark, d))
    return found.select(*[F.round(c, 9).alias(c) for c in found.columns])


_CURVE = """curve AS (SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, pos, neg FROM
  (SELECT score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg FROM judged GROUP BY score)
  WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


@query(
    "customers",
    """SELECT score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(fp / (SELECT max(fp) FROM curve), 9) AS fpr,
round(tp / (SELECT max(tp) FROM curve), 9) AS tpr FROM curve""",
    {**_JUDGED, "curve": _CURVE[len("curve AS (") : -1]},
)
def roc_points(spark, d):
    return evaluate.roc_points(_judged(spark, d)).select(
        "score", "tp", "fp", F.round("fpr", 9).alias("fpr"), F.round("tpr", 9).alias("tpr")
    )


@query(
    "customers",
    """SELECT round(sum(CAST(neg AS DOUBLE) * (tp - pos / 2.0)) / (CAST(max(tp) AS DOUBLE) * max(fp)), 9) AS area_under_roc FROM curve""",
    {**_JUDGED, "curve": _CURVE[len("curve AS (") : -1]},
)
def area_under_roc(spark, d):
    return evaluate.area_under_roc(_judged(spark, d)).select(F.round("area_under_roc", 9).alias("area_under_roc"))


@query()
def lr_train_score(spark, d):
    """Fit on the training share, score all customers."""
    people = customers(spark, d)
    model, _ = models.train_customer_model(people, ["customer_id"])
    scored = models.score_customers(people, model)
    return models.with_probability_struct(scored).select(
        "customer_id", "is_real_customer", "confidence", "real_customer_score", "real_customer_probability"
    )


@query()
def lr_evaluate(spark, d):
    _, tested = models.train_customer_model(customers(spark, d), ["customer_id"])
    rows = tested.select("label", F.col("prediction").cast("int").alias("prediction"), F.col("probability").alias("score"))
    return evaluate.metrics(rows).withColumn("area_under_roc", evaluate.area_under_roc(rows).scalar())


@query()
def hybrid_train_score(spark, d):
    _, scored = models.train_hybrid_model(customers(spark, d), ["customer_id"], *_valid_lists(spark, d))
    return scored.select("customer_id", "hybrid_score", "is_real_customer", "confidence", "real_customer_score")


@query()
def model_round_trip(spark, d):
    """Save, load, and score with the loaded model; display texts beside the numbers."""
    people = customers(spark, d)
    model, _ = models.train_customer_model(people, ["customer_id"])
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    scored = models.score_customers(people, models.load_model(path))
    shown = models.with_display_texts(scored)
    return shown.select("customer_id", "is_real_customer", "confidence_text", "score_text", "real_customer_score")


def _points(spark, d):
    return table(spark, d, "embeddings").withColumn("is_test_user", F.when(F.col("label") == 0, 1).otherwise(0).cast("long"))


@query()
def kmeans_clusters(spark, d):
    featured = models.assemble(_points(spark, d), ["embedding"])
    model = models.fit_clusters(featured)
    return model.transform(featured).groupBy("cluster").agg(F.count("*").alias("row_count"))


@query()
def anomaly_score(spark, d):
    featured = models.assemble(_points(spark, d), ["embedding"])
    model = models.fit_clusters(featured)
    clustered = models.anomaly_scores(model.transform(featured), model.clusterCenters())
    return clustered.select("vec_id", "cluster", "anomaly_score")


CENTERS = [[0.0] * 64, [0.125] * 64]


@query(
    "",
    """SELECT vec_id, CASE WHEN a <= b THEN 0 ELSE 1 END AS cluster, round(least(a, b), 6) AS anomaly_score FROM (SELECT vec_id,
  list_sum([CAST(x AS DOUBLE) * CAST(x AS DOUBLE) for x in embedding]) AS a,
  list_sum([(CAST(x AS DOUBLE) - 0.125::DOUBLE) * (CAST(x AS DOUBLE) - 0.125::DOUBLE) for x in embedding]) AS b
FROM embeddings)""",
)
def fixed_center_distance(spark, d):
    points = table(spark, d, "embeddings")
    found = models.nearest_center(points, F.col("embedding").cast("array<double>"), CENTERS)
    return found.select("vec_id", "cluster", F.round("anomaly_score", 6).alias("anomaly_score"))


@query()
def test_user_classifier(spark, d):
    featured = models.assemble(_points(spark, d), ["embedding"])
    _, predictions = models.fit_usage_classifier(featured, "is_test_user")
    return predictions.groupBy("is_test_user", "prediction").agg(F.count("*").alias("row_count"))


@query()
def vector_storage(spark, d):
    """Predictions with vectors as arrays, overwritten as a table and read back."""
    featured = models.assemble(_points(spark, d), ["embedding"])
    _, predictions = models.fit_usage_classifier(featured, "is_test_user")
    path = scratch_path(spark, "quality")
    stored = schemas.conform(models.storable(predictions), schemas.QUALITY_RESULTS)
    stored.write.mode("overwrite").parquet(path)
    return spark.read.schema(schemas.QUALITY_RESULTS).parquet(path)


@query()
def toxic_text_classifier(spark, d):
    """The same classifier shape on a text-based training set: numeric features of labelled documents."""
    labelled = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    numeric = labelled.select(
        F.col("toxic").cast("long").alias("is_test_user"),
        F.log1p("n_chars").alias("size"),
        F.size(F.split("text", " ")).cast("double").alias("words"),
        F.col("quality").cast("double").alias("quality"),
    )
    _, predictions = models.fit_usage_classifier(models.assemble(numeric, ["size", "words", "quality"]), "is_test_user")
    return predictions.groupBy("is_test_user", "prediction").agg(F.count("*").alias("row_count"))


# What must hold for any fitted model: its numbers differ from run to run of the optimizer, these don't.


@query("customers", "SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS differing FROM customers")
def loaded_model_differences(spark, d):
    """Customers whose score by the saved and loaded model is another than by the fitted one."""
    people = customers(spark, d)
    model, _ = models.train_customer_model(people, ["customer_id"])
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    fitted, loaded = (models.LinearScore.of(m) for m in (model, models.load_model(path)))
    both = rules.with_flags(people).select(fitted.probability().alias("a"), loaded.probability().alias("b"))
    return both.agg(F.count("*").alias("row_count"), F.count_if(F.col("a") != F.col("b")).alias("differing"))


@query("customers", "SELECT customer_id, TRUE AS fits FROM customers")
def hybrid_scores_fit(spark, d):
    """All customers have a score that follows from their confidence, and the mark that follows from the threshold."""
    _, scored = models.train_hybrid_model(customers(spark, d), ["customer_id"], *_valid_lists(spark, d))
    mark = F.when(F.col("probability") > models.HYBRID_THRESHOLD, "Y").otherwise("N")
    fits = (F.col("is_real_customer") == mark) & F.col("confidence").between(0, 1) & (F.abs(F.col("real_customer_score") - 10 * F.col("confidence")) < 0.051)
    return scored.select("customer_id", fits.alias("fits"))


@query("", "SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS misplaced FROM embeddings")
def clusters_nearest(spark, d):
    """Rows that are not in the cluster of their nearest centre, or whose anomaly score is another than that distance."""
    featured = models.assemble(_points(spark, d), ["embedding"])
    model = models.fit_clusters(featured)
    scored = models.anomaly_scores(model.transform(featured), model.clusterCenters()).withColumnRenamed("anomaly_score", "own")
    nearest = models.nearest_center(scored.drop("cluster"), F.col("embedding").cast("array<double>"), model.clusterCenters())
    return nearest.agg(F.count("*").alias("row_count"), F.count_if(F.abs(F.col("own") - F.col("anomaly_score")) > 1e-9).alias("misplaced"))


@query("", "SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS differing FROM embeddings")
def stored_vectors_differ(spark, d):
    """Stored rows whose probabilities don't add up to 1, or whose features are no embedding of the table."""
    stored = vector_storage(spark, d)
    known = table(spark, d, "embeddings").select(F.col("embedding").cast("array<double>").alias("known")).distinct()
    odd = F.abs(F.aggregate("probability", F.lit(0.0), lambda a, x: a + x) - 1) > 1e-9
    joined = stored.join(known, F.col("features") == F.col("known"), "left")
    return joined.agg(F.count("*").alias("row_count"), F.count_if(odd | F.col("known").isNull()).alias("differing"))


@query("", "SELECT TRUE AS balanced")
def fitted_mean(spark, d):
    """Without a penalty the mean probability over the training rows equals their mean label."""
    flagged = rules.with_flags(customers(spark, d)).withColumn("label", rules.binary_label(F.col("label")))
    train, _ = models.split_rows(flagged, ["customer_id"])
    fitted = models.LinearScore.of(models.fit_classifier(train, "label"))
    gap = F.abs(F.avg(fitted.probability()) - F.avg(F.col("label").cast("double")))
    return train.agg((gap < 0.001).alias("balanced"))


_SPLIT = {"split": "SELECT *, CAST('0x' || left(md5('42|' || CAST(customer_id AS VARCHAR)), 8) AS BIGINT) % 10000 < 7000 AS training FROM customers"}


@query("customers", "SELECT customer_id, CASE WHEN training THEN 'train' ELSE 'test' END AS part FROM split", _SPLIT)
def training_split(spark, d):
    parts = models.split_rows(customers(spark, d).select("customer_id"), ["customer_id"])
    named = [rows.withColumn("part", F.lit(name)) for rows, name in zip(parts, ("train", "test"))]
    return named[0].unionByName(named[1])


@query("customers", "SELECT customer_id, CASE WHEN label = 0 THEN 0 ELSE 1 END AS label, TRUE AS fits FROM split WHERE NOT training", _SPLIT)
def held_out_rows(spark, d):
    """The rows that a trained model is tried on, and whether their mark follows from probability and threshold."""
    _, tested = models.train_customer_model(customers(spark, d), ["customer_id"])
    predicted = (F.col("probability") > models.SYNTHETIC_THRESHOLD).cast("int")
    mark = F.when(F.col("prediction") == 0, "Y").otherwise("N")
    fits = (F.col("prediction").cast("int") == predicted) & (F.col("is_real_customer") == mark) & (F.abs(F.col("confidence") + F.col("probability") - 1) < 1e-9)
    return tested.select("customer_id", "label", fits.alias("fits"))


@query(
    "customers",
    "SELECT CASE WHEN label = 0 THEN 0 ELSE 1 END AS label, count(*) AS row_count, TRUE AS within FROM split WHERE NOT training GROUP BY ALL",
    _SPLIT,
)
def evaluated_rows(spark, d):
    """What the quality of a trained model is measured on: rows per label, with accuracy and area in their ranges."""
    _, tested = models.train_customer_model(customers(spark, d), ["customer_id"])
    rows = written(tested.select("label", F.col("prediction").cast("int").alias("prediction"), F.col("probability").alias("score")), "tested")
    quality = evaluate.metrics(rows).first()
    cells = {(r["label"], r["prediction"]): r["row_count"] for r in evaluate.confusion(rows).collect()}
    right = sum(n for (label, prediction), n in cells.items() if label == prediction)
    area = evaluate.area_under_roc(rows).first()[0]
    within = abs(quality["accuracy"] - right / sum(cells.values())) < 1e-12 and 0 <= area <= 1
    return rows.groupBy("label").agg(F.count("*").alias("row_count")).withColumn("within", F.lit(within))


@query("", "SELECT TRUE AS balanced, count(*) AS row_count FROM embeddings")
def usage_classifier_balance(spark, d):
    """At the optimum of an unpenalised fit the mean probability equals the share of test users."""
    featured = models.assemble(_points(spark, d), ["embedding"])
    _, predictions = models.fit_usage_classifier(featured, "is_test_user")
    chance = vector_to_array("probability")[1]
    gap = F.abs(F.avg(chance) - F.avg(F.col("is_test_user").cast("double")))
    return predictions.agg((gap < 0.001).alias("balanced"), F.count("*").alias("row_count"))
