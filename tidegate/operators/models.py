"""Training, keeping and applying the customer classifiers; clustering and anomaly scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions.rules import (
    FEATURES,
    HYBRID_FEATURES,
    binary_label,
    customer_score,
    display_columns,
    real_mark,
    with_flags,
    with_valid_flags,
)
from tidegate.plans.keys import require_columns

# Decision thresholds, split and seeds of the classifiers and the clustering.
SYNTHETIC_THRESHOLD = 0.3
HYBRID_THRESHOLD = 0.5
TRAIN_SHARE = 0.7
SPLIT_SEED = 42
CLUSTERS = 2
CLUSTER_SEED = 1


def split_rows(df: DataFrame, keys: Sequence[str], share: float = TRAIN_SHARE, seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: the same rows on any cluster, and copies of a row stay together.

    The hash is the first eight digits of the MD5 of the seed and the keys, joined by ``|``; a missing key counts as empty.
    """
    spelled = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    bucket = F.conv(F.left(F.md5(spelled), F.lit(8)), 16, 10).cast("long") % 10000
    cut = round(share * 10000)
    return df.filter(bucket < cut), df.filter(bucket >= cut)


def fit_classifier(
    flagged: DataFrame,
    label: str,
    features: Sequence[str] = FEATURES,
    threshold: float = SYNTHETIC_THRESHOLD,
    reg_param: float = 0.0,
    max_iter: int = 100,
) -> PipelineModel:
    """Fit a logistic regression on flag columns.

    Flags take few values, so equal rows are counted first and the count becomes their weight: the likelihood is the same,
    and every iteration runs over the few distinct rows instead of the whole table.
    """
    require_columns(flagged, [label, *features], "training rows")
    kept = flagged.groupBy(*features, F.col(label).cast("double").alias("_label")).agg(
        F.count("*").cast("double").alias("_weight")
    )
    counted = kept.persist()
    try:
        if counted.select("_label").distinct().count() < 2:
            raise ValueError("training rows need both label values")
        pipeline = Pipeline(
            stages=[
                VectorAssembler(inputCols=list(features), outputCol="features"),
                LogisticRegression(
                    featuresCol="features",
                    labelCol="_label",
                    weightCol="_weight",
                    threshold=threshold,
                    regParam=reg_param,
                    maxIter=max_iter,
                ),
            ]
        )
        return pipeline.fit(counted)
    finally:
        counted.unpersist()


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


@dataclass(frozen=True)
class LinearScore:
    """A fitted two-class linear model as plain numbers, applied as a column expression inside generated code."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    threshold: float

    @classmethod
    def of(cls, model: PipelineModel) -> "LinearScore":
        assembler, regression = model.stages[0], model.stages[-1]
        return cls(
            tuple(assembler.getInputCols()),
            tuple(float(c) for c in regression.coefficients),
            float(regression.intercept),
            float(regression.getThreshold()),
        )

    def probability(self) -> Column:
        """Probability of class 1."""
        margin = F.lit(self.intercept)
        for name, weight in zip(self.features, self.coefficients):
            margin = margin + F.col(name) * F.lit(weight)
        return 1.0 / (1.0 + F.exp(-margin))

    def apply(self, flagged: DataFrame) -> DataFrame:
        p = self.probability()
        return flagged.select("*", p.alias("probability"), F.when(p > self.threshold, 1.0).otherwise(0.0).alias("prediction"))


def as_linear(model: PipelineModel | LinearScore) -> LinearScore:
    return model if isinstance(model, LinearScore) else LinearScore.of(model)


def score_customers(
    df: DataFrame, model: PipelineModel | LinearScore, mapping: Mapping[str, str] | None = None, positive: str = "synthetic"
) -> DataFrame:
    """Add flags, their sum, the confidence that a customer is real, the Y/N mark and the 0-10 score.

    ``mapping`` goes from column to role. Columns keep their names; roles without a column count as empty text.
    """
    return rate(with_flags(df, mapping), model, positive)


def rate(flagged: DataFrame, model: PipelineModel | LinearScore, positive: str = "synthetic") -> DataFrame:
    scored = as_linear(model).apply(flagged)
    confidence = F.col("probability") if positive == "real" else 1.0 - F.col("probability")
    return scored.select("*", confidence.alias("confidence")).select(
        "*",
        real_mark(F.col("prediction"), positive).alias("is_real_customer"),
        customer_score(F.col("confidence")).alias("real_customer_score"),
    )


def with_probability_struct(scored: DataFrame) -> DataFrame:
    return scored.withColumn("real_customer_probability", F.struct("is_real_customer", "confidence"))


def train_customer_model(
    customers: DataFrame, keys: Sequence[str], mapping: Mapping[str, str] | None = None, **fit_options
) -> tuple[PipelineModel, DataFrame]:
    """Model fitted on the training share, and the scored rows of the test share. Expects a column ``label``."""
    flagged = with_flags(customers, mapping).withColumn("label", binary_label(F.col("label")))
    train, test = split_rows(flagged, keys)
    model = fit_classifier(train, "label", **fit_options)
    return model, rate(test, model)


def train_hybrid_model(
    customers: DataFrame,
    keys: Sequence[str],
    valid_names: DataFrame,
    valid_zips: DataFrame,
    mapping: Mapping[str, str] | None = None,
    **fit_options,
) -> tuple[PipelineModel, DataFrame]:
    """A model fitted on the training share with validity flags, and all rows scored; here class 1 is the real customer."""
    flagged = with_valid_flags(with_flags(customers, mapping), valid_names, valid_zips, mapping)
    flagged = flagged.withColumn("label", binary_label(F.col("label"), "real"))
    train, _ = split_rows(flagged, keys)
    model = fit_classifier(train, "label", HYBRID_FEATURES, HYBRID_THRESHOLD, **fit_options)
    return model, rate(flagged, model, "real")


def with_display_texts(scored: DataFrame) -> DataFrame:
    """Add the texts a report shows beside the numbers."""
    return scored.withColumns(display_columns(F.col("confidence")))


def assemble(df: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """A feature vector from numeric columns, or from one array column."""
    if len(inputs) == 1 and df.schema[inputs[0]].dataType.typeName() == "array":
        return df.withColumn("features", array_to_vector(F.col(inputs[0]).cast("array<double>")))
    return VectorAssembler(inputCols=list(inputs), outputCol="features").transform(df)


def fit_clusters(featured: DataFrame, k: int = CLUSTERS, seed: int = CLUSTER_SEED) -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(featured)


def squared_distance(point: Column, center: Column) -> Column:
    gaps = F.zip_with(point, center, lambda a, b: (a - b) * (a - b))
    return F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap)


def _center_array(centers: Sequence[Sequence[float]]) -> Column:
    return F.array(*[F.array(*[F.lit(float(v)) for v in center]) for center in centers])


def anomaly_scores(clustered: DataFrame, centers: Sequence[Sequence[float]], point: Column | None = None) -> DataFrame:
    """Squared distance of each row to the centre of its ``cluster``. There are only as many centres as clusters."""
    if point is None:
        point = vector_to_array(F.col("features"))
    own = F.element_at(_center_array(centers), F.col("cluster") + 1)
    return clustered.withColumn("anomaly_score", squared_distance(point, own))


def nearest_center(df: DataFrame, point: Column, centers: Sequence[Sequence[float]]) -> DataFrame:
    """Cluster number and anomaly score for given centres, without a fitted model."""
    distances = F.array(*[squared_distance(point, F.array(*[F.lit(float(v)) for v in c])) for c in centers])
    found = df.withColumn("_distances", distances)
    best = F.array_min("_distances")
    return found.select(
        *df.columns, (F.array_position("_distances", best) - 1).cast("int").alias("cluster"), best.alias("anomaly_score")
    )


def fit_usage_classifier(featured: DataFrame, label: str) -> tuple[object, DataFrame]:
    """Logistic regression on the feature vectors, applied to its own training rows."""
    rows = featured.select("features", label)
    model = LogisticRegression(featuresCol="features", labelCol=label, predictionCol="prediction").fit(rows)
    return model, model.transform(rows)


def storable(predictions: DataFrame) -> DataFrame:
    """Vectors as arrays, so that any table format can hold the result."""
    kinds = {f.name: f.dataType.typeName() for f in predictions.schema.fields}
    vectors = [n for n, k in kinds.items() if k == "vectorudt"]
    return predictions.withColumns({n: vector_to_array(F.col(n)) for n in vectors})
