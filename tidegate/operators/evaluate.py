"""Quality of a two-class score, from one pass over the scored rows.

Input columns: ``label`` (0/1), and ``prediction`` (0/1) or ``score`` (higher means more likely 1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidegate.plans.keys import require_columns
from tidegate.plans.ordering import running_totals


def confusion(scored: DataFrame) -> DataFrame:
    """Rows per (label, prediction)."""
    require_columns(scored, ["label", "prediction"], "scored rows")
    return scored.groupBy("label", "prediction").agg(F.count("*").alias("row_count"))


def metrics(scored: DataFrame) -> DataFrame:
    """Accuracy, and precision, recall and F1 weighted by label frequency; all from the confusion counts."""
    cells = confusion(scored)
    total = Window.partitionBy()
    classes = (
        cells.select(F.explode(F.array("label", "prediction")).alias("class"), "label", "prediction", "row_count")
        .distinct()
        .groupBy("class")
        .agg(
            F.sum(F.when(F.col("label") == F.col("class"), F.col("row_count")).otherwise(0)).alias("actual"),
            F.sum(F.when(F.col("prediction") == F.col("class"), F.col("row_count")).otherwise(0)).alias("predicted"),
            F.sum(
                F.when((F.col("label") == F.col("class")) & (F.col("prediction") == F.col("class")), F.col("row_count")).otherwise(0)
            ).alias("hit"),
        )
    )
    # At most one row per class from here on.
    precision = F.when(F.col("predicted") > 0, F.col("hit") / F.col("predicted")).otherwise(0.0)
    recall = F.when(F.col("actual") > 0, F.col("hit") / F.col("actual")).otherwise(0.0)
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    weight = F.col("actual") / F.sum("actual").over(total)
    rated = classes.select(weight.alias("w"), precision.alias("p"), recall.alias("r"), f1.alias("f"), "hit", "actual")
    return rated.agg(
        (F.sum("hit") / F.sum("actual")).alias("accuracy"),
        F.sum(F.col("w") * F.col("p")).alias("weighted_precision"),
        F.sum(F.col("w") * F.col("r")).alias("weighted_recall"),
        F.sum(F.col("w") * F.col("f")).alias("f1"),
    )


def _threshold_counts(scored: DataFrame) -> DataFrame:
    """Per distinct score, its positives and negatives, and those of all scores at least as high."""
    require_columns(scored, ["label", "score"], "scored rows")
    counts = scored.groupBy("score").agg(
        F.sum("label").cast("long").alias("pos"), F.sum(1 - F.col("label")).cast("long").alias("neg")
    )
    return running_totals(counts, [F.desc("score")], {"pos": "tp", "neg": "fp"})


def roc_points(scored: DataFrame) -> DataFrame:
    """False- and true-positive rate at each distinct score used as the threshold."""
    counts = _threshold_counts(scored)
    positives, negatives = counts.agg(F.max("tp")).scalar(), counts.agg(F.max("fp")).scalar()
    return counts.select("score", "tp", "fp", (F.col("fp") / negatives).alias("fpr"), (F.col("tp") / positives).alias("tpr"))


def area_under_roc(scored: DataFrame) -> DataFrame:
    """Trapezoid area; each step needs only its own counts and its running total."""
    step = F.col("neg") * (2 * F.col("tp") - F.col("pos"))
    out = _threshold_counts(scored).agg(F.sum(step).alias("twice"), F.max("tp").alias("p"), F.max("fp").alias("n"))
    return out.select((F.col("twice") / (2 * F.col("p") * F.col("n"))).alias("area_under_roc"))
