"""Lists of valid values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_json_list(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A file holding one JSON array of texts, as a table with one column."""
    text = spark.read.text(path, wholetext=True)
    values = F.explode(F.from_json("value", "array<string>"))
    return text.select(values.alias(name)).filter(F.col(name).isNotNull()).distinct()
