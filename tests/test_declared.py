"""Extensions on declared targets."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidegate.operators import declared
from tidegate.sources.delimited import FeedColumn


def test_latest_rows(spark, rows):
    df = spark.createDataFrame([(1, "a", 3, 1), (1, "b", 3, 2), (None, "c", 1, 1), (None, "d", None, 9), (2, "e", None, None)], "k int, v string, f int, r int")
    assert rows(declared.latest_rows(df, ["k"], "f desc, r desc"), "v") == [("b",), ("c",), ("e",)]
    assert rows(declared.latest_rows(df, ["k"], "f desc, r"), "v") == [("a",), ("c",), ("e",)]
    assert declared.latest_rows(df, ["k"], "f desc").columns == df.columns


def test_retained_rows(spark, rows):
    df = spark.createDataFrame([(1, datetime(2020, 1, 31)), (2, datetime(2020, 3, 1)), (3, None)], "k int, t timestamp")
    assert rows(declared.retained_rows(df, "t", 1, "months", datetime(2020, 3, 29)), "k") == [(2,), (3,)]
    with pytest.raises(ValueError):
        declared.retained_rows(df, "t", 1, "parsec", datetime(2020, 3, 29))


def test_lengths(spark, rows):
    df = spark.createDataFrame([("abc", None, 12345)], "a string, b string, n int")
    columns = [FeedColumn("a", "VARCHAR", 2), FeedColumn("b", "VARCHAR", 1), FeedColumn("n", "INT", 2)]
    assert df.select(declared.too_long(columns).alias("x")).first()["x"] == ["a"]
    assert rows(declared.truncated(df, columns)) == [("ab", None, 12345)]
    assert df.select(declared.too_long([]).alias("x")).first()["x"] == []


def test_threshold_and_source(spark, rows):
    outcomes = spark.createDataFrame([(1, 1, 100, 5), (2, 1, 100, 6), (3, 2, 10, 10), (4, 1, None, None)], "file_id int, object_id int, row_count int, error_row_count int")
    objects = spark.createDataFrame([(1, 5), (2, None)], "object_id int, error_row_threshold_pct int")
    assert rows(declared.over_threshold(outcomes, objects), "file_id") == [(2,)]
    df = spark.createDataFrame([(1, "x", 9), (1, "y", 1), (2, "z", 3), (2, "z", 2)], "k int, s string, id int")
    ranks = spark.createDataFrame([("x", 1), ("y", 2)], "s string, rank int")
    assert rows(declared.best_source(df, ["k"], "s", ranks, "id")) == [(1, "x", 9), (2, "z", 2)]


def test_override_pull_extract(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert rows(declared.overridden(df, {"v": "coalesce(v, 'none')"})) == [(1, "a"), (2, "none")]
    with pytest.raises(ValueError):
        declared.overridden(df, {"q": "1"})
    assert declared.pulled_since(df, "k", None).count() == 2
    config = {"location": str(tmp_path), "file_name": "out", "format_type": "JSON", "overwrite": "FALSE"}
    path = declared.extract(df, config, datetime(2020, 1, 1))
    assert rows(spark.read.schema("k int, v string").json(path)) == [(1, "a"), (2, None)]
    with pytest.raises(Exception, match="already exists"):
        declared.extract(df.withColumn("v", F.lit("z")), config, datetime(2020, 1, 1))
