"""Listing landed files, and comparing their paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def list_files(spark: SparkSession, directories: str | Sequence[str]) -> DataFrame:
    """Path, size and time of all files below the directories. File contents are not read."""
    paths = [directories] if isinstance(directories, str) else list(directories)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return files.select("path", "length", "modificationTime")


def plain_path(path: Column) -> Column:
    """One spelling per path: no percent escapes, one slash after the scheme of local files."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def row_path() -> Column:
    """Path of the file a row was read from, spelled as in a listing."""
    return plain_path(F.col("_metadata.file_path"))
