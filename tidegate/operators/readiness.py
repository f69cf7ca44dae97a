"""Which required files are late, and which are not staged."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions.dates import elapsed_units, last_due
from tidegate.meta import Meta
from tidegate.operators.batches import current_batch_id
from tidegate.plans.keys import require_columns
from tidegate.plans.skew import salted_join

REQUIRED = "required_ind = 'Y'"


def late_sources(
    meta: Meta, as_of: datetime | Column, batch_id: int | Column | None = None, skip_empty: str = "N"
) -> DataFrame:
    """Required file sources that sent fewer files in the batch than their frequency asks for.

    Expected files are the whole days, weeks, months or quarters between the latest file of an earlier batch and
    ``as_of``. ``skip_empty='Y'`` ignores files without staged rows, and then also sources that have no other file. The
    batch defaults to the highest started one. The registry is read once and reduced per source before any join.
    """
    flag = (skip_empty or "").upper()
    if flag not in ("Y", "N"):
        raise ValueError("skip_empty must be 'Y' or 'N'")
    batch = current_batch_id(meta) if batch_id is None else batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    until = as_of if isinstance(as_of, Column) else F.lit(as_of)
    files = meta.data_file.select("object_id", "file_id", "batch_id", "modified_date", "stg_good_record_count")
    if flag == "Y":
        files = files.filter(F.coalesce("stg_good_record_count", F.lit(0)) != 0)
    per_source = files.withColumn("_batch", batch).groupBy("object_id").agg(
        F.max("batch_id").alias("batch_last_receiving_file"),
        F.count(F.when(F.col("batch_id") == F.col("_batch"), F.col("file_id"))).alias("_current"),
        F.max(F.when(F.col("batch_id") < F.col("_batch"), F.col("modified_date"))).alias("_since"),
    )
    sources = meta.source.filter(
        (F.trim("receipt_frequency") != "") & F.contains(F.col("source_type"), F.lit("file"))
    ).select("source_id", "source_code", "receipt_frequency")
    objects = meta.data_object.filter(REQUIRED).select(F.col("object_id").alias("source_id"), "required_ind")
    listed = sources.join(objects, "source_id").join(
        per_source.withColumnRenamed("object_id", "source_id"), "source_id", "inner" if flag == "Y" else "left"
    )
    return listed.select(
        "source_id",
        "source_code",
        "batch_last_receiving_file",
        F.coalesce("_current", F.lit(0)).cast("long").alias("current_batch_file_count"),
        "receipt_frequency",
        elapsed_units(F.col("receipt_frequency"), F.col("_since"), until).alias("expected_number_of_files"),
        "required_ind",
    ).filter("current_batch_file_count < expected_number_of_files")


def overdue_sources(meta: Meta, as_of: datetime | Column) -> DataFrame:
    """Required file sources that have sent nothing since they were last due by ``receipt_frequency``, ``receipt_day`` and ``receipt_time``.

    One row per source: when it was due, the time of its last file (NULL if there is none) and the whole hours that it is late. The registry is read once and
    reduced per source before the join.
    """
    until = as_of if isinstance(as_of, Column) else F.lit(as_of)
    latest = meta.data_file.groupBy(F.col("object_id").alias("source_id")).agg(F.max("file_received_date").alias("last_received"))
    objects = meta.data_object.filter(REQUIRED).select(F.col("object_id").alias("source_id"))
    sources = meta.source.filter(F.contains(F.col("source_type"), F.lit("file"))).join(objects, "source_id", "left_semi")
    due = last_due(F.col("receipt_frequency"), F.col("receipt_day"), F.col("receipt_time"), until)
    listed = sources.select("source_id", "source_code", "receipt_frequency", due.alias("due")).filter("due IS NOT NULL")
    late = listed.join(latest, "source_id", "left").filter(F.col("last_received").isNull() | (F.col("last_received").cast("timestamp_ntz") < F.col("due")))
    hours = F.timestamp_diff("HOUR", F.col("due"), until.cast("timestamp_ntz"))
    return late.select("source_id", "source_code", "receipt_frequency", "due", "last_received", hours.alias("hours_late"))


def _required_sources(meta: Meta) -> DataFrame:
    required = meta.data_object.filter(REQUIRED).select(F.col("object_id").alias("source_id"), "required_ind")
    return meta.source.select("source_id", "source_code", "category").join(required, "source_id")


def _staged_sources(files: DataFrame) -> DataFrame:
    """(batch_id, source_id) pairs with staged rows."""
    return (
        files.groupBy("batch_id", F.col("object_id").alias("source_id"))
        .agg(F.sum("stg_good_record_count").alias("_good"))
        .filter("_good > 0")
        .select("batch_id", "source_id")
    )


def missing_required_files(meta: Meta, batches: DataFrame) -> DataFrame:
    """Required sources of each given batch (batch_id) that have no staged rows in it.

    A batch asks for the sources whose category is its name, so every batch adds up to one row per such source. Give the
    batches of interest; ``missing_required_counts`` covers all batches at a cost that follows the registry.
    """
    require_columns(batches, ["batch_id"], "batches")
    asked = meta.batch.join(batches.select("batch_id"), "batch_id", "left_semi").select("batch_id", "batch_name")
    files = meta.data_file.select("batch_id", "object_id", "stg_good_record_count")
    staged = _staged_sources(files.join(asked.select("batch_id"), "batch_id", "left_semi"))
    expected = asked.join(_required_sources(meta), F.col("batch_name") == F.col("category")).drop("category")
    return expected.join(staged, ["batch_id", "source_id"], "left_anti").select(
        "batch_id",
        "batch_name",
        "source_id",
        "source_code",
        "required_ind",
        F.lit(1).alias("expected_count"),
        F.lit(0).alias("existing_count"),
    )


def missing_required_counts(meta: Meta) -> DataFrame:
    """For every batch with a gap: how many required sources it asks for, has staged and misses.

    Counts per category and per batch are worked out apart, so batches and sources are never paired.
    """
    required = _required_sources(meta)
    asked = required.groupBy(F.col("category").alias("batch_name")).agg(F.count("*").alias("expected_count"))
    staged = _staged_sources(meta.data_file.select("batch_id", "object_id", "stg_good_record_count"))
    have = (
        salted_join(staged, required.select("source_id", F.col("category").alias("batch_name")), ["source_id"], ["batch_id"])
        .groupBy("batch_id", "batch_name")
        .agg(F.count("*").alias("_have"))
    )
    out = meta.batch.select("batch_id", "batch_name").join(asked, "batch_name").join(have, ["batch_id", "batch_name"], "left")
    existing = F.coalesce("_have", F.lit(0)).cast("long")
    return out.select(
        "batch_id",
        "batch_name",
        "expected_count",
        existing.alias("existing_count"),
        (F.col("expected_count") - existing).alias("missing_count"),
    ).filter("missing_count > 0")
