"""Batch look-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.meta import Meta
from tidegate.plans.keys import matching

STARTED = "STARTED"
COMPLETED = "COMPLETED"


def active_batches(meta: Meta, names: DataFrame | None = None) -> DataFrame:
    """Batches without an end time, in id order. Key: batch_name."""
    return matching(meta.batch.filter("end_time IS NULL"), names, "batch_name", trim=True).orderBy("batch_id")


def first_active_batch(meta: Meta, names: DataFrame | None = None) -> DataFrame:
    """Lowest active id per batch name; ``active_count`` above 1 means the name is ambiguous."""
    active = matching(meta.batch.filter("end_time IS NULL"), names, "batch_name", trim=True)
    return active.groupBy("batch_name").agg(F.min("batch_id").alias("batch_id"), F.count("*").alias("active_count"))


def batches_by_id(meta: Meta, ids: DataFrame | None = None) -> DataFrame:
    return matching(meta.batch, ids, "batch_id")


def batch_names(meta: Meta, ids: DataFrame | None = None) -> DataFrame:
    """Name per batch id; of several names the first in text order."""
    return batches_by_id(meta, ids).groupBy("batch_id").agg(F.min("batch_name").alias("batch_name"))


def current_batches(meta: Meta, names: DataFrame | None = None) -> DataFrame:
    """Highest started id per batch name."""
    started = matching(meta.batch.filter(F.col("batch_status") == STARTED), names, "batch_name", trim=True)
    return started.groupBy("batch_name").agg(F.max("batch_id").alias("batch_id"))


def current_batch_id(meta: Meta, name: str | None = None) -> Column:
    """Highest started id, or 0 if there is none, as a scalar subquery."""
    started = meta.batch.filter(F.col("batch_status") == STARTED)
    if name is not None:
        started = started.filter(F.col("batch_name") == name)
    return started.agg(F.coalesce(F.max("batch_id"), F.lit(0)).cast("long")).scalar()


def completed_batch_by_file(meta: Meta, filenames: DataFrame | None = None) -> DataFrame:
    """Latest completed batch that received the file, and latest one that extracted it. Key: filename.

    A file name that was both received and extracted gives two rows, also if the batch is the same.
    """
    done = meta.batch.filter(F.col("batch_status") == COMPLETED)
    received = meta.data_file.select("filename", "batch_id")
    extracted = meta.extract_data_file.select(F.col("extract_filename").alias("filename"), "batch_id")
    both = received.withColumn("direction", F.lit("IN")).unionByName(extracted.withColumn("direction", F.lit("OUT")))
    latest = (
        matching(both, filenames, "filename", trim=True)
        .join(done.select("batch_id"), "batch_id", "left_semi")
        .groupBy("filename", "direction")
        .agg(F.max("batch_id").alias("batch_id"))
    )
    return latest.join(meta.batch, "batch_id")
