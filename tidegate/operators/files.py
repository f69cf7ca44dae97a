"""File registry look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegate.functions.text import is_set, stage_table_name
from tidegate.meta import Meta
from tidegate.operators.batches import STARTED, current_batches
from tidegate.plans.keys import beside, matching
from tidegate.plans.patterns import like_join
from tidegate.plans.skew import salted_join, thinned

# Source codes of the customer-recognition output, by type.
KB_OUTPUT = "KB_Match_Output"
EE_OVERLAY_OUTPUT = "crcdi_ee_overlay_output"
EE_CLIENT_OUTPUT = "crcdi_ee_client_output"
SUPPRESSION_BATCH = "suppression_batch"


def files_by_id(meta: Meta, ids: DataFrame | None = None) -> DataFrame:
    """Registry rows by file_id, one row per file whatever the state of its batch."""
    return matching(meta.data_file, ids, "file_id")


def files_by_name(meta: Meta, filenames: DataFrame | None = None, ordered: bool = False) -> DataFrame:
    out = matching(meta.data_file, filenames, "filename", trim=True)
    return out.orderBy("file_id") if ordered else out


def file_ids(meta: Meta, filenames: DataFrame | None = None) -> DataFrame:
    """Lowest id per file name; ``file_count`` above 1 means the name was registered more than once."""
    return (
        files_by_name(meta, filenames)
        .groupBy("filename")
        .agg(F.min("file_id").alias("file_id"), F.count("*").alias("file_count"))
    )


def file_names(meta: Meta, ids: DataFrame | None = None) -> DataFrame:
    return files_by_id(meta, ids).select("file_id", "filename")


def files_in_batch(meta: Meta, keys: DataFrame | None = None) -> DataFrame:
    """Registry rows by (batch_id, file_id)."""
    return matching(meta.data_file, keys, "batch_id", "file_id")


def file_attributes(meta: Meta, ids: DataFrame | None = None) -> DataFrame:
    """How to read each file: path, layout and expected rows, with missing counts as 0."""
    f, o = files_by_id(meta, ids), meta.data_object
    return f.join(o, f.object_id == o.object_id).select(
        f.file_id,
        f.file_path,
        F.coalesce(f.expected_row_count, F.lit(0)).alias("expected_row_count"),
        o.column_delimiter,
        o.row_delimiter,
        F.coalesce(o.header_row_count, F.lit(0)).alias("header_row_count"),
        F.coalesce(o.field_count, F.lit(0)).alias("field_count"),
        f.filename,
        o.object_id,
        o.object_name,
        o.file_format,
        o.schema_name,
        o.landing_directory,
    )


def file_attributes_by_name(meta: Meta, filenames: DataFrame | None = None) -> DataFrame:
    """As ``file_attributes`` for the lowest id of each file name."""
    return file_attributes(meta, file_ids(meta, filenames).select("file_id"))


def unknown_files(meta: Meta, filenames: DataFrame) -> DataFrame:
    """Requested file names that have no id."""
    wanted = filenames.select(F.trim("filename").alias("filename")).distinct()
    return wanted.join(thinned(meta.data_file.select("filename")), "filename", "left_anti").withColumn("error", F.lit("No file id for this file name"))


def _open_batch_files(meta: Meta, statuses: list[str], keys: DataFrame | None) -> DataFrame:
    files = meta.data_file.filter(F.upper("file_status").isin(statuses))
    open_batches = meta.batch.filter(F.col("batch_status") == STARTED).select("batch_id", "batch_name")
    return matching(files.join(open_batches, "batch_id"), keys, "batch_name", "object_id")


def staged_batch_files(meta: Meta, keys: DataFrame | None = None) -> DataFrame:
    """Staged files of started batches. Key: batch_name, object_id."""
    return _open_batch_files(meta, ["STAGED"], keys)


def pending_batch_files(meta: Meta, keys: DataFrame | None = None) -> DataFrame:
    """Staged or registered files of started batches, newest first. Key: batch_name, object_id."""
    return _open_batch_files(meta, ["STAGED", "REGISTERED"], keys).orderBy(F.desc("file_id"))


def last_batch_files(meta: Meta, keys: DataFrame | None = None) -> DataFrame:
    """The newest staged or registered file per (batch_name, object_id) of started batches.

    An aggregate, not a window: a busy source is reduced before the shuffle.
    """
    files = _open_batch_files(meta, ["STAGED", "REGISTERED"], keys)
    rest = [c for c in files.columns if c not in ("batch_name", "object_id", "file_id")]
    newest = files.groupBy("batch_name", "object_id").agg(
        F.max("file_id").alias("file_id"), F.max_by(F.struct(*rest), "file_id").alias("_row")
    )
    return newest.select("batch_name", "object_id", "file_id", "_row.*")


def objects_for_files(meta: Meta, filenames: DataFrame) -> DataFrame:
    """Data objects whose ``filename_pattern`` (SQL wildcards) a file name matches, with the source code."""
    known = meta.data_object.join(
        meta.source.select(F.col("source_id").alias("object_id"), "source_code"), "object_id"
    )
    names = filenames.select("filename").distinct()
    return like_join(names, "filename", known, "filename_pattern")


def stage_table_names(meta: Meta, ids: DataFrame | None = None) -> DataFrame:
    """One stage table label per file; of several labels the last in text order."""
    files = files_by_id(meta, ids).select("file_id", F.col("object_id").alias("source_id"))
    stages = meta.source.select("source_id", "stage_name")
    named = files.join(stages, "source_id")
    return named.groupBy("file_id").agg(F.max(stage_table_name(F.col("stage_name"), F.col("file_id"))).alias("table_name"))


def party_files(meta: Meta, cr_type: str | None = "KB", names: DataFrame | None = None) -> DataFrame:
    """Customer-recognition output files in the current batch of each batch name."""
    current = current_batches(meta, names)
    if cr_type == "EE":
        code = F.when(F.col("batch_name") == SUPPRESSION_BATCH, EE_OVERLAY_OUTPUT).otherwise(EE_CLIENT_OUTPUT)
    else:
        code = F.lit(KB_OUTPUT)
    codes = [EE_OVERLAY_OUTPUT, EE_CLIENT_OUTPUT] if cr_type == "EE" else [KB_OUTPUT]
    outputs = meta.source.filter(F.col("source_code").isin(codes)).select(F.col("source_id").alias("object_id"), "source_code")
    files = meta.data_file.select("file_id", "batch_id", "object_id").join(current, "batch_id")
    return files.join(outputs, "object_id").filter(F.col("source_code") == code).select(
        "batch_name", "source_code", "file_id", "batch_id"
    )


def purgeable_files(meta: Meta) -> DataFrame:
    """Files of sources that have a purge rule, with source and object columns."""
    files = meta.data_file
    purged = meta.source.filter(is_set(F.col("purge_type")))
    described = beside(purged, meta.data_object, "object_", {"source_id": "object_id"})
    named = [F.col(c).alias(f"source_{c}" if c in files.columns else c) for c in described.columns]
    lookup = described.select(F.col("source_id").alias("_owner"), *named)
    owned = salted_join(files.withColumn("_owner", F.col("object_id")), lookup, ["_owner"], ["file_id"])
    return owned.drop("_owner")
