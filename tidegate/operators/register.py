"""Open batches and register newly landed files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate import schemas
from tidegate.functions.text import base_name, landing_directory
from tidegate.meta import Meta
from tidegate.operators.batches import STARTED, current_batch_id
from tidegate.operators.sources import file_objects
from tidegate.plans.keys import require_columns
from tidegate.plans.ordering import next_id, number_rows
from tidegate.plans.patterns import glob_join
from tidegate.plans.sieve import likely
from tidegate.plans.skew import salted_join, thinned
from tidegate.plans.turns import turn
from tidegate.session import written

REGISTERED = "REGISTERED"
SYSTEM_USER = "system"


def open_batch(
    meta: Meta, name: str, started: datetime, batch_type: str = "ETL", description: str | None = None, message: str = ""
) -> DataFrame:
    """The row of a new started batch, with the next free id."""
    if not name:
        raise ValueError("batch name is required")
    spark = meta.batch.sparkSession
    row = spark.range(1).select(
        next_id(meta.batch, "batch_id").alias("batch_id"),
        F.lit(name).alias("batch_name"),
        F.lit(description or name).alias("batch_description"),
        F.lit(batch_type).alias("batch_type"),
        F.lit(STARTED).alias("batch_status"),
        F.lit(message).alias("status_message"),
        F.lit(started).alias("start_time"),
        F.lit(started).alias("created_date"),
        F.lit(SYSTEM_USER).alias("created_by"),
    )
    return schemas.conform(row, schemas.META_SCHEMAS["batch"])


def landed_files(listing: DataFrame, root: str = "/Files") -> DataFrame:
    """File name and directory below the landing root of each listed path."""
    require_columns(listing, ["path"], "listing")
    return listing.select("path", base_name(F.col("path")).alias("filename"), landing_directory(F.col("path"), root).alias("directory"))


def match_objects(files: DataFrame, objects: DataFrame) -> DataFrame:
    """The object of each file: its landing directory holds the file at any depth and its pattern fits the name.

    Objects are found for the distinct directories first, then files meet only the patterns of their own directory. If
    several objects fit, the one with the lowest id takes the file name, as if objects were scanned one after another.
    """
    known = objects.withColumn("_home", F.regexp_replace("landing_directory", "(?<=.)/+$", ""))
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    homes = files.select("directory").distinct().select("directory", F.explode(above).alias("_home"))
    local = homes.join(known, "_home").select("directory", "object_id", "filename_pattern")
    fits = glob_join(files, "filename", local, "filename_pattern", on=["directory"], catalog=known)
    claims = fits.groupBy("filename").agg(F.min("object_id").alias("_first"), F.max("object_id").alias("_last"))
    contested = claims.filter("_first < _last").select("filename", "_first")
    judged = salted_join(fits, contested, ["filename"], ["path"], "left")
    return judged.filter("_first IS NULL OR object_id = _first").drop("_first")


def new_files(meta: Meta, listing: DataFrame, root: str = "/Files") -> DataFrame:
    """Landed files that fit an object and whose name is not in the registry yet."""
    # The registry is the large side: of its names only those that can be in the listing are shuffled.
    landed = written(landed_files(listing, root), "landed")
    known = thinned(likely(meta.data_file.select("filename"), "filename", landed.select("filename")))
    unknown = landed.join(known.hint("merge"), "filename", "left_anti")
    # New files are few beside the registry and are needed several times below: compare with the registry once.
    return match_objects(written(unknown, "unknown"), file_objects(meta))


def repeated_names(files: DataFrame) -> DataFrame:
    """Names that arrive more than once in one run; each copy is registered, later runs would ignore them."""
    return files.groupBy("filename").agg(F.count("*").alias("copies")).filter("copies > 1")


def register_files(
    meta: Meta,
    listing: DataFrame,
    received: datetime,
    batch_id: int | Column | None = None,
    batch_name: str | None = None,
    root: str = "/Files",
) -> DataFrame:
    """Registry rows for all new files, to append in one write. Ids go up in (object, path) order."""
    batch = current_batch_id(meta, batch_name) if batch_id is None else batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    files = new_files(meta, listing, root).select("object_id", "path", "filename", "directory")
    numbered = number_rows(
        files, [F.col("object_id"), F.col("path")], "file_id", next_id(meta.data_file, "file_id")
    )
    rows = numbered.select(
        "file_id",
        "object_id",
        F.lit(received).alias("file_received_date"),
        F.lit(REGISTERED).alias("file_status"),
        "filename",
        F.col("directory").alias("file_path"),
        batch.alias("batch_id"),
        F.lit(received).alias("created_date"),
        F.lit(SYSTEM_USER).alias("created_by"),
        F.lit(received).alias("modified_date"),
        F.lit(SYSTEM_USER).alias("modified_by"),
    )
    return schemas.conform(rows, schemas.META_SCHEMAS["data_file"])


def receive(meta: Meta, listing: DataFrame, batch_name: str, received: datetime, root: str = "/Files") -> DataFrame:
    """One receiving run: refuses to start without an active batch of that name."""
    if meta.batch.filter((F.col("batch_name") == batch_name) & F.col("end_time").isNull()).isEmpty():
        raise ValueError(f"no active batch named {batch_name!r}")
    return register_files(meta, listing, received, batch_name=batch_name, root=root)


def _clashes(table: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """Values of a column of ``rows``, which should be written, that the table has.

    Of the table only what can be among the rows is shuffled, and nothing of it is broadcast: Spark takes one column of a
    compressed file for much smaller than it is in the driver's memory.
    """
    new = rows.select(column)
    held = thinned(likely(table.select(column), column, new))
    return new.join(held.hint("merge"), column, "left_semi")


def _unknown(table: DataFrame, rows: DataFrame, *columns: str) -> None:
    """Refuse rows whose value in one of the columns the table has, or that share it among themselves."""
    for column in columns:
        if not _clashes(table, rows, column).isEmpty():
            raise RuntimeError(f"{column} of a new row is in the table already")
    if rows.select(columns[0]).distinct().count() < rows.count():
        raise RuntimeError(f"new rows share a {columns[0]}")


def append_received(spark: SparkSession, folder: str, listing: DataFrame, batch_name: str, received: datetime, root: str = "/Files") -> DataFrame:
    """A whole receiving run on control tables in ``folder``: its rows, after they were appended to the registry.

    Runs take turns from reading the registry to the append, so two of them at once neither share an id nor register a file twice.
    """
    with turn(spark, folder, "data_file"):
        meta = Meta.from_folder(spark, folder)
        rows = written(receive(meta, listing, batch_name, received, root), "received")
        _unknown(meta.data_file, rows, "file_id", "filename")
        rows.write.mode("append").parquet(f"{folder}/data_file")
    return rows


def append_batch(spark: SparkSession, folder: str, name: str, started: datetime, **details: str) -> DataFrame:
    """Open a batch in the control tables in ``folder``; runs take turns, so each gets an id of its own."""
    with turn(spark, folder, "batch"):
        meta = Meta.from_folder(spark, folder)
        row = written(open_batch(meta, name, started, **details), "batch")
        _unknown(meta.batch, row, "batch_id")
        row.write.mode("append").parquet(f"{folder}/batch")
    return row
