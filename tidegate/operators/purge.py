"""Purges that the control tables declare: which files are due, by age or by count, and their removal."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.functions.text import blank_to_null
from tidegate.meta import Meta
from tidegate.operators.changes import fill_update
from tidegate.operators.declared import declared_order
from tidegate.plans.skew import salted_join
from tidegate.session import qualified, written
from tidegate.sources.folders import partition_name, remove_folders

AGE, COUNT = "AGE", "COUNT"
PURGED = "PURGED"
HELD = ("COMPLETED", "STAGED")  # files whose rows are in a stage table
UNITS = ("DAY", "WEEK", "MONTH", "YEAR")


def newest_rows(rows: DataFrame, key: list[str], order_by: str, count: int) -> DataFrame:
    """The first ``count`` rows per key in the declared order. Each task passes on as many rows of a key at most, however hot it is."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*declared_order(order_by)))
    return rows.withColumn("_place", place).filter(F.col("_place") <= int(count)).drop("_place")


def _oldest(now: datetime.datetime, length: Column, unit: Column) -> Column:
    """The time before which an age has passed; NULL for a unit that is unknown."""
    kind = F.regexp_replace(F.upper(F.trim(unit)), "S$", "")
    case = None
    for name in UNITS:
        since = F.lit(now) - F.make_interval(**{f"{name.lower()}s": length.cast("int")})
        case = F.when(kind == name, since) if case is None else case.when(kind == name, since)
    return case


def files_due(meta: Meta, now: datetime.datetime) -> DataFrame:
    """Registry rows of staged files that their source's declaration no longer keeps.

    By age, files received before ``purge_max_length`` units of ``purge_max_length_type``; by count, all but the ``purge_max_length`` newest ones,
    by time of receipt and then file id. Files without a time of receipt are the oldest by count and never due by age.

    For the count, the oldest file that stays is found for each source: no task passes on more files of a source than the largest declared
    count, so a source with most of all files is no single task's work. Then every file is compared with its source's.
    """
    kind = F.upper(F.trim(blank_to_null(F.col("purge_type"))))
    rules = meta.source.select(F.col("source_id").alias("_owner"), kind.alias("_kind"), F.col("purge_max_length").alias("_n"), F.col("purge_max_length_type").alias("_unit"))
    rules = written(rules.filter(F.col("_kind").isin(AGE, COUNT) & (F.col("_n") >= 0)), "purges")
    held = meta.data_file.filter(F.upper("file_status").isin(*HELD)).withColumn("_owner", F.col("object_id"))
    columns = meta.data_file.columns
    aged = rules.filter(F.col("_kind") == AGE).withColumn("_oldest", _oldest(now, F.col("_n"), F.col("_unit"))).select("_owner", "_oldest")
    by_age = salted_join(held, aged, ["_owner"], ["file_id"]).filter(F.col("file_received_date") < F.col("_oldest"))
    counted = rules.filter(F.col("_kind") == COUNT).select("_owner", "_n")
    most = counted.agg(F.max("_n")).first()[0]
    if most is None:
        return by_age.select(*columns)
    age = F.struct(F.col("file_received_date"), F.col("file_id"))
    mine = salted_join(held, counted, ["_owner"], ["file_id"]).select(*columns, "_owner", "_n", age.alias("_age"))
    place = F.row_number().over(Window.partitionBy("_owner").orderBy(F.desc("_age")))
    newest = mine.select("_owner", "_n", "_age", place.alias("_place")).filter(F.col("_place") <= int(most))
    last = newest.filter("_place = _n").select("_owner", F.col("_age").alias("_edge"))
    by_count = salted_join(mine, written(last, "edges"), ["_owner"], ["file_id"]).filter(F.col("_age") < F.col("_edge"))
    none_stays = mine.filter("_n = 0")
    return by_age.select(*columns).unionByName(by_count.select(*columns)).unionByName(none_stays.select(*columns))


def purge_files(meta: Meta, out: str, now: datetime.datetime) -> DataFrame:
    """Remove the stage partitions of all files that are due, and return the registry in which they are purged.

    Whole partitions go, nothing is rewritten. A run that is repeated after it was lost removes what is left.
    """
    due = written(files_due(meta, now).select("file_id", "object_id"), "due")
    spark = due.sparkSession
    root = qualified(spark, out)
    staged = meta.source.select(F.col("source_id").alias("object_id"), "stage_name")
    placed = written(salted_join(due, staged, ["object_id"], ["file_id"]), "placed")
    stages = [r["stage_name"] for r in placed.select("stage_name").distinct().collect() if r["stage_name"]]
    if stages:
        names = spark.createDataFrame([(s, partition_name(spark, "stage_name", s)) for s in stages], "stage_name string, _stage string")
        folder = F.concat(F.lit(f"{root}/"), F.col("_stage"), F.lit("/file_id="), F.col("file_id").cast("string"))
        remove_folders(written(placed.join(names, "stage_name").select(folder.alias("dst")), "purge"), root)
    changes = due.select("file_id", F.lit(PURGED).alias("file_status"))
    return fill_update(meta.data_file, changes, "file_id", {"modified_date": F.lit(now)})
