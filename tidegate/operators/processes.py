"""Process look-ups, and opening and closing entries of the process log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegate import schemas
from tidegate.meta import Meta
from tidegate.operators.changes import fill_update
from tidegate.plans.keys import matching, require_columns
from tidegate.plans.ordering import next_id, number_rows

RUNNING = "RUNNING"


def processes_by_name(meta: Meta, names: DataFrame | None = None) -> DataFrame:
    return matching(meta.process, names, "process_name", trim=True)


def process_ids(meta: Meta, names: DataFrame | None = None) -> DataFrame:
    """Lowest id per process name; ``process_count`` above 1 means the name is ambiguous."""
    found = processes_by_name(meta, names)
    return found.groupBy("process_name").agg(
        F.min("process_id").alias("process_id"), F.count("*").alias("process_count")
    )


def process_logs(meta: Meta, ids: DataFrame | None = None, ordered: bool = False) -> DataFrame:
    out = matching(meta.process_log, ids, "process_log_id")
    return out.orderBy("process_log_id") if ordered else out


def active_process_logs(meta: Meta, names: DataFrame | None = None) -> DataFrame:
    """Latest unfinished log entry per process name. Names without one keep a row with NULL."""
    latest = (
        meta.process_log.filter("end_time IS NULL")
        .groupBy("process_id")
        .agg(F.max("process_log_id").alias("process_log_id"))
    )
    return process_ids(meta, names).select("process_name", "process_id").join(latest, "process_id", "left")


def open_process_logs(meta: Meta, runs: DataFrame, started: Column) -> DataFrame:
    """New log entries for runs given as (process_name, batch_id, run order ``run``), ids following the highest one."""
    require_columns(runs, ["process_name", "batch_id", "run"], "runs")
    ids = process_ids(meta).select("process_name", "process_id")
    numbered = number_rows(
        runs.join(ids, "process_name"), [F.col("run")], "process_log_id", next_id(meta.process_log, "process_log_id")
    )
    return schemas.conform(
        numbered.select(
            "process_log_id", "process_id", "batch_id", started.alias("start_time"), F.lit(RUNNING).alias("status")
        ),
        schemas.META_SCHEMAS["process_log"],
    )


def close_process_logs(logs: DataFrame, outcomes: DataFrame, ended: Column) -> DataFrame:
    """Set end time, counts and status of the entries named in ``outcomes``; a NULL outcome keeps the old value."""
    return fill_update(logs, outcomes.withColumn("end_time", ended), "process_log_id")


def detail_rows(meta: Meta, steps: DataFrame, created: Column) -> DataFrame:
    """Rows for the detail log, one per step of a process, with ids that follow the highest one.

    ``steps`` has process_log_id, step (their order within a log entry), process_name, log_detail_message, start_time and end_time, and perhaps
    sql_query and total_row_cnt. ``elapsed_duration`` is in whole seconds; a step that has not ended has none.
    """
    require_columns(steps, ["process_log_id", "step", "process_name", "log_detail_message", "start_time", "end_time"], "steps")
    first = next_id(meta.process_log_detail, "process_log_detail_id")
    numbered = number_rows(steps, [F.col("process_log_id"), F.col("step")], "process_log_detail_id", first)
    elapsed = F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
    return schemas.conform(numbered.withColumns({"elapsed_duration": elapsed, "created_date": created}), schemas.META_SCHEMAS["process_log_detail"])


def elapsed_by_process(details: DataFrame) -> DataFrame:
    """Per process name of the detail log: steps, unfinished ones, seconds in all and at most, rows."""
    return details.groupBy("process_name").agg(
        F.count(F.lit(1)).alias("steps"),
        F.count_if(F.col("elapsed_duration").isNull()).alias("unfinished"),
        F.coalesce(F.sum("elapsed_duration"), F.lit(0)).cast("long").alias("seconds"),
        F.max("elapsed_duration").alias("longest"),
        F.coalesce(F.sum("total_row_cnt"), F.lit(0)).cast("long").alias("total_rows"),
    )
