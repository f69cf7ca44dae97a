"""Incremental pulls: of each source the rows that changed since its stored mark, each row once.

A pull takes the rows from the mark on up to, but not including, a given time, and that time becomes the mark. So rows at the mark are in
the next pull, and only there. The result of a pull lies in a folder named by its mark, and it counts once Spark has committed it:
result and mark are one thing, a pull that was lost leaves neither, and the next one takes its rows. Pulls of a source take turns.

Rows must have their time when they appear: one that arrives after a pull with an earlier time is not seen any more. Rows without a time
are never pulled.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.operators.validate import query_over, refusal
from tidegate.plans.turns import turn
from tidegate.session import folder_names, path_exists, qualified, remove_folder

STAMP = "%Y%m%dT%H%M%S%f"
SHOWN = "%Y-%m-%d %H:%M:%S.%f"
MARK = "pulled_until="


def _home(spark: SparkSession, out: str, source_id: int) -> str:
    return f"{qualified(spark, out)}/source_id={int(source_id)}"


def _marks(spark: SparkSession, home: str) -> dict[str, bool]:
    """The pulls of a source by mark, and whether they are committed."""
    names = [n for n in folder_names(spark, home) if n.startswith(MARK)]
    return {n.removeprefix(MARK): path_exists(spark, f"{home}/{n}/_SUCCESS") for n in names}


def stored_mark(spark: SparkSession, out: str, source_id: int, declared: str | None = None) -> datetime.datetime | None:
    """The later of the last committed pull's mark and the declared ``last_pull_date``; None before the first pull."""
    done = [datetime.datetime.strptime(m, STAMP) for m, whole in _marks(spark, _home(spark, out, source_id)).items() if whole]
    if declared and declared.strip():
        done.append(datetime.datetime.fromisoformat(declared.strip()))
    return max(done, default=None)


def pull(spark: SparkSession, config: Mapping[str, object], tables: Mapping[str, DataFrame], out: str, until: datetime.datetime) -> DataFrame | None:
    """Pull one source as its ``source_view_incremental`` row says; returns the rows pulled, None if ``until`` is not after the mark.

    ``input_sql`` is a query over the given tables, by their names; anything else is refused before it runs.
    """
    source, statement = int(config["source_id"]), str(config["input_sql"]).strip().rstrip(";")
    if why := refusal(spark, statement, set(tables)):
        raise ValueError(f"input_sql of source {source} is refused: {why}")
    home = _home(spark, out, source)
    with turn(spark, qualified(spark, out), f"pull-{source}"):
        for mark, whole in _marks(spark, home).items():
            if not whole:  # of a pull that was lost
                remove_folder(spark, f"{home}/{MARK}{mark}")
        since = stored_mark(spark, out, source, config.get("last_pull_date"))
        if since is not None and until <= since:
            return None
        changed = F.col(f"`{config['column_name']}`").cast("timestamp_ntz")
        wanted = changed < F.lit(until).cast("timestamp_ntz")
        if since is not None:
            wanted &= changed >= F.lit(since).cast("timestamp_ntz")
        folder = f"{home}/{MARK}{until.strftime(STAMP)}"
        with query_over(spark, statement, tables) as rows:
            rows.filter(wanted).write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def pulled(spark: SparkSession, out: str, source_id: int) -> DataFrame:
    """All rows of a source's committed pulls."""
    home = _home(spark, out, source_id)
    return spark.read.parquet(*[f"{home}/{MARK}{m}" for m, whole in sorted(_marks(spark, home).items()) if whole])


def advanced_marks(incremental: DataFrame, out: str) -> DataFrame:
    """``source_view_incremental`` with the mark of each source's last committed pull as ``last_pull_date``."""
    spark = incremental.sparkSession
    # One row per source with incremental pulls: control data.
    rows = incremental.select("source_id", "last_pull_date").collect()
    marks = [(r["source_id"], stored_mark(spark, out, r["source_id"], r["last_pull_date"])) for r in rows if r["source_id"] is not None]
    known = spark.createDataFrame([(s, m.strftime(SHOWN)) for s, m in marks if m], "_source long, _mark string").distinct()
    joined = incremental.join(known, F.col("source_id") == F.col("_source"), "left")
    return joined.select(*[_shown(c) for c in incremental.columns])


def _shown(column: str) -> Column:
    return F.coalesce("_mark", column).alias(column) if column == "last_pull_date" else F.col(column)
