"""What the control tables declare about a target and no load step acts on by itself: extensions to be called on staged rows."""

from __future__ import annotations

import datetime
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from tidegate.sources.delimited import FeedColumn


def _order(text: str) -> list[tuple[str, bool]]:
    """Columns of an ``order_by_cols`` text such as ``file_id desc, record_id desc``, and whether they descend."""
    found = []
    for item in text.split(","):
        name, *way = item.split()
        found.append((name, bool(way) and way[0].lower() == "desc"))
    return found


def declared_order(text: str) -> list[Column]:
    """Sort columns of an ``order_by_cols`` text."""
    return [F.col(c).desc() if down else F.col(c).asc() for c, down in _order(text)]


def latest_rows(rows: DataFrame, natural_key: Sequence[str], order_by: str) -> DataFrame:
    """The first row per natural key in the declared order; NULL keys are a key like any other.

    One direction for all columns needs only an aggregate, which shrinks before the shuffle. Mixed directions need a window, of
    which each task passes on one row per key.
    """
    order = _order(order_by)
    ways = {down for _, down in order}
    if len(ways) > 1:
        by = Window.partitionBy(*natural_key).orderBy(*declared_order(order_by))
        return rows.withColumn("_place", F.row_number().over(by)).filter("_place = 1").drop("_place")
    pick = F.max_by if ways == {True} else F.min_by
    whole = pick(F.struct(*rows.columns), F.struct(*[F.col(c) for c, _ in order]))
    return rows.groupBy(*[F.col(k).alias(f"_key_{k}") for k in natural_key]).agg(whole.alias("_row")).select("_row.*")


def retained_rows(rows: DataFrame, column: str, length: int, unit: str, now: datetime.datetime) -> DataFrame:
    """Rows that a purge by age leaves: those not older than ``length`` units; rows without a date stay."""
    kind = unit.strip().upper().removesuffix("S")
    if kind not in ("DAY", "WEEK", "MONTH", "YEAR"):
        raise ValueError(f"unknown purge length type {unit}")
    oldest = F.lit(now) - F.expr(f"INTERVAL {int(length)} {kind}")
    return rows.filter(F.col(column).isNull() | (F.col(column).cast("timestamp") >= oldest))


def too_long(columns: Sequence[FeedColumn]) -> Column:
    """Names of the text columns whose value exceeds the declared length, as an array."""
    limited = [c for c in columns if isinstance(c.type, T.StringType) and c.max_length]
    names = [F.when(F.length(c.name) > int(c.max_length), F.lit(c.name)) for c in limited]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


def truncated(rows: DataFrame, columns: Sequence[FeedColumn]) -> DataFrame:
    """Text cut to the declared lengths."""
    limited = {c.name: int(c.max_length) for c in columns if isinstance(c.type, T.StringType) and c.max_length}
    return rows.withColumns({name: F.left(F.col(name), F.lit(n)) for name, n in limited.items()})


def over_threshold(outcomes: DataFrame, objects: DataFrame) -> DataFrame:
    """Loaded files with more bad rows than their object's ``error_row_threshold_pct`` allows; none declared allows all."""
    limits = objects.filter("error_row_threshold_pct IS NOT NULL").select("object_id", "error_row_threshold_pct")
    joined = outcomes.join(limits, "object_id")
    return joined.filter(100 * F.col("error_row_count") > F.col("error_row_threshold_pct") * F.col("row_count"))


def overridden(rows: DataFrame, expressions: Mapping[str, str]) -> DataFrame:
    """Columns replaced by their declared SQL; unknown columns are refused."""
    unknown = [c for c in expressions if c not in rows.columns]
    if unknown:
        raise ValueError(f"no column {', '.join(unknown)}")
    return rows.selectExpr(*[f"({expressions[c]}) AS `{c}`" if c in expressions else f"`{c}`" for c in rows.columns])


def pulled_since(rows: DataFrame, column: str, last_pull: datetime.datetime | None) -> DataFrame:
    """Rows changed after the last pull; all of them at the first pull."""
    return rows if last_pull is None else rows.filter(F.col(column) > F.lit(last_pull))


def extract(rows: DataFrame, config: Mapping[str, object], now: datetime.datetime) -> str:
    """Write rows as an ``extract_config`` row says and return the folder."""

    def text(name: str) -> str | None:
        value = str(config.get(name) or "").strip()
        return None if value.lower() in ("", "none", "n/a") else value

    stamp = now.strftime("_%Y%m%d%H%M%S") if (text("file_name_has_datetime_ind") or "N").upper() == "Y" else ""
    path = f"{text('location')}/{text('file_name')}{stamp}"
    kind = {"DELIM": "csv", "CSV": "csv", "JSON": "json", "PARQUET": "parquet"}[(text("format_type") or "CSV").upper()]
    writer = rows.write.mode("overwrite" if (text("overwrite") or "TRUE").upper() in ("TRUE", "Y") else "errorifexists").format(kind)
    options = {
        "sep": text("field_delimiter"), "header": text("header"), "quote": text("field_optionally_enclosed_by"),
        "escape": text("escape_character"), "compression": (text("compression_str") or "none").lower(), "nullValue": text("null_if"),
        "dateFormat": text("date_format"), "timestampFormat": text("timestamp_format"), "lineSep": text("record_delimiter"),
    }
    for name, value in options.items():
        if value is not None and not re.fullmatch("(?i)auto", value):
            writer = writer.option(name, value)
    writer.save(path)
    return path


def best_source(rows: DataFrame, natural_key: Sequence[str], source: str, ranks: DataFrame, tie: str) -> DataFrame:
    """Per natural key the row of the best ranked source (``source``, ``rank``), then the smallest ``tie``; unranked come last."""
    ranked = rows.join(ranks.select(F.col(source).alias("_source"), F.col("rank").alias("_rank")), F.col(source) == F.col("_source"), "left")
    order = F.struct(F.col("_rank").isNull(), F.col("_rank"), F.col(tie))
    best = ranked.groupBy(*[F.col(k).alias(f"_key_{k}") for k in natural_key]).agg(F.min_by(F.struct(*rows.columns), order).alias("_row"))
    return best.select("_row.*")
