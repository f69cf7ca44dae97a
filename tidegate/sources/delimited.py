"""Delimited and fixed-width files, read by declared columns and options."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidegate.functions.text import EMPTY_WORDS
from tidegate.plans.ordering import line_places
from tidegate.sources.landing import row_path

BAD_RECORD = "_corrupt_record"
LINE = "_line"

# Names that people give to the end of a line.
LINE_ENDS = {"LF": "\n", "CRLF": "\r\n", "CR": "\r", "\\N": "\n", "\\R\\N": "\r\n", "\\R": "\r"}


@dataclass(frozen=True)
class FeedColumn:
    name: str
    data_type: str
    max_length: int | None = None
    scale: int | None = None
    start: int | None = None
    length: int | None = None

    @property
    def type(self) -> T.DataType:
        """Stage type; text types lose their length and unknown types become text."""
        kind = self.data_type.lower()
        if kind == "decimal":
            return T.DecimalType(int(self.max_length), int(self.scale or 0))
        # Declared type names and the Spark types they stand for.
        known = {
            "bigint": T.LongType(),
            "long": T.LongType(),
            "int": T.IntegerType(),
            "integer": T.IntegerType(),
            "double": T.DoubleType(),
            "float": T.FloatType(),
            "boolean": T.BooleanType(),
            "date": T.DateType(),
            "timestamp": T.TimestampType(),
            "time": T.TimeType(6),
        }
        return known.get(kind, T.StringType())


@dataclass(frozen=True)
class FeedOptions:
    delimiter: str | None = ","
    quote: str | None = '"'
    escape: str | None = None
    header_rows: int = 1
    nulls: tuple[str, ...] = ()
    trim: bool = False
    encoding: str = "UTF-8"
    date_format: str | None = None
    timestamp_format: str | None = None
    time_format: str | None = None
    line_end: str | None = None
    footer_rows: int = 0
    keep_bad: bool = False
    fail_on_bad: bool = False
    pattern: str | None = None


def _text(value: object) -> str | None:
    if value is None or str(value).strip().lower() in EMPTY_WORDS:
        return None
    return str(value)


def _yes(value: object) -> bool:
    return (_text(value) or "").upper() in ("TRUE", "Y", "YES", "1")


def parse_nulls(text: str | None) -> tuple[str, ...]:
    """Texts that mean NULL, from a declared list such as ``'-','?'``; without one, no text does."""
    if _text(text) is None:
        return ()
    quoted = re.findall(r"'([^']*)'", text)
    return tuple(quoted or [part.strip() for part in text.split(",")])


def line_end(value: object) -> str | None:
    """The characters that end a line, from a name such as CRLF or the characters themselves; None for the usual ones, which readers find out."""
    text = "" if value is None else str(value)
    text = LINE_ENDS.get(text.strip().upper(), text)
    return None if text.strip(" ").lower() in EMPTY_WORDS or text in ("\n", "\r\n") else text


def feed_options(row: dict[str, object]) -> FeedOptions:
    """Reader options from one row of source attributes; hand-entered "none", "n/a" and blanks count as not set."""

    def automatic(value: object) -> str | None:
        text = _text(value)
        return None if text is None or text.upper() == "AUTO" else text

    delimiter = row.get("column_delimiter")
    return FeedOptions(
        delimiter=None if delimiter is None or delimiter.lower() in EMPTY_WORDS else delimiter,
        quote=_text(row.get("text_qualifier")),
        escape=_text(row.get("escape_char")) or _text(row.get("escape_unenclosed_field")),
        header_rows=int(row.get("header_row_count") or 0),
        nulls=parse_nulls(row.get("null_if")),
        trim=_yes(row.get("trim_space")),
        encoding=_text(row.get("file_encoding")) or "UTF-8",
        date_format=automatic(row.get("date_format")),
        timestamp_format=automatic(row.get("timestamp_format")),
        time_format=automatic(row.get("time_format")),
        line_end=line_end(row.get("row_delimiter")),
        footer_rows=int(row.get("footer_row_count") or 0),
        keep_bad=_yes(row.get("error_on_column_count_mismatch")),
        fail_on_bad=(_text(row.get("on_error")) or "continue").lower() not in ("continue", "skip_file"),
        pattern=_text(row.get("split_filename_pattern")),
    )


def typed(text: Column, column: FeedColumn, options: FeedOptions | None = None) -> Column:
    """Cast to the declared type; text that does not fit gives NULL."""
    kind = column.type
    if options and isinstance(kind, T.DateType) and options.date_format:
        return F.try_to_timestamp(text, F.lit(options.date_format)).cast(kind)
    if options and isinstance(kind, T.TimestampType) and options.timestamp_format:
        return F.try_to_timestamp(text, F.lit(options.timestamp_format))
    if isinstance(kind, T.TimeType) and options and options.time_format:
        return F.try_to_time(text, F.lit(options.time_format))
    return text if isinstance(kind, T.StringType) else text.try_cast(kind)


def origin_columns() -> dict[str, Column]:
    """Where a row came from: file, offset of its split, and its place in reading order."""
    return {
        "_path": row_path(),
        "_block": F.col("_metadata.file_block_start"),
        "_at": F.monotonically_increasing_id(),
    }


def _clean(text: Column, options: FeedOptions) -> Column:
    out = F.trim(text) if options.trim else text
    return F.when(~out.isin(list(options.nulls)), out) if options.nulls else out


def read_delimited(
    spark: SparkSession, paths: Sequence[str], names: Sequence[str], options: FeedOptions, schema: T.StructType | None = None,
    lines: bool = False,
) -> DataFrame:
    """Text columns in file order, then where each row came from, and with ``lines`` its number in the file.

    With ``keep_bad`` there is also the raw line of rows with too many or too few fields, else NULL. ``schema`` lets the
    reader type the columns itself, so that text of a wrong type makes a row bad as well.
    """
    fields = list(schema.fields) if schema else [T.StructField(n, T.StringType()) for n in names]
    if options.delimiter is None and len(fields) > 1:
        raise ValueError("several columns need a delimiter")
    bad = [T.StructField(BAD_RECORD, T.StringType())] if options.keep_bad else []
    reader = (
        spark.read.schema(T.StructType(fields + bad))
        .option("header", options.header_rows == 1)
        .option("sep", options.delimiter or "\u0001")
        .option("quote", options.quote or "\u0000")
        .option("encoding", options.encoding)
        .option("mode", "FAILFAST" if options.fail_on_bad else "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_RECORD)
        .option("enforceSchema", True)
    )
    if options.escape:
        reader = reader.option("escape", options.escape)
    if options.pattern:
        reader = reader.option("pathGlobFilter", options.pattern)
    if options.line_end and len(options.line_end) <= 2:
        reader = reader.option("lineSep", options.line_end)
    if options.line_end and len(options.line_end) > 2:  # Spark's CSV reader takes no longer ends, its text reader does
        rows = _parsed_lines(spark, paths, T.StructType(fields + bad), options)
    else:
        rows = reader.csv(list(paths))
    columns = [
        (_clean(F.col(f.name), options) if isinstance(f.dataType, T.StringType) else F.col(f.name)).alias(f.name)
        for f in fields
    ]
    out = rows.select(*columns, *[b.name for b in bad], *[c.alias(n) for n, c in origin_columns().items()])
    return body_lines(out, options, options.header_rows == 1 and not (options.line_end and len(options.line_end) > 2), lines)


def _parsed_lines(spark: SparkSession, paths: Sequence[str], schema: T.StructType, options: FeedOptions) -> DataFrame:
    """Lines with an end of any length, parsed one by one; header lines are still there."""
    reader = spark.read.option("lineSep", options.line_end)
    if options.pattern:
        reader = reader.option("pathGlobFilter", options.pattern)
    lines = reader.text(list(paths))
    settings = {"sep": options.delimiter or "\u0001", "quote": options.quote or "\u0000", "columnNameOfCorruptRecord": BAD_RECORD}
    settings["mode"] = "FAILFAST" if options.fail_on_bad else "PERMISSIVE"
    if options.escape:
        settings["escape"] = options.escape
    parsed = lines.select("_metadata", F.from_csv("value", schema.simpleString(), settings).alias("_row"))
    return parsed.select("_metadata", *[F.col("_row")[f.name].alias(f.name) for f in schema.fields])


def body_lines(rows: DataFrame, options: FeedOptions, headed: bool, lines: bool) -> DataFrame:
    """Rows without the header and footer lines of their file; ``headed`` if the reader has dropped the header already.

    With ``lines`` they also get their number among what is left, from 1, in ``LINE``. A file may have several splits: the place
    of a line, from either end, follows from the counts of the splits.
    """
    header = 0 if headed else options.header_rows
    if not (header or options.footer_rows or lines):
        return rows
    placed = line_places(rows, "_path", "_block", "_at", LINE, "_lines")
    body = placed.filter((F.col(LINE) > header) & (F.col(LINE) <= F.col("_lines") - options.footer_rows))
    return body.select(*rows.columns, *([(F.col(LINE) - header).alias(LINE)] if lines else []))


def read_labelled_customers(spark: SparkSession, path: str) -> DataFrame:
    """Training rows from CSV with a header, columns in any order. Everything but the label is text, so that leading zeros
    of phone numbers and ZIP codes survive.
    """
    text = spark.read.option("header", True).csv(path)
    names = {c.lower(): c for c in text.columns}
    if "label" not in names:
        raise ValueError("training rows need a column named label")
    return text.select(
        *[(F.col(c).try_cast("int") if n == "label" else F.col(c)).alias(n) for n, c in names.items()]
    )


def cut_fixed_width(line: Column, columns: Sequence[FeedColumn], options: FeedOptions | None = None) -> list[Column]:
    """Typed columns from a line by start (from 1) and length, without outer blanks."""
    opts = options or FeedOptions()
    return [typed(_clean(F.trim(F.substring(line, c.start, c.length)), opts), c, opts).alias(c.name) for c in columns]


def read_fixed_width(
    spark: SparkSession, paths: Sequence[str], columns: Sequence[FeedColumn], options: FeedOptions | None = None, lines: bool = False
) -> DataFrame:
    opts = options or FeedOptions(header_rows=0)
    reader = spark.read.option("lineSep", opts.line_end) if opts.line_end else spark.read
    rows = reader.text(list(paths)).select("value", *[c.alias(n) for n, c in origin_columns().items()])
    rows = body_lines(rows, opts, False, lines)
    extra = [LINE] if lines else []
    return rows.select(*cut_fixed_width(F.col("value"), columns, opts), "_path", "_block", "_at", *extra)


def typed_select(rows: DataFrame, columns: Sequence[FeedColumn], options: FeedOptions | None = None) -> list[Column]:
    """The declared columns, cast and in declared order, for one select."""
    return [typed(F.col(c.name), c, options).alias(c.name) for c in columns]


def split_bad(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the raw line, and bad ones with it."""
    good = rows.filter(F.col(BAD_RECORD).isNull()).drop(BAD_RECORD)
    bad = rows.filter(F.col(BAD_RECORD).isNotNull()).select(BAD_RECORD, "_path", "_block", "_at")
    return good, bad
