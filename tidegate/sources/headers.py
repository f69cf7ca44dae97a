"""Header lines of landed files."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from tidegate.functions.text import blank_to_null
from tidegate.session import qualified, written
from tidegate.sources.delimited import LINE_ENDS
from tidegate.sources.folders import reachable
from tidegate.sources.landing import list_files, row_path


def _line_reader():
    """Reads the last header line of files, of which only the start is read. Built here so that it travels to executors by value."""

    def first_line(paths: pd.Series, encodings: pd.Series, counts: pd.Series = None, ends: pd.Series = None) -> pd.Series:
        import codecs

        from pyarrow import fs

        def read(path, encoding, count, end):
            if path is None:
                return None
            try:
                decoder = codecs.getincrementaldecoder(encoding)("replace")
                mounted = path.startswith(("/", "file:"))
                system, place = (fs.LocalFileSystem(), path.removeprefix("file:")) if mounted else fs.FileSystem.from_uri(path)
                with system.open_input_stream(place) as stream:
                    seen = ""
                    while seen.count(end) < count and (more := stream.read(65536)):
                        seen += decoder.decode(more)
            except (OSError, LookupError):
                return None
            lines = seen.removeprefix("\ufeff").split(end, count)
            return lines[count - 1].removesuffix("\r") if len(lines) >= count else ""

        n = len(paths)
        given = zip(paths, encodings, [1] * n if counts is None else counts, ["\n"] * n if ends is None else ends)
        return pd.Series([read(*row) for row in given], dtype=object)

    return F.pandas_udf(first_line, T.StringType())


def first_lines(files: DataFrame, root: str) -> DataFrame:
    """Add ``header``, the header line of each ``path`` below ``root``; NULL if a file cannot be read, empty if it is shorter.

    It is the first line, or with a column ``header_row_count`` above 1 the last header line. A column ``file_encoding`` says how to read it, UTF-8 without
    one, and ``row_delimiter`` where lines end. Where pyarrow knows the storage, executors read the start of each file and no more.
    Other storage is scanned by Spark's text reader as UTF-8, which keeps the header lines of a file before its shuffle.
    """
    spark = files.sparkSession
    own = F.col("row_delimiter") if "row_delimiter" in files.columns else F.lit(None).cast("string")
    end = F.coalesce(*[F.when(F.upper(F.trim(own)) == name, F.lit(text)) for name, text in LINE_ENDS.items()], blank_to_null(own))
    end = F.when(end.isNull() | (end == "\r\n"), "\n").otherwise(end)
    count = F.greatest(F.coalesce(F.col("header_row_count"), F.lit(1)), F.lit(1)) if "header_row_count" in files.columns else F.lit(1)
    if reachable(qualified(spark, root)):
        # A fixed number of partitions, which adaptive execution does not merge: the files are opened side by side.
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        declared = blank_to_null(F.col("file_encoding")) if "file_encoding" in files.columns else F.lit(None).cast("string")
        encoding = F.coalesce(declared, F.lit("UTF-8"))
        return files.repartition(parts, "path").withColumn("header", _line_reader()("path", encoding, count.cast("int"), end))
    wanted = files.select("path", end.alias("_end"), count.cast("int").alias("_count"))
    there = written(wanted.distinct().join(list_files(spark, root).select("path"), "path", "left_semi"), "headed")
    found = [_scanned(spark, there.filter(F.col("_end") == r["_end"]), r["_end"], r["_most"]) for r in there.groupBy("_end").agg(F.max("_count").alias("_most")).collect()]
    if not found:
        return files.withColumn("header", F.lit(None).cast("string"))
    return files.join(reduce(DataFrame.unionByName, found), "path", "left")


def _scanned(spark: SparkSession, files: DataFrame, end: str, most: int) -> DataFrame:
    """path and header of files whose lines end alike; no task keeps more than ``most`` lines of a file for the shuffle."""
    paths = [r["path"] for r in files.select("path").toLocalIterator()]
    lines = spark.read.option("lineSep", end).text(paths).filter("_metadata.file_block_start = 0")
    lines = lines.select(row_path().alias("_path"), F.monotonically_increasing_id().alias("at"), "value")
    place = F.row_number().over(Window.partitionBy("_path").orderBy("at"))
    top = lines.withColumn("_place", place).filter(F.col("_place") <= most)
    same = (F.col("_path") == F.col("path")) & (F.col("_place") == F.col("_count"))
    cleaned = F.regexp_replace("value", "^\ufeff|\r$", "")
    return files.join(top, same, "left").select("path", F.coalesce(cleaned, F.lit("")).alias("header"))
