"""Landed files made from the given tables, written once per application to the shared folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.bindings import customers, meta, table
from tidegate import Meta, schemas
from tidegate.operators.register import register_files
from tidegate.session import path_exists, scratch_path, written
from tidegate.sources.landing import list_files

_DONE: dict[tuple[str, str, str], str] = {}
SOURCES = 6  # landing directories; each scale has at least this many sources


def _once(spark: SparkSession, d: str, label: str, write) -> str:
    key = (spark.sparkContext.applicationId, d, label)
    if key not in _DONE or not path_exists(spark, _DONE[key]):
        path = scratch_path(spark, label)
        write(path)
        _DONE[key] = path
    return _DONE[key]


def customer_lines(spark, d) -> DataFrame:
    """What the files hold: the four declared columns and the number of the sending source."""
    people = customers(spark, d)
    return people.select(
        "customer_id", "email", "phone", F.col("company_name").alias("origin"), (F.col("customer_id") % SOURCES).alias("src")
    )


def landed_customers(spark, d) -> str:
    """Root of delimited files: a third with the declared header, a third reordered, a third without ``origin``."""

    layouts = [
        lambda rows: rows.select("customer_id", "email", "phone", "origin"),
        lambda rows: rows.select(F.col("phone").alias("PHONE"), "origin", F.col("email").alias("Email"), "customer_id"),
        lambda rows: rows.select("customer_id", "email", "phone"),
    ]

    def write(root):
        # One write per source: files of one write share their names across folders, and the registry goes by name.
        rows = customer_lines(spark, d)
        for n in range(SOURCES):
            part = layouts[n % 3](rows.filter(F.col("src") == n))
            part.write.option("header", True).csv(f"{root}/Files/src={n}")

    return _once(spark, d, "landing", write)


def landing_meta(spark, d) -> Meta:
    """Control tables whose first sources point at the landed files, with an empty registry."""
    m = meta(spark, d)
    number = F.col("object_id") - 1
    objects = m.data_object.withColumns(
        {
            "landing_directory": F.concat(F.lit("/Files/src="), number.cast("string")),
            "filename_pattern": F.lit("part-%.csv"),
            "object_type": F.lit("file"),
            "column_delimiter": F.lit(","),
        }
    )
    empty = spark.createDataFrame([], schemas.META_SCHEMAS["data_file"])
    return m.with_tables(data_object=objects, data_file=empty)


def registered_meta(spark, d, received) -> tuple[Meta, str]:
    """Control tables after registering the landed files, and the landing folder."""
    root = landed_customers(spark, d)
    m = landing_meta(spark, d)
    rows = register_files(m, list_files(spark, f"{root}/Files"), received)
    return m.with_tables(data_file=written(rows, "registry")), f"{root}/Files"


def text_lines(spark, d, label: str, lines: DataFrame) -> str:
    """A folder of text files with the column ``value``."""
    return _once(spark, d, label, lambda path: lines.select("value").write.text(path))


def joined(delimiter: str, *columns) -> object:
    return reduce(lambda a, b: F.concat(a, F.lit(delimiter), b), [F.coalesce(c.cast("string"), F.lit("")) for c in columns])
