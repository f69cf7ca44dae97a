"""Stage registered files: check headers, cast, score, write, count, and update the registry.

Files of one layout (same delimiter, header line and declared columns) are read and written together, so the number of jobs
follows the number of layouts, not of files. Each file becomes one partition of its stage table, and a repeated run
replaces that partition. Nothing is shuffled on the way from a file to its partition.

A run writes to a folder of its own below the target, which readers of the target do not see. Parquet's writer counts the rows and puts
their number at the end of each file it writes; the counts by landed file are taken from there. Then the declared gates are asked: the share of bad rows that an object
allows, and the validation of a source. Files that pass replace their partitions; of the others nothing is left, and they stay registered.
"""

from __future__ import annotations

import csv
import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidegate.functions.rules import find_roles
from tidegate.functions.text import blank_to_null, stage_table_name
from tidegate.meta import Meta
from tidegate.operators.changes import fill_update
from tidegate.operators.declared import over_threshold
from tidegate.operators.models import LinearScore, score_customers
from tidegate.operators.register import REGISTERED
from tidegate.operators.sources import source_attributes
from tidegate.operators.validate import validate
from tidegate.plans.skew import salted_join
from tidegate.session import qualified, remove_folder, use_here, written
from tidegate.sources.delimited import BAD_RECORD, LINE, FeedColumn, feed_options, read_delimited, read_fixed_width, typed_select
from tidegate.sources.folders import partition_name, replace_folders
from tidegate.sources.headers import first_lines

LAYOUTS_AT_ONCE = 4
COMPLETED = "COMPLETED"
ERROR = "ERROR"
SCORE = "real_customer_score"
RECORD_ID = "record_id"
RUNS = "_run-"  # folders that readers of the target leave out

# Texts of the option defaults that the loader fills in.
OPTION_DEFAULTS = {
    "schema_name": "STG",
    "file_format": "DELIM",
    "compression_str": "NONE",
    "error_on_column_count_mismatch": "FALSE",
    "on_error": "continue",
    "date_format": "AUTO",
    "time_format": "AUTO",
    "timestamp_format": "AUTO",
    "null_if": "'\"\"','',' '",
}


def registered_files(meta: Meta) -> DataFrame:
    return meta.data_file.filter(F.col("file_status") == REGISTERED)


def normalise_options(attributes: DataFrame) -> DataFrame:
    """Fill in the reader options of source attributes; "none", "n/a" and blanks count as not set."""
    have = set(attributes.columns)
    out: dict[str, Column] = {}
    for name, default in OPTION_DEFAULTS.items():
        if name in have:
            out[name] = F.coalesce(blank_to_null(F.col(name)), F.lit(default))
    if "file_format" in have:
        out["file_format"] = F.upper(F.trim(F.left(out["file_format"], F.lit(5))))
    for name in ("escape_char", "escape_unenclosed_field", "trim_space", "file_encoding"):
        if name in have:
            out[name] = blank_to_null(F.col(name))
    if "split_filename_pattern" in have:
        pattern = blank_to_null(F.col("split_filename_pattern"))
        out["split_filename_pattern"] = F.when(F.lower(pattern) != ".gz", pattern)
    if "header_row_count" in have:
        out["header_row_count"] = F.coalesce("header_row_count", F.lit(0))
    if "add_record_id_ind" in have:
        out["add_record_id_ind"] = F.coalesce("add_record_id_ind", F.lit("N"))
    if "landing_directory" in have:
        out["landing_directory"] = F.regexp_replace("landing_directory", "(?<=.)/$", "")
    if {"filename", "compression_str"} <= have:
        zipped = (F.lower("compression_str") == "gzip") & ~F.lower("filename").endswith(".gz")
        out["stage_filename"] = F.when(zipped, F.concat("filename", F.lit(".gz"))).otherwise(F.col("filename"))
    return attributes.withColumns(out)


def reject_reasons(files: DataFrame) -> DataFrame:
    """Add the first reason why a file cannot be loaded, or NULL."""
    # Messages for missing metadata.
    checks = [
        (F.col("file_id").isNull(), "filename does not exist in DATA_FILE."),
        (F.col("object_id").isNull(), "There is no Source in DATA_OBJECT that matches the filename_pattern."),
        (F.col("batch_id").isNull(), "This file is not registered in an active Batch."),
        (
            F.col("target_object_id").isNull(),
            "This Source has a target defined in target_object_name that has no TARGET record.",
        ),
        (F.coalesce("stage_name", F.lit("")) == "", "This Source does not have a stage_name populated."),
    ]
    first, *rest = checks
    case = reduce(lambda c, check: c.when(*check), rest, F.when(*first))
    return files.withColumn("reject_reason", case)


def files_with_attributes(meta: Meta, files: DataFrame) -> DataFrame:
    """Registry rows with what is declared for their source; files without a source keep NULLs."""
    attributes = source_attributes(meta)
    wanted = [
        "source_id",
        "stage_name",
        "column_delimiter",
        "text_qualifier",
        "file_format",
        "header_row_count",
        "escape_char",
        "escape_unenclosed_field",
        "null_if",
        "trim_space",
        "file_encoding",
        "date_format",
        "time_format",
        "timestamp_format",
        "row_delimiter",
        "footer_row_count",
        "error_on_column_count_mismatch",
        "on_error",
        "add_record_id_ind",
    ]
    target = F.col("target_id") if "target_id" in attributes.columns else F.lit(None).cast("long")
    have = set(attributes.columns)
    side = attributes.select(
        *[(F.col(c) if c in have else F.lit(None).cast("string")).alias(c) for c in wanted], target.alias("target_object_id")
    )
    lookup = side.withColumn("_owner", F.col("source_id"))
    rows = files.select("file_id", "object_id", "batch_id", "filename", "file_path").withColumn("_owner", F.col("object_id"))
    return salted_join(rows, lookup, ["_owner"], ["file_id"], "left").drop("_owner")


def header_names(header: Column, delimiter: Column, qualifier: Column | str = '"') -> Column:
    """Lower-case column names of a header line; a delimiter between two qualifiers does not count."""
    given = qualifier if isinstance(qualifier, Column) else F.lit(qualifier)
    mark = F.concat(F.lit(r"\Q"), F.coalesce(blank_to_null(given), F.lit('"')), F.lit(r"\E"))
    other = F.concat(F.lit("(?:(?!"), mark, F.lit(").)*"))
    outside = F.concat(F.lit(r"\Q"), delimiter, F.lit(r"\E(?=(?:"), other, mark, other, mark, F.lit(")*"), other, F.lit("$)"))
    ends = F.concat(F.lit("^"), mark, F.lit("|"), mark, F.lit("$"))
    return F.transform(F.split(header, outside), lambda c: F.lower(F.regexp_replace(c, ends, F.lit(""))))


HEADER_KEY = ["source_id", "column_delimiter", "text_qualifier", "header"]


def check_headers(layouts: DataFrame, feed: DataFrame) -> DataFrame:
    """Compare each distinct (source_id, column_delimiter, text_qualifier, header) with the declared columns.

    Order and case do not matter. Names are compared by a full join, so no column list has to fit into one row.
    """
    key = HEADER_KEY
    mark = F.col("text_qualifier") if "text_qualifier" in layouts.columns else F.lit('"')
    distinct = layouts.withColumn("text_qualifier", F.coalesce(blank_to_null(mark), F.lit('"'))).select(*key).distinct()
    names = header_names(F.col("header"), F.col("column_delimiter"), F.col("text_qualifier"))
    found = distinct.select(*key, F.explode(names).alias("name")).groupBy(*key, "name").agg(F.count("*").alias("copies"))
    declared = feed.select("source_id", F.lower("column_name").alias("name")).distinct()
    expected = distinct.join(declared, "source_id").withColumn("expected", F.lit(True))
    both = found.join(expected, [*key, "name"], "full")
    return both.groupBy(*key).agg(
        F.count_if(F.col("copies").isNull()).alias("missing_columns"),
        F.count_if(F.col("expected").isNull()).alias("extra_columns"),
        F.count_if(F.col("copies") > 1).alias("repeated_columns"),
    ).withColumn(
        "header_ok",
        (F.col("missing_columns") == 0) & (F.col("extra_columns") == 0) & (F.col("repeated_columns") == 0),
    )


@dataclass
class Layout:
    """Everything needed to plan one read: options, header order and declared columns."""

    attributes: dict[str, object]
    header: list[str]
    columns: list[FeedColumn]


def _spec(feed: DataFrame) -> DataFrame:
    """Declared columns of each source as one sorted array; a source declares as many columns as its file has."""
    column = F.struct(
        "ordinal_position",
        "column_id",
        F.lower("column_name").alias("name"),
        F.lower("data_type").alias("data_type"),
        "max_length",
        "scale",
        F.col("fixed_width_start_position").alias("start"),
        F.col("fixed_width_length").alias("length"),
    )
    listed = feed.groupBy("source_id").agg(F.array_sort(F.collect_list(column)).alias("_columns"))
    return listed.select(
        "source_id",
        F.transform(
            "_columns",
            lambda c: F.struct(c["name"], c["data_type"], c["max_length"], c["scale"], c["start"], c["length"]),
        ).alias("spec"),
    )


_LAYOUT_COLUMNS = [
    "column_delimiter",
    "text_qualifier",
    "file_format",
    "header_row_count",
    "escape_char",
    "escape_unenclosed_field",
    "null_if",
    "trim_space",
    "file_encoding",
    "date_format",
    "time_format",
    "timestamp_format",
    "row_delimiter",
    "footer_row_count",
    "error_on_column_count_mismatch",
    "on_error",
    "add_record_id_ind",
]


def plan_stage(meta: Meta, landing_root: str, full_options: bool = False, strict: bool = False) -> DataFrame:
    """One row per registered file: its path, header, verdict and layout.

    ``landing_root`` is the folder that ``/Files`` stands for. With ``full_options`` the declared reader options apply, without
    it only the delimiter does. ``strict`` also rejects files with incomplete metadata.
    """
    files = files_with_attributes(meta, registered_files(meta))
    if full_options:
        files = normalise_options(files)
    else:
        plain = {c: F.lit(None).cast(files.schema[c].dataType) for c in _LAYOUT_COLUMNS if c != "column_delimiter"}
        plain["header_row_count"] = F.lit(1).cast("long")
        plain["text_qualifier"] = F.lit('"')
        files = files.withColumns(plain).withColumn("column_delimiter", F.when(F.col("column_delimiter") != "", F.col("column_delimiter")).otherwise(","))
    files = reject_reasons(files) if strict else files.withColumn("reject_reason", F.lit(None).cast("string"))
    files = files.withColumn(
        "reject_reason",
        F.coalesce("reject_reason", F.when(F.col("source_id").isNull(), F.lit("No source attributes found."))),
    )
    below = F.regexp_replace("file_path", "^/Files", "")
    path = F.concat(F.lit(qualified(files.sparkSession, landing_root)), below, F.lit("/"), F.col("filename"))
    files = files.withColumns({"path": path, "stage_table_name": stage_table_name(F.col("stage_name"), F.col("file_id"))})
    return files


def header_report(files: DataFrame, feed: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """Files with their header line, and the verdict on each distinct header. Every file is opened once."""
    headed = written(first_lines(files, root), "headers")
    return headed, check_headers(headed, feed)


def _with_headers(files: DataFrame, feed: DataFrame, root: str) -> DataFrame:
    """Add the header line, and reject files whose header does not fit."""
    headed, verdicts = header_report(files, feed, root)
    verdicts = verdicts.withColumnRenamed("text_qualifier", "_mark")
    marked = headed.withColumn("_mark", F.coalesce(blank_to_null(F.col("text_qualifier")), F.lit('"')))
    joined = salted_join(marked, verdicts, ["source_id", "column_delimiter", "_mark", "header"], ["file_id"], "left")
    mismatch = F.format_string(
        "Header mismatch: %d missing, %d extra, %d repeated column(s).", "missing_columns", "extra_columns", "repeated_columns"
    )
    reason = (
        F.when(F.col("header").isNull(), "The file cannot be read.")
        .when(F.col("header") == "", "The file is empty or has no header line.")
        .when(~F.col("header_ok"), mismatch)
    )
    return joined.withColumn("reject_reason", F.coalesce("reject_reason", reason)).select(*headed.columns)


def stage_files(
    meta: Meta,
    landing_root: str,
    out: str,
    model: LinearScore | None = None,
    full_options: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Load all registered files into ``out/stage_name=.../file_id=...`` and report one row per file.

    A file that cannot be loaded, or does not pass a gate, gets a reason and stays registered; the others are loaded all the same.
    """
    spark = meta.data_file.sparkSession
    feed = meta.source_feed_column
    planned = written(plan_stage(meta, landing_root, full_options, strict), "planned")
    usable = planned.filter("reject_reason IS NULL")
    headed = F.coalesce("header_row_count", F.lit(0)) > 0
    checked = _with_headers(usable.filter(headed), feed, landing_root)
    bare = usable.filter(~headed).withColumn("header", F.lit(None).cast("string"))
    rejected = planned.filter("reject_reason IS NOT NULL").withColumn("header", F.lit(None).cast("string"))
    every = salted_join(checked.unionByName(bare).unionByName(rejected), _spec(feed), ["source_id"], ["file_id"], "left")
    form = F.to_json(F.struct(*_LAYOUT_COLUMNS, F.lower("header").alias("header"), "spec"))
    loose = F.exists("spec", lambda c: (c["data_type"] == "decimal") & c["max_length"].isNull())
    undeclared = F.when(F.col("spec").isNull(), F.lit("No columns are declared for this source.")).when(
        loose, F.lit("A decimal column is declared without a length.")
    )
    files = written(
        every.select(
            "file_id",
            "object_id",
            "stage_name",
            "stage_table_name",
            "path",
            F.coalesce("reject_reason", undeclared).alias("reject_reason"),
            form.alias("layout"),
        ),
        "files",
    )
    failures: dict[str, str] = {}
    ready = files.filter("reject_reason IS NULL").select("path", "file_id", "stage_name", "layout")
    run = uuid.uuid4().hex
    folder = f"{qualified(spark, out)}/{RUNS}{run}"

    def load(form: str) -> list[str]:
        group = ready.filter(F.col("layout") == form).drop("layout")
        return _load(spark, group, _layout(json.loads(form)), folder, model, failures)

    with ThreadPoolExecutor(LAYOUTS_AT_ONCE, initializer=use_here, initargs=(spark,)) as pool:  # jobs of different layouts fill the cluster together
        layouts = ready.select("layout", "stage_name").distinct().collect()
        loaded = pool.map(load, sorted({r["layout"] for r in layouts}))
        parts = [part for some in loaded for part in some]
    counts = written(_counts(spark, parts), "counts")
    outcomes = _over_limits(_outcomes(spark, files, counts, failures), meta.data_object)
    outcomes = _validated(written(outcomes, "counted"), counts, meta)
    _publish(outcomes, counts, {r["stage_name"] for r in layouts}, qualified(spark, out), run)
    if parts:
        remove_folder(spark, folder)
    return outcomes


def _layout(form: dict) -> Layout:
    columns = [
        FeedColumn(c["name"], c["data_type"], c.get("max_length"), c.get("scale"), c.get("start"), c.get("length"))
        for c in form["spec"]
    ]
    names = []
    if "header" in form:
        mark = (form.get("text_qualifier") or "").strip() or '"'
        names = next(csv.reader([form["header"]], delimiter=form.get("column_delimiter") or ",", quotechar=mark))
    return Layout(form, names or [c.name for c in columns], columns)


def _read(spark: SparkSession, layout: Layout, paths: list[str]) -> DataFrame:
    options = feed_options(layout.attributes)
    numbered = layout.attributes.get("add_record_id_ind") == "Y"
    if (layout.attributes.get("file_format") or "").upper().startswith("FIXED"):
        return read_fixed_width(spark, paths, layout.columns, options, numbered)
    rows = read_delimited(spark, paths, layout.header, options, lines=numbered)
    extra = [*([BAD_RECORD] if options.keep_bad else []), *([LINE] if numbered else [])]
    return rows.select(*typed_select(rows, layout.columns, options), *extra, "_path", "_block", "_at")


def _load(
    spark: SparkSession, group: DataFrame, layout: Layout, folder: str, model: LinearScore | None, failures: dict[str, str]
) -> list[str]:
    """Read, score and write the files of one layout; if that fails, halve the list until the bad files are alone."""
    paths = sorted(r["path"] for r in group.select("path").toLocalIterator())

    def run(some: list[str]) -> list[str]:
        target = f"{folder}/{uuid.uuid4().hex}"
        try:
            return [_write(_read(spark, layout, some), group, layout, target, model)]
        except Exception as problem:
            if len(some) == 1:
                failures[some[0]] = str(problem)
                return []
            middle = len(some) // 2
            return run(some[:middle]) + run(some[middle:])

    return run(paths) if paths else []


def _write(rows: DataFrame, files: DataFrame, layout: Layout, target: str, model: LinearScore | None) -> str:
    """Attach file id and stage name by path (a small table, broadcast by its size), score and write partitions; returns the folder."""
    names = [c.name for c in layout.columns]
    owned = rows.join(files.withColumnRenamed("path", "_path"), "_path")
    keep = [*names, *([BAD_RECORD] if BAD_RECORD in rows.columns else []), "stage_name", "file_id"]
    if model is not None and find_roles(names):
        roles = {column: role for role, column in find_roles(names).items()}
        owned = score_customers(owned, model, roles)
        keep.insert(len(names), SCORE)
    if LINE in rows.columns:
        owned = owned.withColumn(RECORD_ID, F.col(LINE))
        keep = [*keep[:-2], RECORD_ID, *keep[-2:]]
    owned.select(*keep).write.partitionBy("stage_name", "file_id").parquet(target)
    return target


def _counts(spark: SparkSession, parts: list[str]) -> DataFrame:
    """``file_id, stage_name, part, row_count, error_row_count`` of what a run wrote into its folders.

    Only the ends of the written files are read, where their number of rows stands, and the bad-row column.
    """
    counted = "_corrupt_record string, stage_name string, file_id long"
    every = [spark.createDataFrame([], "file_id long, stage_name string, row_count long, error_row_count long, part string")]
    for part in parts:
        stored = spark.read.schema(counted).parquet(part)
        by_file = stored.groupBy("file_id", "stage_name").agg(F.count(F.lit(1)).alias("row_count"), F.count(BAD_RECORD).alias("error_row_count"))
        every.append(by_file.withColumn("part", F.lit(part)))
    return reduce(DataFrame.unionByName, every)


def _outcomes(spark: SparkSession, files: DataFrame, counts: DataFrame, failures: dict[str, str]) -> DataFrame:
    """One row per file of the run, with its counts or the reason why it was not loaded."""
    failed = spark.createDataFrame([(p, m) for p, m in failures.items()], "path string, _message string")
    found = counts.select("file_id", "row_count", "error_row_count")
    out_rows = files.join(found, "file_id", "left").join(failed, "path", "left")
    reason = F.coalesce("reject_reason", "_message")
    loaded = reason.isNull()
    return out_rows.select(
        "file_id",
        "object_id",
        "stage_name",
        "stage_table_name",
        "path",
        reason.alias("reject_reason"),
        F.when(loaded, F.coalesce("row_count", F.lit(0))).alias("row_count"),
        F.when(loaded, F.coalesce("error_row_count", F.lit(0))).alias("error_row_count"),
    )


def _refused(outcomes: DataFrame, reason: Column) -> DataFrame:
    """Loaded files for which there is a reason get it and lose their counts."""
    new = F.when(F.col("reject_reason").isNull(), reason)
    counts = {c: F.when(new.isNull(), F.col(c)) for c in ("row_count", "error_row_count")}
    return outcomes.withColumns({"reject_reason": F.coalesce("reject_reason", new), **counts})


def _over_limits(outcomes: DataFrame, objects: DataFrame) -> DataFrame:
    """Files with a larger share of bad rows than their object allows are not loaded."""
    if "error_row_threshold_pct" not in objects.columns:
        return outcomes
    over = over_threshold(outcomes.filter("reject_reason IS NULL"), objects).select(F.col("file_id").alias("_over"), "error_row_threshold_pct")
    text = F.format_string("%d of %d rows are bad, more than %d percent.", "error_row_count", "row_count", "error_row_threshold_pct")
    marked = outcomes.join(over, F.col("file_id") == F.col("_over"), "left")
    return _refused(marked, F.when(F.col("_over").isNotNull(), text)).select(*outcomes.columns)


def _validated(outcomes: DataFrame, counts: DataFrame, meta: Meta) -> DataFrame:
    """Files of sources whose declared validation does not pass are not loaded."""
    if "post_validation_sql" not in meta.source.columns:
        return outcomes
    loaded = outcomes.filter("reject_reason IS NULL")
    statements = meta.source.filter(F.col("post_validation_sql").isNotNull() & (F.trim("post_validation_sql") != ""))
    asked = statements.select("source_id", "post_validation_sql").join(loaded.select(F.col("object_id").alias("source_id")), "source_id", "left_semi")
    asked = asked.collect()  # one row per source that declares a validation and has files in this run
    if not asked:
        return outcomes
    spark = outcomes.sparkSession
    good = written(loaded.join(counts.select("file_id", "part"), "file_id").select("file_id", "object_id", "part"), "good")
    places = good.select("object_id", "part").distinct().collect()
    stored = {part: spark.read.parquet(part) for part in {r["part"] for r in places}}

    def rows(source_id: int) -> DataFrame | None:
        mine = [stored[r["part"]] for r in places if r["object_id"] == source_id]
        if not mine:
            return None
        every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), mine)
        return every.join(good.filter(F.col("object_id") == source_id).select("file_id"), "file_id", "left_semi")

    found = validate(spark, {r["source_id"]: r["post_validation_sql"] for r in asked}, rows)
    failed = found.filter("status <> 'PASSED'").select(F.col("source_id").alias("_source"), "message")
    marked = outcomes.join(failed, F.col("object_id") == F.col("_source"), "left")
    return written(_refused(marked, F.concat(F.lit("Validation: "), "message")).select(*outcomes.columns), "validated")


def _publish(outcomes: DataFrame, counts: DataFrame, stages: set[str], out: str, run: str) -> None:
    """Replace the partitions of loaded files by what the run wrote for them; a file without rows leaves none."""
    if not stages:
        return
    spark = outcomes.sparkSession
    names = spark.createDataFrame([(s, partition_name(spark, "stage_name", s)) for s in stages], "_name string, _stage string")
    loaded = outcomes.filter("reject_reason IS NULL").select("file_id", "stage_name")
    below = F.concat(F.col("_stage"), F.lit("/file_id="), F.col("file_id").cast("string"))
    placed = loaded.join(names, F.col("stage_name").eqNullSafe(F.col("_name"))).join(counts.select("file_id", "part"), "file_id", "left")
    replace_folders(placed.select(F.concat("part", F.lit("/"), below).alias("src"), F.concat(F.lit(f"{out}/"), below).alias("dst")), out, run)


def registry_after_load(registry: DataFrame, outcomes: DataFrame, modified: Column, status: str = COMPLETED) -> DataFrame:
    """Registry rows after the load: counts and status of loaded files, rejected ones untouched.

    The file's own counts (``fm_``) are all its rows and its errors, the stage's count is the rows that were loaded well.
    """
    good = F.col("row_count") - F.col("error_row_count")
    done = outcomes.filter("reject_reason IS NULL").select(
        "file_id",
        F.lit(status).alias("file_status"),
        "row_count",
        F.col("row_count").alias("fm_good_record_count"),
        F.col("error_row_count").alias("fm_error_record_count"),
        good.alias("stg_good_record_count"),
    )
    return fill_update(registry, done, "file_id", {"modified_date": modified})


def load_history(log: DataFrame) -> DataFrame:
    """Totals per stage table from a load log (table_name, row_count, row_parsed, status).

    The status is the highest in text order: LOADED, LOAD_FAILED, PARTIALLY_LOADED.
    """
    totals = log.groupBy("table_name").agg(
        F.sum("row_count").alias("inserted_rows"),
        F.sum("row_parsed").alias("file_rows"),
        (F.sum("row_parsed") - F.sum("row_count")).alias("error_row_count"),
        F.max("status").alias("load_status"),
    )
    failed = F.col("load_status") == "LOAD_FAILED"
    return totals.withColumns(
        {
            "file_status": F.when(failed, "Error").otherwise("Staged"),
            "process_status": F.when(failed, "Failed").otherwise("Completed"),
        }
    )


def stage_schema(columns: list[FeedColumn], scored: bool = True, record_id: bool = False) -> T.StructType:
    """Schema of a stage table from its declared columns."""
    fields = [T.StructField(c.name.lower(), c.type) for c in columns]
    if scored:
        fields.append(T.StructField(SCORE, T.FloatType()))
    if record_id:
        fields.append(T.StructField(RECORD_ID, T.LongType()))
    return T.StructType(fields)


def create_stage_table(spark: SparkSession, table: str, schema: T.StructType, provider: str = "parquet") -> None:
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING {provider}")


def read_stage(spark: SparkSession, out: str, stage_name: str | None = None) -> DataFrame:
    """Staged rows of one stage, or of all stages that share their columns."""
    if stage_name is None:
        return spark.read.parquet(out)
    return spark.read.option("basePath", out).parquet(f"{out}/stage_name={stage_name}")
