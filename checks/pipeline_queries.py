"""Registering, staging and changing control tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks import landing
from checks.bindings import BINDINGS, customers, meta, table
from checks.quality_queries import CHANCE_SQL, WEIGHTS
from checks.registry import query
from tidegate import schemas
from tidegate.operators import changes, models, processes, register, sources, stage
from tidegate.plans.ordering import next_id, number_lines
from tidegate.session import scratch_path, written
from tidegate.sources import delimited
from tidegate.sources.landing import list_files

NOW = datetime(2002, 1, 30, 12, 0, 0)


def now():
    """The same time as a column that does not depend on a time zone."""
    return F.to_timestamp_ntz(F.lit("2002-01-30 12:00:00"))


def _listing(spark, d):
    """Paths of all registered files, and one new path per page; a quarter of those lies in a folder of no source."""
    m = meta(spark, d)
    old = m.data_file.select(F.concat(F.lit("/lake"), "file_path", F.lit("/"), "filename").alias("path"))
    page, number = F.col("page_id"), (F.col("page_id") % 10).cast("string")
    folder = F.when(page % 4 == 0, "/lake/Files/other/").otherwise(F.concat(F.lit("/lake/Files/src"), number, F.lit("/in/")))
    name = F.concat(F.lit("supplier_"), F.lpad(number, 9, "0"), F.lit("_p"), page.cast("string"), F.lit(".csv"))
    new = table(spark, d, "pages").select(F.concat(folder, name).alias("path"))
    return old.unionByName(new)


_NEW_FILES = {
    "listed": """SELECT *, regexp_replace(path, '^.*/', '') AS filename,
  '/Files' || regexp_replace(regexp_replace(path, '^.*?/Files', ''), '/[^/]*$', '') AS file_path FROM (
  SELECT '/lake' || file_path || '/' || filename AS path FROM data_file UNION ALL
  SELECT CASE WHEN page_id % 4 = 0 THEN '/lake/Files/other/' ELSE '/lake/Files/src' || CAST(page_id % 10 AS VARCHAR) || '/in/' END
    || 'supplier_' || lpad(CAST(page_id % 10 AS VARCHAR), 9, '0') || '_p' || CAST(page_id AS VARCHAR) || '.csv' FROM pages)""",
    "fitting": """SELECT l.*, min(o.object_id) OVER (PARTITION BY l.filename) AS first_object, o.object_id FROM listed l JOIN data_object o
  ON (l.file_path = o.landing_directory OR starts_with(l.file_path, o.landing_directory || '/'))
  AND starts_with(l.filename, replace(o.filename_pattern, '%', ''))
  WHERE o.object_type = 'file' AND l.filename NOT IN (SELECT filename FROM data_file)""",
}


@query(
    "data_file data_object batch",
    """SELECT (SELECT coalesce(max(file_id), 0) FROM data_file) + row_number() OVER (ORDER BY object_id, path) AS file_id, object_id,
  'REGISTERED' AS file_status, filename, file_path,
  (SELECT coalesce(max(batch_id), 0) FROM batch WHERE batch_status = 'STARTED' AND batch_name = '2-HIGH') AS batch_id
FROM fitting WHERE object_id = first_object""",
    _NEW_FILES,
)
def register_new_files(spark, d):
    rows = register.receive(meta(spark, d), _listing(spark, d), "2-HIGH", NOW)
    return rows.select("file_id", "object_id", "file_status", "filename", "file_path", "batch_id")


@query(
    "",
    """SELECT s AS object_id, '/Files/src=' || CAST(s - 1 AS VARCHAR) AS file_path FROM
(SELECT DISTINCT c_custkey % 6 + 1 AS s FROM customer)""",
)
def register_landed(spark, d):
    """Files found by listing the landing folder: which directory went to which object."""
    m, _ = landing.registered_meta(spark, d, NOW)
    return m.data_file.select("object_id", "file_path").distinct()


@query(
    "data_file batch",
    """SELECT (SELECT coalesce(max(batch_id), 0) + 1 FROM batch) AS next_batch_id,
(SELECT coalesce(max(file_id), 0) + 1 FROM data_file) AS next_file_id""",
)
def next_ids(spark, d):
    m = meta(spark, d)
    return spark.range(1).select(
        next_id(m.batch, "batch_id").alias("next_batch_id"), next_id(m.data_file, "file_id").alias("next_file_id")
    )


@query(
    "batch",
    """SELECT batch_id, batch_name, batch_status FROM batch UNION ALL
SELECT max(batch_id) + 1, 'daily_update', 'STARTED' FROM batch""",
)
def open_batch(spark, d):
    m = meta(spark, d)
    row = register.open_batch(m, "daily_update", NOW)
    return changes.insert_by_name(m.batch, row.select(*m.batch.columns)).select("batch_id", "batch_name", "batch_status")


_LINES = """SELECT customer_id, email, phone, company_name AS origin, customer_id % 6 AS src FROM customers"""


@query(
    "customers",
    """SELECT src + 1 AS object_id, CASE WHEN src % 3 = 2 THEN 1 ELSE 0 END AS missing_columns, 0 AS extra_columns,
CASE WHEN src % 3 = 2 THEN 'N' ELSE 'Y' END AS header_ok FROM (SELECT DISTINCT src FROM lines)""",
    {"lines": _LINES},
)
def header_check(spark, d):
    m, root = landing.registered_meta(spark, d, NOW)
    _, verdicts = stage.header_report(stage.plan_stage(m, root), m.source_feed_column, root)
    return verdicts.select(
        F.col("source_id").alias("object_id"),
        F.col("missing_columns").cast("int").alias("missing_columns"),
        F.col("extra_columns").cast("int").alias("extra_columns"),
        F.when(F.col("header_ok"), "Y").otherwise("N").alias("header_ok"),
    )


_SCORED_LINES = {
    "lines": _LINES,
    "flagged": """SELECT *, email_flag + phone_flag AS synthetic_score FROM (SELECT *, 0 AS name_flag, 0 AS dob_flag, 0 AS address_flag,
  0 AS zip_flag, 0 AS company_flag,
  CASE WHEN regexp_matches(lower(email), '(test|admin|null|spamtrap|example|private|none|xyz)') THEN 1 ELSE 0 END AS email_flag,
  CASE WHEN phone IN ('9876543210','911','411','5550101234','0','0000000000') THEN 1 ELSE 0 END AS phone_flag FROM lines)""",
}


def _staged(spark, d):
    m, root = landing.registered_meta(spark, d, NOW)
    out = scratch_path(spark, "bronze")
    return m, stage.stage_files(m, root, out, WEIGHTS), out


@query(
    "customers source",
    f"""SELECT customer_id, email, phone, origin, CAST(round((1.0 - {CHANCE_SQL}) * 10.0, 1) AS FLOAT) AS real_customer_score, s.stage_name
FROM flagged JOIN source s ON s.source_id = src + 1 WHERE src % 3 <> 2""",
    _SCORED_LINES,
)
def typed_stage(spark, d):
    _, _, out = _staged(spark, d)
    return stage.read_stage(spark, out).drop("file_id")


@query(
    "customers",
    f"""SELECT customer_id, email_flag, phone_flag, synthetic_score, round(1.0 - {CHANCE_SQL}, 6) AS confidence,
  CASE WHEN {CHANCE_SQL} > 0.3 THEN 'N' ELSE 'Y' END AS is_real_customer FROM flagged WHERE src % 3 <> 2""",
    _SCORED_LINES,
)
def score_staged(spark, d):
    """Staged rows scored afterwards, with columns named to roles and roles without a column empty."""
    m, root = landing.registered_meta(spark, d, NOW)
    out = scratch_path(spark, "bronze")
    stage.stage_files(m, root, out)
    staged = stage.read_stage(spark, out).withColumnsRenamed({"email": "mail", "phone": "contact"})
    scored = models.score_customers(staged, WEIGHTS, {"mail": "email", "contact": "phone"})
    shown = ["customer_id", "email_flag", "phone_flag", "synthetic_score", F.round("confidence", 6).alias("confidence")]
    return scored.select(*shown, "is_real_customer")


@query(
    "customers source",
    """SELECT src + 1 AS object_id, CASE WHEN src % 3 = 2 THEN 'REGISTERED' ELSE 'COMPLETED' END AS file_status,
  CASE WHEN src % 3 = 2 THEN NULL ELSE count(*) END AS row_count, CASE WHEN src % 3 = 2 THEN NULL ELSE count(*) END AS stg_good_record_count,
  CASE WHEN src % 3 = 2 THEN NULL ELSE count(*) END AS fm_good_record_count, CASE WHEN src % 3 = 2 THEN NULL ELSE 0 END AS fm_error_record_count
FROM lines GROUP BY src""",
    {"lines": _LINES},
)
def stage_counts(spark, d):
    """The registry after a load: loaded files counted and completed, files with a wrong header as before."""
    m, outcomes, _ = _staged(spark, d)
    registry = stage.registry_after_load(m.data_file, outcomes, now())
    return registry.groupBy("object_id", "file_status").agg(
        *[F.sum(c).alias(c) for c in ("row_count", "stg_good_record_count", "fm_good_record_count", "fm_error_record_count")]
    )


@query(
    "data_file",
    """SELECT file_id, CASE WHEN file_status = 'REGISTERED' THEN 'COMPLETED' ELSE file_status END AS file_status,
  CASE WHEN file_status = 'REGISTERED' THEN row_count + file_id % 5 ELSE row_count END AS row_count,
  CASE WHEN file_status = 'REGISTERED' THEN row_count ELSE stg_good_record_count END AS stg_good_record_count,
  CASE WHEN file_status = 'REGISTERED' THEN row_count + file_id % 5 ELSE fm_good_record_count END AS fm_good_record_count,
  CASE WHEN file_status = 'REGISTERED' THEN file_id % 5 ELSE fm_error_record_count END AS fm_error_record_count,
  CASE WHEN file_status = 'REGISTERED' THEN TIMESTAMP '2002-01-30 12:00:00' ELSE modified_date END AS modified_date FROM data_file""",
)
def registry_after_load(spark, d):
    m = meta(spark, d)
    bad = F.col("file_id") % 5
    outcomes = stage.registered_files(m).select(
        "file_id", F.lit(None).cast("string").alias("reject_reason"), (F.col("row_count") + bad).alias("row_count"),
        bad.alias("error_row_count"),
    )
    out = stage.registry_after_load(m.data_file, outcomes, now())
    return out.select(
        "file_id", "file_status", "row_count", "stg_good_record_count", "fm_good_record_count", "fm_error_record_count", "modified_date"
    )


_CHANGES = """SELECT l_orderkey*10+l_linenumber AS file_id, CASE WHEN max(l_linestatus) = 'F' THEN 'CHECKED' END AS file_status,
  CASE WHEN min(l_discount) > 0.05 THEN CAST(0 AS BIGINT) END AS row_count
FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey, l_linenumber"""


def _changes(spark, d):
    lines = table(spark, d, "lineitem").filter("l_returnflag = 'R'").groupBy("l_orderkey", "l_linenumber")
    return lines.agg(F.max("l_linestatus").alias("s"), F.min("l_discount").alias("x")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("file_id"),
        F.when(F.col("s") == "F", "CHECKED").alias("file_status"),
        F.when(F.col("x") > 0.05, 0).cast("long").alias("row_count"),
    )


@query(
    "data_file",
    """SELECT f.* EXCLUDE (file_status, row_count, modified_date), coalesce(c.file_status, f.file_status) AS file_status,
  coalesce(c.row_count, f.row_count) AS row_count,
  CASE WHEN c.file_id IS NULL THEN f.modified_date ELSE TIMESTAMP '2002-01-30 12:00:00' END AS modified_date
FROM data_file f LEFT JOIN changes c ON c.file_id = f.file_id""",
    {"changes": _CHANGES},
)
def partial_update(spark, d):
    return changes.fill_update(meta(spark, d).data_file, _changes(spark, d), "file_id", {"modified_date": now()})


@query("data_file", "SELECT count(*) AS updated_rows FROM data_file WHERE file_id IN (SELECT file_id FROM changes)", {"changes": _CHANGES})
def partial_update_count(spark, d):
    return changes.changed_count(meta(spark, d).data_file, _changes(spark, d), "file_id")


@query("customers", "SELECT * FROM customers WHERE (last_name = 'Null' AND first_name = 'Test') IS NOT TRUE")
def delete_where(spark, d):
    return changes.delete_where(customers(spark, d), F.expr("last_name = 'Null' AND first_name = 'Test'"))


@query(
    "customers",
    """SELECT customer_id, first_name, email, zip_code FROM customers WHERE (last_name = 'Null') IS NOT TRUE
UNION ALL SELECT 999, 'Mickey', 'jdoe@test.com', '12345' UNION ALL SELECT 1000, 'Minnie', NULL, NULL""",
)
def insert_constants(spark, d):
    kept = changes.delete_where(customers(spark, d), F.col("last_name") == "Null")
    rows = changes.constant_rows(
        kept,
        [
            {"customer_id": 999, "first_name": "Mickey", "email": "jdoe@test.com", "zip_code": "12345"},
            {"customer_id": 1000, "first_name": "Minnie"},
        ],
    )
    return changes.insert_by_name(kept, rows).select("customer_id", "first_name", "email", "zip_code")


@query("source_feed_column", "SELECT * EXCLUDE (column_name), CASE column_name WHEN 'origin' THEN 'channel' ELSE column_name END AS column_name FROM source_feed_column")
def rename_declared_column(spark, d):
    m = meta(spark, d)
    return changes.set_where(m.source_feed_column, F.col("column_name") == "origin", {"column_name": F.lit("channel")})


_COUNTED = "batch data_file data_object extract_config extract_data_file process process_log provider receiver source source_feed"
_COUNTED += " source_feed_column source_view_incremental target target_view target_view_column_override"


@query(_COUNTED, " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _COUNTED.split()))
def meta_row_counts(spark, d):
    m = meta(spark, d)
    return schemas.table_counts({name: getattr(m, name) for name in BINDINGS})


_LOG = """SELECT s.stage_name AS table_name, CAST(l.l_quantity AS BIGINT) AS row_parsed,
  CASE WHEN l.l_returnflag = 'A' THEN CAST(0 AS BIGINT) ELSE CAST(l.l_quantity AS BIGINT) END AS row_count,
  CASE WHEN l.l_suppkey % 7 = 0 AND l.l_returnflag = 'A' THEN 'LOAD_FAILED' WHEN l.l_suppkey % 5 = 0 AND l.l_returnflag = 'R'
    THEN 'PARTIALLY_LOADED' ELSE 'LOADED' END AS status
FROM lineitem l JOIN source s ON s.source_id = l.l_suppkey + 1"""


@query(
    "source",
    """SELECT table_name, CAST(sum(row_count) AS BIGINT) AS inserted_rows, CAST(sum(row_parsed) AS BIGINT) AS file_rows,
  CAST(sum(row_parsed) - sum(row_count) AS BIGINT) AS error_row_count, max(status) AS load_status,
  CASE WHEN max(status) = 'LOAD_FAILED' THEN 'Error' ELSE 'Staged' END AS file_status,
  CASE WHEN max(status) = 'LOAD_FAILED' THEN 'Failed' ELSE 'Completed' END AS process_status FROM log GROUP BY table_name""",
    {"log": _LOG},
)
def load_history(spark, d):
    lines = table(spark, d, "lineitem").withColumn("source_id", F.col("l_suppkey") + 1)
    flag, k = F.col("l_returnflag"), F.col("l_suppkey")
    rows = F.col("l_quantity").cast("long")
    log = lines.join(meta(spark, d).source.select("source_id", "stage_name"), "source_id").select(
        F.col("stage_name").alias("table_name"),
        rows.alias("row_parsed"),
        F.when(flag == "A", 0).otherwise(rows).cast("long").alias("row_count"),
        F.when((k % 7 == 0) & (flag == "A"), "LOAD_FAILED")
        .when((k % 5 == 0) & (flag == "R"), "PARTIALLY_LOADED")
        .otherwise("LOADED")
        .alias("status"),
    )
    return stage.load_history(log)


@query(
    "process process_log batch",
    """SELECT (SELECT max(process_log_id) FROM process_log) + row_number() OVER (ORDER BY b.batch_id) AS process_log_id, p.process_id,
  b.batch_id, 'RUNNING' AS status
FROM batch b JOIN process p ON p.process_name = 'view' WHERE b.batch_status = 'STARTED'""",
)
def process_log_open(spark, d):
    m = meta(spark, d)
    runs = m.batch.filter("batch_status = 'STARTED'").select(
        F.lit("view").alias("process_name"), "batch_id", F.col("batch_id").alias("run")
    )
    opened = processes.open_process_logs(m, runs, now())
    return opened.select("process_log_id", "process_id", "batch_id", "status")


@query(
    "process_log",
    """SELECT process_log_id, process_id, start_time, CASE WHEN end_time IS NULL THEN TIMESTAMP '2002-01-30 12:00:00' ELSE end_time END
  AS end_time, CASE WHEN end_time IS NULL AND process_id <> 5 THEN CAST(7 AS BIGINT) ELSE inserted_rows END AS inserted_rows,
  CASE WHEN end_time IS NULL THEN 'COMPLETED' ELSE status END AS status FROM process_log""",
)
def process_log_close(spark, d):
    logs = meta(spark, d).process_log
    outcomes = logs.filter("end_time IS NULL").select(
        "process_log_id",
        F.when(F.col("process_id") != 5, 7).cast("long").alias("inserted_rows"),
        F.lit("COMPLETED").alias("status"),
    )
    return processes.close_process_logs(logs, outcomes, now())


@query(
    "source data_object source_feed target data_file",
    """SELECT file_id, CASE WHEN batch_id IS NULL THEN 'This file is not registered in an active Batch.'
  WHEN target_id IS NULL THEN 'This Source has a target defined in target_object_name that has no TARGET record.'
  WHEN coalesce(stage_name, '') = '' THEN 'This Source does not have a stage_name populated.' END AS reject_reason
FROM (SELECT f.file_id, CASE WHEN f.file_status = 'staged' THEN NULL ELSE f.batch_id END AS batch_id, t.target_id, s.stage_name
  FROM data_file f LEFT JOIN (source s JOIN data_object o ON s.source_id = o.object_id) ON f.object_id = s.source_id
  LEFT JOIN source_feed sf ON sf.source_id = s.source_id LEFT JOIN target t ON t.target_name = sf.target_object_name)""",
)
def metadata_gate(spark, d):
    m = meta(spark, d)
    files = m.data_file.withColumn("batch_id", F.when(F.col("file_status") != "staged", F.col("batch_id")))
    return stage.reject_reasons(stage.files_with_attributes(m, files)).select("file_id", "reject_reason")


def _is_set(column: str) -> str:
    return f"CASE WHEN lower(trim({column})) IN ('', 'none', 'n/a', 'na') THEN NULL ELSE {column} END"


@query(
    "source data_object source_feed target",
    f"""SELECT s.source_id, upper(trim(left(coalesce({_is_set('file_format')}, 'DELIM'), 5))) AS file_format,
  coalesce({_is_set('schema_name')}, 'STG') AS schema_name, coalesce({_is_set('compression_str')}, 'NONE') AS compression_str,
  coalesce({_is_set('date_format')}, 'AUTO') AS date_format, coalesce({_is_set('on_error')}, 'continue') AS on_error,
  coalesce({_is_set('null_if')}, '''""'','''','' ''') AS null_if, {_is_set('trim_space')} AS trim_space,
  {_is_set('escape_char')} AS escape_char, coalesce(header_row_count, 0) AS header_row_count,
  coalesce(add_record_id_ind, 'N') AS add_record_id_ind,
  CASE WHEN lower(trim(split_filename_pattern)) IN ('', 'none', 'n/a', 'na', '.gz') THEN NULL ELSE split_filename_pattern END
    AS split_filename_pattern
FROM source s JOIN data_object o ON s.source_id = o.object_id LEFT JOIN source_feed f ON f.source_id = s.source_id""",
)
def normalised_options(spark, d):
    out = stage.normalise_options(sources.source_attributes(meta(spark, d)))
    return out.select(
        "source_id", "file_format", "schema_name", "compression_str", "date_format", "on_error", "null_if", "trim_space",
        "escape_char", "header_row_count", "add_record_id_ind", "split_filename_pattern",
    )


_PIPED = delimited.FeedOptions(delimiter="|", quote="'", header_rows=2, nulls=("N/A", "", "?"), trim=True, date_format="yyyy/MM/dd")


@query(
    "",
    """SELECT o_orderkey, CASE WHEN o_orderstatus IN ('P') THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_orderpriority,
  CAST(o_orderdate AS DATE) AS o_orderdate FROM orders""",
)
def delimited_options(spark, d):
    """Pipe-separated files with two header lines, quotes, blanks, NULL words and a date format."""

    def write(path):
        status = F.when(F.col("o_orderstatus") == "P", " N/A ").otherwise(F.concat(F.lit(" "), "o_orderstatus"))
        line = landing.joined(
            "|", F.col("o_orderkey"), status, F.concat(F.lit("'"), "o_orderpriority", F.lit("'")),
            F.date_format("o_orderdate", "yyyy/MM/dd"),
        )
        # The text writer puts the two header lines, as part of the first record, on top of every file.
        rows = table(spark, d, "orders").select(line.alias("made for the check"))
        rows = rows.withColumnRenamed("made for the check", "report of orders\nkey|status|priority|date")
        rows.write.option("header", True).option("quote", "").option("sep", "\u0001").csv(path)

    folder = landing._once(spark, d, "piped", write)
    rows = delimited.read_delimited(spark, [folder], ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate"], _PIPED)
    declared = [
        delimited.FeedColumn("o_orderkey", "bigint"),
        delimited.FeedColumn("o_orderstatus", "char", 1),
        delimited.FeedColumn("o_orderpriority", "varchar", 20),
        delimited.FeedColumn("o_orderdate", "date"),
    ]
    return rows.select(*delimited.typed_select(rows, declared, _PIPED))


@query(
    "",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'extra' WHEN 'F' THEN 'short' END AS problem,
  CASE o_orderstatus WHEN 'O' THEN 'good' ELSE 'bad' END AS verdict FROM orders""",
)
def bad_records(spark, d):
    """Rows with too many or too few fields are told apart from good ones and keep their line."""
    key = F.col("o_orderkey")
    extra = landing.joined(",", key, F.col("o_custkey"), F.lit("x"), F.lit("y"))
    short = landing.joined(",", key, F.col("o_custkey"))
    whole = landing.joined(",", key, F.col("o_custkey"), F.col("o_orderpriority"))
    status = F.col("o_orderstatus")
    line = F.when(status == "P", extra).when(status == "F", short).otherwise(whole)
    folder = landing.text_lines(spark, d, "bad", table(spark, d, "orders").select(line.alias("value")))
    options = delimited.FeedOptions(header_rows=0, keep_bad=True)
    rows = written(delimited.read_delimited(spark, [folder], ["o_orderkey", "o_custkey", "priority"], options), "split")
    good, bad = delimited.split_bad(rows)
    fields = F.split(delimited.BAD_RECORD, ",")
    marked = bad.select(
        fields[0].cast("long").alias("o_orderkey"),
        F.when(F.size(fields) > 3, "extra").otherwise("short").alias("problem"),
        F.lit("bad").alias("verdict"),
    )
    fine = good.select(
        F.col("o_orderkey").cast("long").alias("o_orderkey"), F.lit(None).cast("string").alias("problem"), F.lit("good").alias("verdict")
    )
    return fine.unionByName(marked)


_FIXED = [
    delimited.FeedColumn("customer_id", "bigint", start=1, length=20),
    delimited.FeedColumn("email", "varchar", 50, start=21, length=50),
    delimited.FeedColumn("phone", "varchar", 20, start=71, length=20),
    delimited.FeedColumn("origin", "varchar", 10, start=91, length=10),
]


@query("customers", "SELECT customer_id, coalesce(email, '') AS email, phone, company_name AS origin FROM customers")
def fixed_width(spark, d):
    def padded(column, width):
        return F.rpad(F.coalesce(F.col(column).cast("string"), F.lit("")), width, " ")

    lines = landing.customer_lines(spark, d).select(
        F.concat(F.lpad(F.col("customer_id").cast("string"), 20, " "), padded("email", 50), padded("phone", 20), padded("origin", 10)).alias("value")
    )
    folder = landing.text_lines(spark, d, "fixed", lines)
    return delimited.read_fixed_width(spark, [folder], _FIXED).select("customer_id", "email", "phone", "origin")


@query(
    "",
    """SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS gaps, CAST(0 AS BIGINT) AS out_of_order FROM orders""",
)
def record_ids(spark, d):
    """Every file's rows numbered 1, 2, 3 ... in file order. Lines hold the same count, so each row can be checked."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = table(spark, d, "orders").repartitionByRange(parts, "o_orderkey").sortWithinPartitions("o_orderkey")
    own = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    folder = landing.text_lines(spark, d, "numbered", ranged.select(own.cast("string").alias("value")))
    rows = delimited.read_delimited(spark, [folder], ["place"], delimited.FeedOptions(header_rows=0))
    numbered = number_lines(rows, "_path", "_block", "_at", "record_id")
    per_file = numbered.groupBy("_path").agg(
        F.count("*").alias("n"),
        F.max("record_id").alias("top"),
        F.count_if(F.col("place").cast("long") != F.col("record_id")).alias("wrong"),
    )
    return per_file.agg(
        F.sum("n").alias("row_count"), F.sum(F.col("top") - F.col("n")).alias("gaps"), F.sum("wrong").alias("out_of_order")
    )
