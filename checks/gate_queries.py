"""Gates between landing and the registry, purges, pulls with a mark, and runs at the same time."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import functions as F

from checks import landing
from checks.bindings import meta, table
from checks.pipeline_queries import _NEW_FILES, NOW, _LINES, _listing, now
from checks.registry import query
from tidegate import schemas
from tidegate.operators import processes, pulls, purge, readiness, register, stage
from tidegate.session import scratch_path, written
from tidegate.sources import delimited
from tidegate.sources.landing import list_files

# By source: passes, is violated, (wrong header), cannot be parsed, writes, (wrong header).
STATEMENTS = [
    "SELECT * FROM staged WHERE customer_id IS NULL",
    """WITH known AS (SELECT customer_id FROM staged WHERE origin IS NOT NULL)
    SELECT * FROM staged WHERE customer_id NOT IN (SELECT customer_id FROM known) OR email LIKE '%test%'""",
    "SELECT 1",
    "SELEC nothing",
    "INSERT INTO staged SELECT * FROM staged",
    "SELECT 1",
]


@query(
    "customers",
    """SELECT src + 1 AS object_id, CASE WHEN src % 3 = 2 THEN 'header' WHEN src = 0 THEN 'loaded' WHEN src = 1 THEN
    CASE WHEN count(*) FILTER (origin IS NULL OR email LIKE '%test%') > 0 THEN 'violated' ELSE 'loaded' END
  ELSE 'refused' END AS verdict,
  CASE WHEN src = 0 OR src = 1 AND count(*) FILTER (origin IS NULL OR email LIKE '%test%') = 0 THEN 'COMPLETED' ELSE 'REGISTERED' END AS file_status,
  CASE WHEN src = 0 OR src = 1 AND count(*) FILTER (origin IS NULL OR email LIKE '%test%') = 0 THEN count(*) ELSE 0 END AS staged_rows,
  CASE WHEN src = 1 AND count(*) FILTER (origin IS NULL OR email LIKE '%test%') > 0 THEN count(*) FILTER (origin IS NULL OR email LIKE '%test%') END
    AS violations
FROM lines GROUP BY src""",
    {"lines": _LINES},
)
def post_validation(spark, d):
    """A load whose sources declare validations: what became of the files of each source, and what was staged."""
    m, root = landing.registered_meta(spark, d, NOW)
    number = F.col("source_id") - 1
    case = F.when(number == 0, F.lit(STATEMENTS[0]))
    for n, statement in enumerate(STATEMENTS[1:], 1):
        case = case.when(number == n, F.lit(statement))
    m = m.with_tables(source=m.source.withColumn("post_validation_sql", case))
    out = scratch_path(spark, "bronze")
    outcomes = stage.stage_files(m, root, out)
    registry = stage.registry_after_load(m.data_file, outcomes, now()).select("file_id", "file_status")
    staged = stage.read_stage(spark, out).groupBy("file_id").agg(F.count("*").alias("n"))
    reason = F.coalesce("reject_reason", F.lit(""))
    verdict = (
        F.when(reason == "", "loaded").when(reason.startswith("Header"), "header").when(reason.contains("refused"), "refused")
        .when(reason.contains("violate"), "violated").otherwise("failed")
    )
    rows = outcomes.join(registry, "file_id").join(staged, "file_id", "left").withColumn("verdict", verdict)
    found = F.when(F.col("verdict") == "violated", F.regexp_extract("reject_reason", r"(\d+) rows", 1).cast("long"))
    per_file = rows.select("object_id", "verdict", "file_status", F.coalesce("n", F.lit(0)).alias("n"), found.alias("found"))
    return per_file.groupBy("object_id", "verdict", "file_status").agg(F.sum("n").alias("staged_rows"), F.max("found").alias("violations"))


_BAD_LINES = {
    "sent": """SELECT o_custkey % 6 AS src, o_orderkey, o_custkey, o_orderpriority, o_orderkey % 10 < o_custkey % 6 AS bad FROM orders
  WHERE o_custkey % 6 <> 2""",
    "limits": "SELECT DISTINCT src, CASE WHEN src <> 3 THEN 25 END AS pct FROM sent",
}


def _orders_meta(spark, d, write, **changes):
    """Files of orders by ``src`` in landing folders of their own, and control tables after they were registered."""
    root = landing._once(spark, d, "sent", write)
    m = landing.landing_meta(spark, d)
    columns = [("o_orderkey", "BIGINT"), ("o_custkey", "BIGINT"), ("o_orderpriority", "VARCHAR")]
    feed = spark.createDataFrame(
        [(s + 1, k, n, t) for s in range(landing.SOURCES) for k, (n, t) in enumerate(columns, 1)],
        "source_id long, ordinal_position long, column_name string, data_type string",
    )
    feed = schemas.conform(feed.withColumn("column_id", F.col("source_id") * 10 + F.col("ordinal_position")), schemas.META_SCHEMAS["source_feed_column"])
    objects = m.data_object.withColumns({"filename_pattern": F.lit("part-%"), "header_row_count": F.lit(0).cast("long"), "file_format": F.lit("DELIM"), **changes})
    m = m.with_tables(source_feed_column=feed, data_object=objects)
    rows = register.register_files(m, list_files(spark, f"{root}/Files"), NOW)
    return m.with_tables(data_file=written(rows, "registry")), f"{root}/Files"


@query(
    "",
    """SELECT s.src + 1 AS object_id, CASE WHEN 100 * count(*) FILTER (bad) > min(pct) * count(*) THEN 'REGISTERED' ELSE 'COMPLETED' END AS file_status,
  CASE WHEN 100 * count(*) FILTER (bad) > min(pct) * count(*) THEN 0 ELSE count(*) END AS staged_rows,
  CASE WHEN 100 * count(*) FILTER (bad) > min(pct) * count(*) THEN NULL ELSE count(*) FILTER (bad) END AS errors
FROM sent s JOIN limits l ON l.src = s.src GROUP BY s.src""",
    _BAD_LINES,
)
def threshold_gate(spark, d):
    """One file per source, each with another share of rows with too few fields; 25 percent are allowed, in one source all."""

    def write(root):
        orders = table(spark, d, "orders").withColumn("src", F.col("o_custkey") % landing.SOURCES).filter("src <> 2")
        whole = landing.joined(",", F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority"))
        line = F.when(F.col("o_orderkey") % 10 < F.col("src"), F.col("o_orderkey").cast("string")).otherwise(whole)
        for n in range(landing.SOURCES):
            orders.filter(F.col("src") == n).select(line.alias("value")).coalesce(1).write.text(f"{root}/Files/src={n}")

    limit = F.when(F.col("object_id") != 4, 25).cast("long")
    m, root = _orders_meta(spark, d, write, error_row_threshold_pct=limit)
    ids = m.source.select("source_id").distinct().withColumns({"error_on_column_count_mismatch": F.lit("TRUE")})
    m = m.with_tables(source_feed=schemas.conform(ids, schemas.META_SCHEMAS["source_feed"]))
    out = scratch_path(spark, "bronze")
    outcomes = stage.stage_files(m, root, out, full_options=True)
    registry = stage.registry_after_load(m.data_file, outcomes, now())
    staged = stage.read_stage(spark, out).groupBy("file_id").agg(F.count("*").alias("n"))
    rows = registry.select("file_id", "object_id", "file_status", "fm_error_record_count").join(staged, "file_id", "left")
    return rows.groupBy("object_id", "file_status").agg(F.sum(F.coalesce("n", F.lit(0))).alias("staged_rows"), F.sum("fm_error_record_count").alias("errors"))


@query(
    "",
    """SELECT * EXCLUDE (place) FROM (SELECT l_suppkey, l_orderkey, l_linenumber, l_shipdate,
  row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_orderkey, l_linenumber) AS place FROM
  (SELECT CASE WHEN l_orderkey % 2 = 0 THEN 0 ELSE l_suppkey END AS l_suppkey, l_orderkey, l_linenumber, l_shipdate FROM lineitem)) WHERE place <= 3""",
)
def newest_three(spark, d):
    """The newest three lines of each supplier, one of whom has half of all lines."""
    supplier = F.when(F.col("l_orderkey") % 2 == 0, 0).otherwise(F.col("l_suppkey")).cast("long")
    rows = table(spark, d, "lineitem").select(supplier.alias("l_suppkey"), "l_orderkey", "l_linenumber", "l_shipdate")
    return purge.newest_rows(rows, ["l_suppkey"], "l_shipdate desc, l_orderkey, l_linenumber", 3)


_PURGED = {
    "files": """SELECT l_orderkey * 10 + l_linenumber AS file_id, CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE min(l_suppkey) + 1 END AS object_id,
  max(l_shipdate) AS received FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "due": """SELECT file_id FROM (SELECT *, row_number() OVER (PARTITION BY object_id ORDER BY received DESC, file_id DESC) AS place FROM files)
  WHERE CASE object_id % 3 WHEN 1 THEN place > 3 WHEN 2 THEN received < TIMESTAMP '1998-01-01' - INTERVAL 24 MONTH ELSE false END""",
}


def _purge_meta(spark, d):
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber")
    lines = lines.agg(F.max("l_shipdate").alias("received"), F.min("l_suppkey").alias("k"))
    owner = F.when(F.col("l_orderkey") % 2 == 0, 1).otherwise(F.col("k") + 1).cast("long")
    files = lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("file_id"), owner.alias("object_id"), F.lit("COMPLETED").alias("file_status"),
        F.col("received").cast("timestamp").alias("file_received_date"), F.lit(None).cast("timestamp").alias("modified_date"),
    )
    number = F.col("source_id") % 3
    source = meta(spark, d).source.select(
        "source_id", "stage_name", F.when(number == 1, "count").when(number == 2, "AGE").alias("purge_type"),
        F.when(number == 1, 3).otherwise(24).cast("long").alias("purge_max_length"), F.lit("MONTHS").alias("purge_max_length_type"),
    )
    return meta(spark, d).with_tables(data_file=files, source=source)


@query("", "SELECT file_id FROM due", _PURGED)
def files_due_for_purge(spark, d):
    """Files beyond the newest three of a source, one of which has half of all, or older than two years, as the sources declare."""
    return purge.files_due(_purge_meta(spark, d), datetime(1998, 1, 1)).select("file_id")


@query(
    "",
    """SELECT f.object_id, CASE WHEN d.file_id IS NULL THEN 'COMPLETED' ELSE 'PURGED' END AS file_status, count(*) AS files,
  count(*) FILTER (d.file_id IS NULL) AS staged_files FROM few f LEFT JOIN due d ON d.file_id = f.file_id GROUP BY ALL""",
    {
        "few": "SELECT s_suppkey AS file_id, s_nationkey + 1 AS object_id, s_suppkey % 7 AS age FROM supplier",
        "due": """SELECT file_id FROM (SELECT *, row_number() OVER (PARTITION BY object_id ORDER BY age, file_id DESC) AS place FROM few) WHERE place > 2""",
    },
)
def purged_partitions(spark, d):
    """A stage table of one partition per file, of which the newest two of each source stay: the registry, and the partitions that are left."""
    few = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("file_id"), (F.col("s_nationkey") + 1).cast("long").alias("object_id"), F.lit("STAGED").alias("file_status"),
        (F.lit(NOW) - F.make_interval(days=(F.col("s_suppkey") % 7).cast("int"))).alias("file_received_date"),
        F.lit(None).cast("timestamp").alias("modified_date"),
    )
    stage_name = F.concat(F.lit("STG /"), F.col("object_id").cast("string"))
    source = few.select(
        F.col("object_id").alias("source_id"), stage_name.alias("stage_name"), F.lit("COUNT").alias("purge_type"),
        F.lit(2).cast("long").alias("purge_max_length"), F.lit(None).cast("string").alias("purge_max_length_type"),
    ).distinct()
    m = meta(spark, d).with_tables(data_file=written(few.withColumn("file_status", F.lit("COMPLETED")), "few"), source=source)
    out = scratch_path(spark, "bronze")
    rows = m.data_file.select("file_id", stage_name.alias("stage_name"), F.col("file_id").alias("value"))
    # A fixed number of partitions, which adaptive execution does not merge into one task, however many files that would open; tasks move
    # what they wrote to its place themselves, since the folder is new and read only after the write.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = rows.repartition(parts, "file_id").write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.partitionBy("stage_name", "file_id").parquet(out)
    registry = written(purge.purge_files(m, out, NOW), "after")
    left = stage.read_stage(spark, out).select("file_id").distinct().withColumn("here", F.lit(1))
    joined = registry.join(left, "file_id", "left")
    return joined.groupBy("object_id", "file_status").agg(F.count("*").alias("files"), F.count("here").alias("staged_files"))


@query(
    "",
    """SELECT o_orderkey, o_orderdate, CAST(1 AS BIGINT) AS times, CASE WHEN o_orderdate < TIMESTAMP '1995-01-01' THEN 'first' WHEN o_orderdate < TIMESTAMP '1997-06-30'
  THEN 'second' ELSE 'third' END AS pull, '1999-01-01 00:00:00.000000' AS mark FROM orders WHERE o_orderdate >= TIMESTAMP '1993-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
  AND o_orderstatus <> 'P'""",
)
def pulls_with_a_mark(spark, d):
    """Three pulls that meet at times which many orders have, one of them asked for twice: each order comes once."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    statement = "WITH closed AS (SELECT * FROM orders WHERE o_orderstatus <> 'P') SELECT o_orderkey, o_orderdate FROM closed;"
    config = {"source_id": 7, "input_sql": statement, "column_name": "o_orderdate", "last_pull_date": "1993-01-01"}
    out = scratch_path(spark, "pulls")
    times = {"first": datetime(1995, 1, 1), "second": datetime(1997, 6, 30), "third": datetime(1999, 1, 1)}
    taken = {name: pulls.pull(spark, config, {"orders": orders}, out, until) for name, until in times.items()}
    if pulls.pull(spark, config, {"orders": orders}, out, times["second"]) is not None:
        raise RuntimeError("a pull up to an earlier time must find nothing")
    marks = spark.createDataFrame([(7, "1993-01-01")], "source_id long, last_pull_date string")
    mark = pulls.advanced_marks(marks, out).select(F.col("last_pull_date").alias("mark"))
    named = [rows.withColumn("pull", F.lit(name)) for name, rows in taken.items()]
    every = named[0].unionByName(named[1]).unionByName(named[2])
    counted = every.groupBy("o_orderkey", "o_orderdate").agg(F.count("*").alias("times"), F.max("pull").alias("pull"))
    return counted.withColumn("mark", F.lit(mark.first()["mark"]))


@query(
    "data_file data_object batch",
    """SELECT 'file' AS kind, (SELECT coalesce(max(file_id), 0) FROM data_file) + row_number() OVER (ORDER BY object_id, path) AS id, filename AS name FROM fitting
WHERE object_id = first_object UNION ALL SELECT 'batch', (SELECT max(batch_id) FROM batch) + n, 'run' FROM range(1, 5) r(n)""",
    _NEW_FILES,
)
def runs_at_once(spark, d):
    """Four runs at the same time register the same landed files and open a batch each: no file twice, no id twice."""
    m = meta(spark, d)
    folder = scratch_path(spark, "meta")
    for name in ("data_file", "data_object", "batch"):
        schemas.conform(getattr(m, name), schemas.META_SCHEMAS[name]).write.parquet(f"{folder}/{name}")
    listing = written(_listing(spark, d), "listing")
    top = {n: m_.agg(F.max(c)).first()[0] for n, m_, c in (("file", m.data_file, "file_id"), ("batch", m.batch, "batch_id"))}

    def run(number):
        register.append_received(spark, folder, listing, "2-HIGH", NOW)
        register.append_batch(spark, folder, "run", NOW)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(run, range(4)))
    files = spark.read.parquet(f"{folder}/data_file").filter(F.col("file_id") > top["file"])
    batches = spark.read.parquet(f"{folder}/batch").filter(F.col("batch_id") > top["batch"])
    named = files.select(F.lit("file").alias("kind"), F.col("file_id").alias("id"), F.col("filename").alias("name"))
    return named.unionByName(batches.select(F.lit("batch").alias("kind"), F.col("batch_id").alias("id"), F.col("batch_name").alias("name")))


_REPORT = delimited.FeedOptions(delimiter=",", header_rows=2, footer_rows=3, line_end="#\n#", time_format="HH.mm.ss", trim=True)


@query(
    "",
    """SELECT e_id AS event_id, strftime(make_timestamp((e_id % 86400) * 1000000), '%H:%M:%S') AS at, CAST(1 AS BIGINT) AS times FROM (SELECT o_orderkey AS e_id FROM orders)""",
)
def footers_and_row_ends(spark, d):
    """Files whose rows end with three characters, with two header and three footer lines and a time of day."""

    def write(path):
        seconds = F.col("o_orderkey") % 86400
        clock = F.format_string("%02d.%02d.%02d", (seconds / 3600).cast("int"), (seconds / 60 % 60).cast("int"), (seconds % 60).cast("int"))
        lines = table(spark, d, "orders").select(landing.joined(",", F.col("o_orderkey"), clock).alias("value"))
        head, foot = "report of times#\n#id,at#\n#", "#\n#total#\n#,,#\n#end"
        # Each file is one text of header, lines and footer, in a folder of its own.
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        grouped = lines.groupBy(F.pmod(F.xxhash64("value"), F.lit(max(parts, 4))).alias("part")).agg(F.array_join(F.collect_list("value"), "#\n#").alias("value"))
        grouped.select("part", F.concat(F.lit(head), "value", F.lit(foot)).alias("value")).write.partitionBy("part").text(path)

    folder = landing._once(spark, d, "footers", write)
    rows = delimited.read_delimited(spark, [folder], ["event_id", "at"], _REPORT)
    declared = [delimited.FeedColumn("event_id", "bigint"), delimited.FeedColumn("at", "time")]
    typed = rows.select(*delimited.typed_select(rows, declared, _REPORT)).withColumn("at", F.col("at").cast("string"))
    return typed.groupBy("event_id", "at").agg(F.count("*").alias("times"))


_DUE = {
    "declared": """SELECT s.source_id, s.source_code, s.receipt_frequency, upper(s.receipt_frequency) AS f, 1 + s.source_id % 40 AS d,
  INTERVAL 1 MINUTE * (CASE WHEN s.source_id % 3 > 0 THEN 30 + 60 * (s.source_id % 24) ELSE 0 END) AS tod FROM source s JOIN data_object o ON o.object_id = s.source_id
  WHERE o.required_ind = 'Y' AND s.source_type LIKE '%file%' AND upper(s.receipt_frequency) IN ('DAILY', 'WEEKLY', 'MONTHLY', 'QUARTERLY')""",
    "units": """SELECT *, CASE f WHEN 'DAILY' THEN 'day' WHEN 'WEEKLY' THEN 'week' WHEN 'MONTHLY' THEN 'month' ELSE 'quarter' END AS u,
  CASE f WHEN 'DAILY' THEN INTERVAL 1 DAY WHEN 'WEEKLY' THEN INTERVAL 7 DAY WHEN 'MONTHLY' THEN INTERVAL 1 MONTH ELSE INTERVAL 3 MONTH END AS step FROM declared""",
    "starts": """SELECT *, CAST(date_trunc(u, TIMESTAMP '1998-03-01 12:00:00') AS TIMESTAMP) AS this_start,
  CAST(date_trunc(u, TIMESTAMP '1998-03-01 12:00:00') AS TIMESTAMP) - step AS past_start FROM units""",
    "moments": """SELECT *, this_start + INTERVAL 1 DAY * (least(d, CASE f WHEN 'DAILY' THEN 1 WHEN 'WEEKLY' THEN 7 ELSE day(last_day(this_start)) END) - 1) + tod AS due_now,
  past_start + INTERVAL 1 DAY * (least(d, CASE f WHEN 'DAILY' THEN 1 WHEN 'WEEKLY' THEN 7 ELSE day(last_day(past_start)) END) - 1) + tod AS due_before FROM starts""",
    "latest": """SELECT object_id, max(modified_date) AS received FROM data_file WHERE modified_date <= CASE WHEN object_id % 4 = 1 THEN TIMESTAMP '1997-12-01' ELSE TIMESTAMP '1998-03-01 12:00:00' END
  GROUP BY object_id""",
}


@query(
    "source data_object data_file",
    """SELECT source_id, source_code, receipt_frequency, due, received AS last_received, CAST(floor(epoch(TIMESTAMP '1998-03-01 12:00:00' - due) / 3600) AS BIGINT) AS hours_late
FROM (SELECT *, CASE WHEN due_now <= TIMESTAMP '1998-03-01 12:00:00' THEN due_now ELSE due_before END AS due FROM moments) m
LEFT JOIN latest l ON l.object_id = m.source_id WHERE received IS NULL OR received < due""",
    _DUE,
)
def overdue_sources(spark, d):
    """Required sources without a file since their last due time, by declared day and time."""
    m = meta(spark, d)
    n = F.col("source_id")
    time_of_day = F.when(n % 3 > 0, F.concat(F.lpad((n % 24).cast("string"), 2, "0"), F.lit(":30")))
    source = m.source.withColumns({"receipt_day": 1 + n % 40, "receipt_time": time_of_day})
    files = m.data_file.filter("modified_date <= CASE WHEN object_id % 4 = 1 THEN TIMESTAMP_NTZ '1997-12-01' ELSE TIMESTAMP_NTZ '1998-03-01 12:00:00' END").withColumn("file_received_date", F.col("modified_date"))
    out = readiness.overdue_sources(m.with_tables(source=source, data_file=files), F.to_timestamp_ntz(F.lit("1998-03-01 12:00:00")))
    return out


@query(
    "process_log",
    """SELECT 'step ' || CAST(process_log_id % 3 AS VARCHAR) AS process_name, count(*) AS steps, count(*) FILTER (end_time IS NULL) AS unfinished,
  CAST(coalesce(sum(CASE WHEN end_time IS NOT NULL THEN process_log_id % 500 END), 0) AS BIGINT) AS seconds,
  CAST(max(CASE WHEN end_time IS NOT NULL THEN process_log_id % 500 END) AS BIGINT) AS longest,
  CAST(coalesce(sum(inserted_rows), 0) AS BIGINT) AS total_rows, CAST(min(place) AS BIGINT) AS first_id
FROM (SELECT *, 100 + row_number() OVER (ORDER BY process_log_id, start_time) AS place FROM process_log) GROUP BY ALL""",
)
def process_details(spark, d):
    """The detail log written for all log entries, with ids that follow the highest one, and its elapsed times by process."""
    m = meta(spark, d)
    old = schemas.conform(spark.range(1).select(F.lit(100).cast("long").alias("process_log_detail_id")), schemas.META_SCHEMAS["process_log_detail"])
    name = F.concat(F.lit("step "), (F.col("process_log_id") % 3).cast("string"))
    steps = m.process_log.select(
        "process_log_id", F.lit(1).alias("step"), name.alias("process_name"), F.lit("loaded").alias("log_detail_message"),
        "start_time", (F.col("end_time") + F.make_dt_interval(secs=(F.col("process_log_id") % 500).cast("decimal(18,6)"))).alias("end_time"),
        F.col("inserted_rows").alias("total_row_cnt"),
    )
    rows = written(processes.detail_rows(m.with_tables(process_log_detail=old), steps, now()), "details")
    first = rows.groupBy("process_name").agg(F.min("process_log_detail_id").alias("first_id"))
    return processes.elapsed_by_process(rows).join(first, "process_name")
