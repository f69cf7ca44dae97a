"""Gates of a load, lines from both ends of a file, purges, pulls, and runs at the same time."""

import threading
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, time as clock, timedelta

import pytest
from pyspark.sql import functions as F

from test_files import NOW, control, land, received
from checks import gate_queries
from tidegate import schemas
from tidegate.operators import declared, pulls, purge, register, stage
from tidegate.operators.validate import by_cases, query_over, refusal, validate
from tidegate.plans.ordering import number_lines
from tidegate.plans.turns import turn
from tidegate.sources import delimited, folders, headers
from tidegate.sources.landing import list_files

FEED = [("id", "BIGINT"), ("name", "VARCHAR"), ("at", "TIME")]


def test_threshold_and_validation_in_the_load(spark, tmp_path, rows):
    land(tmp_path, "cust_1.csv", "id,name,at\n1,a,10:00\n2\n3\n4,d,11:00\n")
    land(tmp_path, "cust_2.csv", "id,name,at\n5,e,10:00\n6\n7,g,1:61\n8,h,11:00\n")
    land(tmp_path, "other_1.csv", "id,name,at\n9,bad,10:00\n", "b")
    feed = [{"source_id": s, "error_on_column_count_mismatch": "TRUE", "time_format": "H:mm"} for s in (1, 2)]
    m = control(spark, ((1, "cust_%", "/Files/a"), (2, "other_%", "/Files/b")), FEED, feed, error_row_threshold_pct=25)
    m = received(spark, m, tmp_path)
    strict = m.with_tables(source=m.source.withColumn("post_validation_sql", F.when(F.col("source_id") == 2, "SELECT * FROM staged WHERE name = 'bad';")))
    out = f"{tmp_path}/bronze"
    outcomes = stage.stage_files(strict, f"{tmp_path}/Files", out, full_options=True)
    found = {r["path"].rsplit("/", 1)[1]: r for r in outcomes.collect()}
    assert found["cust_1.csv"]["reject_reason"] == "2 of 4 rows are bad, more than 25 percent." and found["cust_1.csv"]["row_count"] is None
    assert found["other_1.csv"]["reject_reason"] == "Validation: 1 rows violate it."
    assert (found["cust_2.csv"]["row_count"], found["cust_2.csv"]["error_row_count"]) == (4, 1)
    good = stage.read_stage(spark, out).filter("_corrupt_record IS NULL")
    assert rows(good, "id", "at") == [(5, clock(10, 0)), (7, None), (8, clock(11, 0))]
    status = {r["filename"]: r["file_status"] for r in stage.registry_after_load(strict.data_file, outcomes, F.lit(NOW)).collect()}
    assert status == {"cust_1.csv": "REGISTERED", "cust_2.csv": "COMPLETED", "other_1.csv": "REGISTERED"}
    assert not list((tmp_path / "bronze").glob("_run-*"))

    # Without the gates all are loaded; a later load that does not pass leaves what was there before.
    free = m.with_tables(data_object=m.data_object.drop("error_row_threshold_pct"))
    stage.stage_files(free, f"{tmp_path}/Files", out, full_options=True)
    assert stage.read_stage(spark, out).count() == 9
    stage.stage_files(strict, f"{tmp_path}/Files", out, full_options=True)
    assert stage.read_stage(spark, out).count() == 9


def test_a_source_without_stage_name_is_loaded(spark, tmp_path):
    land(tmp_path, "cust_1.csv", "id,name,at\n1,a,\n")
    for k, name in enumerate((None, "", "A/b c=%")):
        m = control(spark, feed=FEED)
        m = received(spark, m.with_tables(source=m.source.withColumn("stage_name", F.lit(name).cast("string"))), tmp_path)
        for _ in range(2):
            outcomes = stage.stage_files(m, f"{tmp_path}/Files", f"{tmp_path}/out{k}")
            assert outcomes.first()["row_count"] == 1
            assert [(r["id"], r["stage_name"], r["file_id"]) for r in spark.read.parquet(f"{tmp_path}/out{k}").collect()] == [(1, name or None, 1)]


def test_a_load_reads_each_file_once(spark, tmp_path):
    """Nothing of the landed files or of the staged columns is read again to count rows."""
    land(tmp_path, "cust_1.csv", "id,name,at\n1,a,\n")
    m = received(spark, control(spark, feed=FEED), tmp_path)
    outcomes = stage.stage_files(m, f"{tmp_path}/Files", f"{tmp_path}/out")
    assert outcomes.first()["row_count"] == 1
    # The rows of a layout without a bad-row column are counted without reading any column.
    stored = spark.read.schema("_corrupt_record string, file_id long").parquet(str(tmp_path / "out" / "stage_name=STG_1"))
    plan = stored.groupBy("file_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    # Nothing of a load stays behind in the session that models could not be sent along with.
    assert not hasattr(stage, "Observation")


@pytest.mark.parametrize(
    "statement, why",
    [
        ("SELECT * FROM staged", None),
        ("TABLE staged", None),
        ("WITH a AS (SELECT * FROM staged), b AS (WITH c AS (TABLE a) TABLE c) SELECT * FROM b JOIN a USING (id) WHERE id > (SELECT min(id) FROM a)", None),
        ("SELECT * FROM staged WHERE EXISTS (SELECT 1 FROM other)", "reads other"),
        ("SELECT (SELECT max(x) FROM db.t) FROM staged", "reads db.t"),
        ("SELECT * FROM parquet.`/x`", "reads parquet./x"),
        ("WITH a AS (SELECT * FROM elsewhere) SELECT * FROM staged", "reads elsewhere"),
        ("INSERT INTO staged SELECT 1", "no query"),
        ("DROP TABLE staged", "no query"),
        ("CREATE TABLE t AS SELECT * FROM staged", "no query"),
        ("SET a = b", "no query"),
        ("EXPLAIN SELECT * FROM staged", "no query"),
        ("MERGE INTO staged USING staged s ON true WHEN MATCHED THEN DELETE", "no query"),
        ("BEGIN SELECT 1; END", "no query"),
        ("SELECT 1; SELECT 2", "parsed"),
        ("SELEC 1", "parsed"),
        ("SELECT 1) UNION ALL (SELECT 2", "parsed"),
        ("SELECT * FROM staged WHERE Reflect('java.lang.System', 'exit', 1) = 1", "calls reflect"),
        ("SELECT * FROM range(3)", "from elsewhere"),
    ],
)
def test_only_queries_over_the_staged_rows_are_let_through(spark, statement, why):
    found = refusal(spark, statement)
    assert (found is None) if why is None else why.lower() in found.lower(), found


def test_validate(spark, rows):
    staged = spark.createDataFrame([(1, "a"), (2, None)], "id long, name string")
    statements = {
        1: "SELECT * FROM staged WHERE id < 0 -- none", 2: "SELECT * FROM staged ORDER BY id;", 3: "SELECT nothing FROM staged",
        4: "DELETE FROM staged", 5: "SELECT * FROM staged", 6: "SELECT id FROM staged WHERE assert_true(id < 2) IS NULL",
    }
    found = validate(spark, statements, lambda s: None if s == 5 else staged)
    assert rows(found, "source_id", "status", "violations") == [
        (1, "PASSED", 0), (2, "FAILED", 2), (3, "ERROR", None), (4, "REFUSED", None), (5, "PASSED", 0), (6, "ERROR", None),
    ]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("staged")]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("end", ["\n", "\r\n", "|", "#\n#"])
def test_lines_from_both_ends_of_a_split_file(spark, tmp_path, small_splits, end):
    sizes = {"a.csv": 900, "b.csv": 0, "c.csv": 3}
    for name, n in sizes.items():
        lines = ["report", "made by us", "id,at", *[f"{k},{k % 24}.05" for k in range(n)], "total", f"{n}"]
        (tmp_path / name).write_bytes((end.join(lines) + end).encode())
    options = delimited.feed_options({"column_delimiter": ",", "header_row_count": 3, "footer_row_count": 2, "row_delimiter": end, "time_format": "H.mm"})
    read = delimited.read_delimited(spark, [str(tmp_path)], ["id", "at"], options, lines=True)
    assert read.select("_path", "_block").distinct().count() > 5
    feed = [delimited.FeedColumn("id", "bigint"), delimited.FeedColumn("at", "time")]
    typed = read.select(*delimited.typed_select(read, feed, options), delimited.LINE, F.element_at(F.split("_path", "/"), -1).alias("file"))
    assert sorted(map(tuple, typed.collect())) == sorted((k, clock(k % 24, 5), k + 1, name) for name, n in sizes.items() for k in range(n))


def test_numbering_copies_no_rows(spark, tmp_path, small_splits):
    (tmp_path / "f.csv").write_text("".join(f"{k}\n" for k in range(2000)))
    read = delimited.read_delimited(spark, [str(tmp_path)], ["k"], delimited.FeedOptions(header_rows=0))
    numbered = number_lines(read, "_path", "_block", "_at", "n")
    assert numbered.filter("n <> k + 1").count() == 0 and numbered.count() == 2000
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("csv") == 1 and plan.count("parquet") == 1  # the rows come from the file, what is stored are counts


def test_last_header_line(spark, tmp_path, rows):
    land(tmp_path, "cust_1.csv", "made today\n\nid,name,at\n1,a,\n2,b,\ntotal\n")
    land(tmp_path, "cust_2.csv", "short\n")
    feed = [{"source_id": 1, "add_record_id_ind": "Y"}]
    m = received(spark, control(spark, feed=FEED, source_feed=feed, footer_row_count=1), tmp_path)
    m = m.with_tables(data_object=m.data_object.withColumn("header_row_count", F.lit(2).cast("long")))
    done = {r["path"].rsplit("/", 1)[1]: r for r in stage.stage_files(m, f"{tmp_path}/Files", f"{tmp_path}/out", full_options=True).collect()}
    assert {r["reject_reason"] for r in done.values()} == {"The file is empty or has no header line."}
    m = m.with_tables(data_object=m.data_object.withColumn("header_row_count", F.lit(3).cast("long")))
    land(tmp_path, "cust_1.csv", "made today\nby us\nid,name,at\n1,a,\n2,b,\ntotal\n")
    stage.stage_files(m, f"{tmp_path}/Files", f"{tmp_path}/out", full_options=True)
    assert rows(stage.read_stage(spark, f"{tmp_path}/out"), "id", "name", "record_id") == [(1, "a", 1), (2, "b", 2)]


def test_headers_by_scan_of_several_lines(spark, tmp_path, monkeypatch):
    land(tmp_path, "a.csv", "x\r\nid,name\r\n1,2\r\n")
    land(tmp_path, "b.csv", "one")
    land(tmp_path, "c.csv", "x|y|z")
    files = list_files(spark, f"{tmp_path}/Files").select("path")
    bar = F.when(F.col("path").endswith("c.csv"), "|").otherwise("CRLF")
    files = files.withColumns({"header_row_count": F.lit(2).cast("long"), "row_delimiter": bar})
    seek = {(r["path"][-5:], r["header"]) for r in headers.first_lines(files, f"{tmp_path}/Files").collect()}
    monkeypatch.setattr(headers, "qualified", lambda *_: "far://away")
    scan = {(r["path"][-5:], r["header"]) for r in headers.first_lines(files, f"{tmp_path}/Files").collect()}
    assert seek == scan == {("a.csv", "id,name"), ("b.csv", ""), ("c.csv", "y")}


def test_windows_pass_on_few_rows_of_a_hot_key(spark):
    rows = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    for df in (purge.newest_rows(rows, ["k"], "v desc", 3), declared.latest_rows(rows.withColumn("w", F.lit(1)), ["k"], "w desc, v")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("WindowGroupLimit") >= 2, plan  # before and after the shuffle
    assert sorted(map(tuple, purge.newest_rows(rows, ["k"], "v desc", 2).collect())) == [(0, 996), (0, 998), (1, 997), (1, 999)]


def purge_tables(spark, files, sources):
    m = control(spark)
    schema = schemas.META_SCHEMAS["data_file"]
    m = m.with_tables(data_file=spark.createDataFrame([tuple(f.get(c.name) for c in schema) for f in files], schema))
    source = schemas.META_SCHEMAS["source"]
    return m.with_tables(source=spark.createDataFrame([tuple(s.get(c.name) for c in source) for s in sources], source))


def test_purge(spark, tmp_path, rows):
    day = timedelta(days=1)
    files = [{"file_id": 10 * s + k, "object_id": s, "file_status": "COMPLETED" if k else "REGISTERED", "file_received_date": NOW - (k // 2) * day if k < 8 else None} for s in range(1, 7) for k in range(9)]
    sources = [
        {"source_id": 1, "stage_name": "A", "purge_type": "COUNT", "purge_max_length": 3},
        {"source_id": 2, "stage_name": "B /", "purge_type": "age", "purge_max_length": 1, "purge_max_length_type": "DAYS"},
        {"source_id": 3, "stage_name": "C", "purge_type": "count", "purge_max_length": 0},
        {"source_id": 4, "stage_name": "D", "purge_type": "COUNT", "purge_max_length": 100},
        {"source_id": 5, "stage_name": "E", "purge_type": "n/a", "purge_max_length": 1},
        {"source_id": 6, "stage_name": "F", "purge_type": "AGE", "purge_max_length": 1, "purge_max_length_type": "moons"},
    ]
    m = purge_tables(spark, files, sources)
    due = [r[0] for r in rows(purge.files_due(m, NOW), "file_id")]
    newest = sorted((f for f in files if f["object_id"] == 1 and f["file_status"] == "COMPLETED"), key=lambda f: (f["file_received_date"] or datetime.min, f["file_id"]))[-3:]
    keep = {f["file_id"] for f in newest}
    want = {f["file_id"] for f in files if f["file_status"] == "COMPLETED" and (
        f["object_id"] == 1 and f["file_id"] not in keep or f["object_id"] == 2 and f["file_received_date"] and f["file_received_date"] < NOW - day or f["object_id"] == 3)}
    assert set(due) == want and len(due) == len(want)

    out = f"{tmp_path}/bronze"
    named = {s["source_id"]: s["stage_name"] for s in sources}
    staged = [(named[f["object_id"]], f["file_id"], 1) for f in files if f["file_status"] == "COMPLETED"]
    spark.createDataFrame(staged, "stage_name string, file_id long, v int").write.partitionBy("stage_name", "file_id").parquet(out)
    for _ in range(2):
        registry = purge.purge_files(m, out, NOW)
        assert {r["file_id"] for r in registry.filter("file_status = 'PURGED'").collect()} == want
        assert {r["file_id"] for r in spark.read.parquet(out).collect()} == {f[1] for f in staged} - want
    none = purge_tables(spark, files, [{"source_id": 1, "stage_name": "A"}])
    assert purge.files_due(none, NOW).count() == 0


def test_folders_are_replaced_by_either_way(spark, tmp_path, monkeypatch):
    def make(name):
        for k, text in (("old", "1"), ("new", "2")):
            folder = tmp_path / name / k / "p=1"
            folder.mkdir(parents=True)
            (folder / f"part-{k}.txt").write_text(text)
        (tmp_path / name / "old" / "p=2").mkdir()
        (tmp_path / name / "old" / "p=2" / "part-0.txt").write_text("3")
        root = f"file:{tmp_path}/{name}"
        return spark.createDataFrame([(f"{root}/new/p=1", f"{root}/old/p=1"), (None, f"{root}/old/p=2"), (None, f"{root}/old/p=3")], "src string, dst string"), f"{root}/old"

    for name, direct in (("a", True), ("b", False)):
        pairs, root = make(name)
        if not direct:
            monkeypatch.setattr(folders, "reachable", lambda _: False)
        folders.replace_folders(pairs, root, "r1")
        assert [r[0] for r in spark.read.text(root).select("value").collect()] == ["2"]
        assert not (tmp_path / name / "old" / "p=2").exists()
        if direct:  # a repeated attempt leaves what the first one has moved
            folders.replace_folders(pairs, root, "r1")
            assert [r[0] for r in spark.read.text(root).select("value").collect()] == ["2"]


def test_pulls_take_each_row_once(spark, tmp_path, rows):
    out = f"{tmp_path}/pulls"
    config = {"source_id": 3, "input_sql": "SELECT * FROM sales WHERE id <> 99", "column_name": "changed", "last_pull_date": None}

    def sales(*more):
        every = [(1, datetime(2020, 1, 1)), (2, datetime(2020, 1, 2)), (99, datetime(2020, 1, 1)), (4, None), *more]
        return {"sales": spark.createDataFrame(every, "id long, changed timestamp_ntz")}

    first = pulls.pull(spark, config, sales(), out, datetime(2020, 1, 2))
    assert rows(first, "id") == [(1,)]
    tied = (3, datetime(2020, 1, 2))  # appears at the mark after the pull
    second = pulls.pull(spark, config, sales(tied), out, datetime(2020, 1, 3))
    assert rows(second, "id") == [(2,), (3,)]
    assert pulls.pull(spark, config, sales(tied), out, datetime(2020, 1, 3)) is None
    lost = tmp_path / "pulls" / "source_id=3" / "pulled_until=20200105T000000000000"  # a pull that was lost
    lost.mkdir()
    third = pulls.pull(spark, config, sales(tied, (5, datetime(2020, 1, 3))), out, datetime(2020, 1, 4))
    assert rows(third, "id") == [(5,)] and not lost.exists()
    assert rows(pulls.pulled(spark, out, 3), "id") == [(1,), (2,), (3,), (5,)]
    marks = spark.createDataFrame([(3, "x", "2019-01-01"), (4, "y", None)], "source_id long, source_code string, last_pull_date string")
    assert rows(pulls.advanced_marks(marks, out)) == [(3, "x", "2020-01-04 00:00:00.000000"), (4, "y", None)]
    with pytest.raises(ValueError, match="refused"):
        pulls.pull(spark, {**config, "input_sql": "DELETE FROM sales"}, sales(), out, datetime(2021, 1, 1))
    declared_mark = {**config, "source_id": 8, "last_pull_date": "2020-01-02"}
    assert rows(pulls.pull(spark, declared_mark, sales(tied), out, datetime(2020, 2, 1)), "id") == [(2,), (3,)]


def test_turns(spark, tmp_path):
    inside, most = [], []

    def run(k):
        with turn(spark, f"{tmp_path}/t", "x"):
            inside.append(k)
            most.append(len(inside))
            time.sleep(0.1)
            inside.remove(k)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(run, range(4)))
    assert most == [1, 1, 1, 1]
    with turn(spark, f"{tmp_path}/t", "x"), pytest.raises(TimeoutError):
        with turn(spark, f"{tmp_path}/t", "x", patience=0.3):
            pass
    left = tmp_path / "t" / "_turn-y"
    left.write_text("")
    import os

    os.utime(left, (1, 1))  # of a run that died
    with turn(spark, f"{tmp_path}/t", "y", patience=5):
        assert left.exists()
    assert not left.exists()


def test_runs_at_once_share_no_id_and_no_file(spark, tmp_path):
    for k in range(7):
        land(tmp_path, f"cust_{k}.csv", "x\n")
    m = control(spark)
    folder = f"{tmp_path}/meta"
    for name in ("data_file", "data_object", "batch", "source"):
        schemas.conform(getattr(m, name), schemas.META_SCHEMAS[name]).write.parquet(f"{folder}/{name}")
    listing = list_files(spark, f"{tmp_path}/Files")
    ready = threading.Barrier(2)

    def run(_):
        ready.wait()
        register.append_batch(spark, folder, "daily_update", NOW)
        return register.append_received(spark, folder, listing, "daily_update", NOW).count()

    with ThreadPoolExecutor(2) as pool:
        found = sorted(pool.map(run, range(2)))
    assert found == [0, 7]
    files = spark.read.parquet(f"{folder}/data_file").collect()
    assert sorted(r["file_id"] for r in files) == list(range(1, 8)) and len({r["filename"] for r in files}) == 7
    assert sorted(r["batch_id"] for r in spark.read.parquet(f"{folder}/batch").collect()) == [4, 5, 6]
    again = spark.read.parquet(f"{folder}/data_file").limit(1)
    with pytest.raises(RuntimeError, match="already"):
        register._unknown(spark.read.parquet(f"{folder}/data_file"), again, "file_id")


def test_new_rows_meet_the_table_without_a_broadcast_of_it(spark, tmp_path):
    wide = ", ".join(f"CAST(NULL AS STRING) AS c{k}" for k in range(20))
    spark.sql(f"SELECT id AS batch_id, {wide} FROM range(1000)").write.parquet(f"{tmp_path}/table")
    spark.range(990, 2000, 10).withColumnRenamed("id", "batch_id").write.parquet(f"{tmp_path}/new")
    table, new = spark.read.parquet(f"{tmp_path}/table"), spark.read.parquet(f"{tmp_path}/new")
    clashes = register._clashes(table, new, "batch_id")
    plan = clashes._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin [batch_id" not in plan
    assert [r[0] for r in clashes.collect()] == [990]
    with pytest.raises(RuntimeError, match="already"):
        register._unknown(table, new, "batch_id")
    register._unknown(table, new.filter("batch_id >= 1000"), "batch_id")


def test_one_partition_a_file_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    suppliers = spark.sql("SELECT id AS s_suppkey, CAST(id % 5 AS INT) AS s_nationkey, concat('Supplier#', id) AS s_name FROM range(60)")
    suppliers.write.parquet(f"{tmp_path}/t/supplier.parquet")
    tasks, purged = set(), purge.purge_files

    def look(m, out, now):
        tasks.update(r["path"].rsplit("/", 1)[1][:10] for r in list_files(spark, out).select("path").collect())
        return purged(m, out, now)

    monkeypatch.setattr(gate_queries.purge, "purge_files", look)
    found = {(r["object_id"], r["file_status"]): (r["files"], r["staged_files"]) for r in gate_queries.purged_partitions(spark, f"{tmp_path}/t").collect()}
    assert len(tasks) > 1
    assert found == {(k, s): n for k in range(1, 6) for s, n in (("COMPLETED", (2, 2)), ("PURGED", (10, 0)))}


NOT_IN = [
    "SELECT id FROM staged WHERE a NOT IN (SELECT b FROM staged WHERE id < {n})",
    "SELECT id FROM staged WHERE staged.a NOT IN (SELECT b FROM staged WHERE id < {n}) OR id = 3",
    "SELECT id FROM staged WHERE NOT (a IN (SELECT b FROM staged WHERE id < {n} -- note\n)) OR id = 3",
    "SELECT id FROM staged WHERE NOT (a not in (SELECT b FROM staged WHERE id < {n}) OR id = 3)",
    "WITH s AS (SELECT * FROM staged WHERE 'é😀' <> '') SELECT id FROM s WHERE a NOT IN (SELECT b FROM s WHERE b NOT IN (SELECT id FROM s WHERE id > 7) AND id < {n}) OR id = 3",
    "SELECT id FROM staged WHERE id = 3 OR t NOT IN (SELECT b FROM staged WHERE id < {n})",
    "SELECT id FROM staged o WHERE id = 3 OR a NOT IN (SELECT b FROM staged i WHERE i.id = o.id AND id < {n})",
]


@pytest.mark.parametrize("statement", NOT_IN)
def test_not_in_by_cases(spark, rows, tmp_path, statement):
    data = [(1, 1, 2, "1"), (2, None, 4, None), (3, 2, 2, "2"), (4, 5, None, "5"), (5, 4, 9, "4"), (6, None, 9, "9")]
    spark.createDataFrame(data, "id int, a int, b int, t string").coalesce(1).write.parquet(f"{tmp_path}/staged")
    staged = spark.read.parquet(f"{tmp_path}/staged")
    staged.createOrReplaceTempView("staged")
    try:
        for n in (0, 4, 9):  # no rows, rows without a NULL, rows with one
            text = statement.format(n=n)
            with query_over(spark, text, {"staged": staged}) as found:
                assert rows(found) == rows(spark.sql(text)), text
    finally:
        spark.catalog.dropTempView("staged")
    for n, unknown in ((0, []), (4, [2, 6]), (9, [1, 2, 4, 6])):  # Spark itself takes what is unknown inside a condition for false
        with query_over(spark, f"SELECT id FROM staged WHERE (a NOT IN (SELECT b FROM staged WHERE id < {n})) IS NULL", {"staged": staged}) as found:
            assert rows(found) == [(i,) for i in unknown]


def test_not_in_beside_other_conditions_compares_equal_values_only(spark):
    staged = spark.range(100).selectExpr("IF(id % 10 = 0, NULL, id) AS id", "'x' AS email")
    statement = "SELECT * FROM staged WHERE id NOT IN (SELECT id FROM staged WHERE id > 50) OR email LIKE '%test%'"
    with query_over(spark, statement, {"staged": staged}) as found:
        plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ExistenceJoin" in plan and "NestedLoop" not in plan
    for kept in ("SELECT id FROM staged WHERE id NOT IN (1, 2)", "SELECT id FROM staged WHERE (id, id) NOT IN (SELECT 1, 2)"):
        assert by_cases(spark, kept) == kept
