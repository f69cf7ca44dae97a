"""Receiving and staging real files."""

import gzip
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from test_operators import tables
from tidegate import schemas
from tidegate.functions.rules import FEATURES
from tidegate.operators import register, stage
from tidegate.operators.models import LinearScore
from tidegate.session import written
from tidegate.sources import delimited
from tidegate.sources.landing import list_files, plain_path

NOW = datetime(2002, 1, 30, 12)
MODEL = LinearScore(tuple(FEATURES), (1.0,) * 8, -2.0, 0.3)
FEED = [("customer_id", "BIGINT"), ("email", "VARCHAR"), ("phone", "varchar"), ("joined", "DATE"), ("paid", "DECIMAL"), ("odd", "GEOMETRY")]
HEADER = "customer_id,email,phone,joined,paid,odd"


def land(root, name, text, folder="a"):
    path = root / "Files" / folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())


def control(spark, objects=((1, "cust_%", "/Files/a"),), feed=FEED, source_feed=(), **extra):
    numbered = list(enumerate(feed, 1))
    return tables(
        spark,
        batch=[{"batch_id": 4, "batch_name": "daily_update", "batch_status": "STARTED"}],
        data_object=[
            {
                "object_id": i, "object_name": f"o{i}", "object_type": "file", "filename_pattern": p, "landing_directory": d,
                "column_delimiter": ",", "header_row_count": 1, "text_qualifier": '"', **extra,
            }
            for i, p, d in objects
        ],
        source=[{"source_id": i, "source_code": f"S{i}", "stage_name": f"STG_{i}"} for i, _, _ in objects],
        source_feed=list(source_feed),
        source_feed_column=[
            {"column_id": i, "source_id": s, "ordinal_position": i, "column_name": n, "data_type": t, "max_length": 10, "scale": 2}
            for s, _, _ in objects
            for i, (n, t) in numbered
        ],
    )


def received(spark, meta, root):
    rows = register.receive(meta, list_files(spark, f"{root}/Files"), "daily_update", NOW)
    return meta.with_tables(data_file=written(meta.data_file.unionByName(rows), "registry"))


def test_receive(spark, tmp_path, rows):
    for folder, name in (("a", "cust_1.csv"), ("a/deep", "cust_2.csv"), ("a", "cust_old.csv"), ("a", "custX.csv"), ("b", "cust_9.csv"), ("a", "Cust_1.csv")):
        land(tmp_path, name, "x\n", folder)
    m = control(spark)
    old = spark.createDataFrame(
        [tuple({"file_id": 7, "filename": "cust_old.csv"}.get(f.name) for f in schemas.META_SCHEMAS["data_file"])],
        schemas.META_SCHEMAS["data_file"],
    )
    m = m.with_tables(data_file=old)
    out = register.receive(m, list_files(spark, f"{tmp_path}/Files"), "daily_update", NOW)
    assert out.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.META_SCHEMAS["data_file"]]
    shown = ["file_id", "object_id", "filename", "file_path", "file_status", "batch_id"]
    assert rows(out, *shown) == [
        (8, 1, "cust_1.csv", "/Files/a", "REGISTERED", 4),
        (9, 1, "cust_2.csv", "/Files/a/deep", "REGISTERED", 4),
    ]
    again = register.receive(m.with_tables(data_file=old.unionByName(out)), list_files(spark, f"{tmp_path}/Files"), "daily_update", NOW)
    assert again.count() == 0


def test_receive_needs_an_active_batch(spark, tmp_path):
    land(tmp_path, "cust_1.csv", "x\n")
    with pytest.raises(ValueError):
        register.receive(control(spark), list_files(spark, f"{tmp_path}/Files"), "other", NOW)


def test_lowest_object_takes_a_contested_name(spark, tmp_path, rows):
    land(tmp_path, "cust_1.csv", "x\n", "a")
    land(tmp_path, "cust_1.csv", "x\n", "a/copy")
    m = control(spark, objects=((2, "cust%", "/Files/a/"), (1, "cust_?.csv", "/Files/a"), (3, "%", "/Files")))
    files = register.new_files(m, list_files(spark, f"{tmp_path}/Files"))
    assert rows(files, "object_id", "directory") == [(1, "/Files/a"), (1, "/Files/a/copy")]
    assert rows(register.repeated_names(files)) == [("cust_1.csv", 2)]


def test_open_batch(spark):
    m = control(spark)
    row = register.open_batch(m, "daily_update", NOW, message="begin")
    assert row.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.META_SCHEMAS["batch"]]
    assert row.first()["batch_id"] == 5 and row.first()["end_time"] is None
    with pytest.raises(ValueError):
        register.open_batch(m, "", NOW)


def test_stage_many_files(spark, tmp_path, rows):
    land(tmp_path, "cust_1.csv", f"{HEADER}\n1,a@test.com,0000000000,2001-02-03,1.005,x\nabc,,411,bad,9999999999,\n")
    land(tmp_path, "cust_2.csv", '"PHONE",odd,"Email",customer_id,joined,paid\n5,y,"b,b@x.org",2,2001-01-01,3\n')
    land(tmp_path, "cust_3.csv", HEADER + ",extra\n1,2,3,4,5,6,7\n")
    land(tmp_path, "cust_4.csv", HEADER + "\n")
    land(tmp_path, "cust_5.csv", "")  # a listing leaves files without content out
    land(tmp_path, "cust_6.csv", "customer_id,email\n1,2\n")
    land(tmp_path, "cust_7.csv", HEADER.replace("email", "phone") + "\n")
    land(tmp_path, "cust_8.csv.gz", gzip.compress(f"{HEADER}\n8,z@x.org,1,,,\n".encode()))
    m = received(spark, control(spark), tmp_path)
    out = f"{tmp_path}/bronze"
    outcomes = stage.stage_files(m, f"{tmp_path}/Files", out, MODEL)
    found = {r["path"].rsplit("/", 1)[1]: r for r in outcomes.collect()}
    assert {n: r["row_count"] for n, r in found.items()} == {
        "cust_1.csv": 2, "cust_2.csv": 1, "cust_3.csv": None, "cust_4.csv": 0, "cust_6.csv": None,
        "cust_7.csv": None, "cust_8.csv.gz": 1,
    }
    assert "1 extra" in found["cust_3.csv"]["reject_reason"] and "4 missing" in found["cust_6.csv"]["reject_reason"]
    assert "1 repeated" in found["cust_7.csv"]["reject_reason"]
    staged = stage.read_stage(spark, out, "STG_1")
    assert staged.columns == [n for n, _ in FEED] + ["real_customer_score", "stage_name", "file_id"]
    kinds = {f.name: f.dataType.simpleString() for f in staged.schema}
    assert (kinds["customer_id"], kinds["joined"], kinds["paid"], kinds["odd"], kinds["real_customer_score"]) == (
        "bigint", "date", "decimal(10,2)", "string", "float",
    )
    shown = rows(staged.filter(F.col("file_id").isin(1, 2)), "customer_id", "email", "phone", "joined", "paid", "odd")
    assert [tuple(str(v) for v in r) for r in shown] == [
        ("1", "a@test.com", "0000000000", "2001-02-03", "1.01", "x"),
        ("2", "b,b@x.org", "5", "2001-01-01", "3.00", "y"),
        ("None", "None", "411", "None", "None", "None"),
    ]
    registry = stage.registry_after_load(m.data_file, outcomes, F.lit(NOW))
    status = {r["filename"]: (r["file_status"], r["row_count"], r["stg_good_record_count"]) for r in registry.collect()}
    assert status["cust_1.csv"] == ("COMPLETED", 2, 2) and status["cust_4.csv"] == ("COMPLETED", 0, 0)
    assert status["cust_3.csv"] == ("REGISTERED", None, None)

    before = staged.count()
    stage.stage_files(m, f"{tmp_path}/Files", out, MODEL)
    assert stage.read_stage(spark, out, "STG_1").count() == before

    # A reload with a header only leaves no rows behind, and its count says so.
    land(tmp_path, "cust_1.csv", f"{HEADER}\n")
    again = stage.stage_files(m, f"{tmp_path}/Files", out, MODEL)
    assert {r["path"].rsplit("/", 1)[1]: r["row_count"] for r in again.collect()}["cust_1.csv"] == 0
    assert stage.read_stage(spark, out, "STG_1").count() == before - 2


def test_plain_load_keeps_spaces_and_qualifiers(spark, tmp_path, rows):
    feed = [("id", "BIGINT"), ("name", "VARCHAR")]
    land(tmp_path, "cust_1.csv", "id,name\n1, \n2,\n")
    m = received(spark, control(spark, feed=feed), tmp_path)
    out = f"{tmp_path}/plain"
    done = stage.stage_files(m, f"{tmp_path}/Files", out)
    assert rows(stage.read_stage(spark, out), "id", "name") == [(1, " "), (2, None)]
    registry = stage.registry_after_load(m.data_file, done, F.lit(NOW)).first()
    assert (registry["row_count"], registry["fm_good_record_count"], registry["fm_error_record_count"]) == (2, 2, 0)

    land(tmp_path, "cust_1.csv", "'id','name'\n'1','a,b'\n")
    m = received(spark, control(spark, feed=feed, text_qualifier="'"), tmp_path)
    stage.stage_files(m, f"{tmp_path}/Files", f"{tmp_path}/quoted", full_options=True)
    assert rows(stage.read_stage(spark, f"{tmp_path}/quoted"), "id", "name") == [(1, "a,b")]


def test_header_in_another_encoding(spark, tmp_path, rows):
    land(tmp_path, "cust_1.csv", "größe,name\n1,é\n".encode("iso-8859-1"))
    m = received(spark, control(spark, feed=[("größe", "BIGINT"), ("name", "VARCHAR")], file_encoding="ISO-8859-1"), tmp_path)
    stage.stage_files(m, f"{tmp_path}/Files", f"{tmp_path}/out", full_options=True)
    assert rows(stage.read_stage(spark, f"{tmp_path}/out"), "größe", "name") == [(1, "é")]


def test_decimal_needs_a_length(spark, tmp_path):
    land(tmp_path, "cust_1.csv", "id,name\n1,2\n")
    m = received(spark, control(spark, feed=[("id", "BIGINT"), ("name", "DECIMAL")]), tmp_path)
    m = m.with_tables(source_feed_column=m.source_feed_column.withColumn("max_length", F.lit(None).cast("bigint")))
    assert "without a length" in stage.stage_files(m, f"{tmp_path}/Files", f"{tmp_path}/out").first()["reject_reason"]


def test_gzip_file(spark, tmp_path):
    land(tmp_path, "cust_8.csv.gz", gzip.compress(f"{HEADER}\n8,z@x.org,1,,,\n".encode()))
    m = received(spark, control(spark), tmp_path)
    outcome = stage.stage_files(m, f"{tmp_path}/Files", f"{tmp_path}/bronze").first()
    assert (outcome["reject_reason"], outcome["row_count"]) == (None, 1)


def test_one_bad_file_does_not_stop_the_rest(spark, tmp_path):
    land(tmp_path, "cust_1.csv", f"{HEADER}\n1,a,b,2001-02-03,1,x\n")
    land(tmp_path, "cust_2.csv.gz", gzip.compress(f"{HEADER}\n8,z@x.org,1,,,\n".encode() * 5000)[:-40])
    land(tmp_path, "cust_3.csv", f"{HEADER}\n3,a,b,2001-02-03,1,x\n")
    m = received(spark, control(spark), tmp_path)
    outcomes = stage.stage_files(m, f"{tmp_path}/Files", f"{tmp_path}/bronze").collect()
    assert sorted((r["path"].rsplit("/", 1)[1], r["row_count"]) for r in outcomes if not r["reject_reason"]) == [
        ("cust_1.csv", 1), ("cust_3.csv", 1),
    ]


def test_unusual_names_and_missing_source(spark, tmp_path):
    land(tmp_path, "cust_a b+%41.csv", f"{HEADER}\n1,a,b,2001-02-03,1,x\n")
    m = received(spark, control(spark), tmp_path)
    stray = {"file_id": 99, "object_id": 77, "file_status": "REGISTERED", "filename": "f.csv", "file_path": "/Files/a"}
    row = tuple(stray.get(f.name) for f in schemas.META_SCHEMAS["data_file"])
    gone = tuple({**stray, "file_id": 98, "object_id": 1}.get(f.name) for f in schemas.META_SCHEMAS["data_file"])
    m = m.with_tables(data_file=m.data_file.unionByName(spark.createDataFrame([row, gone], schemas.META_SCHEMAS["data_file"])))
    out = {r["file_id"]: r for r in stage.stage_files(m, f"{tmp_path}/Files", f"{tmp_path}/bronze").collect()}
    assert out[1]["row_count"] == 1 and out[99]["reject_reason"] == "No source attributes found."
    assert out[98]["reject_reason"] == "The file cannot be read."
    paths = spark.createDataFrame([("file:///x/a%20b+%2541",), ("file:/x/a",)], "p string")
    assert [r[0] for r in paths.select(plain_path(F.col("p"))).collect()] == ["file:/x/a b+%41", "file:/x/a"]


SAMPLE = '"id","company","phone"\n"1","Smith, Inc","5"\n"2",""Robinson"," Clay and Santiago"","6"\n"3","Plain","7"\n'
SAMPLE_FEED = [("id", "BIGINT"), ("company", "VARCHAR"), ("phone", "VARCHAR")]


def test_malformed_quote_shifts_by_default(spark, tmp_path, rows):
    land(tmp_path, "cust_1.csv", SAMPLE)
    m = received(spark, control(spark, feed=SAMPLE_FEED), tmp_path)
    stage.stage_files(m, f"{tmp_path}/Files", f"{tmp_path}/bronze")
    staged = {r["id"]: r for r in stage.read_stage(spark, f"{tmp_path}/bronze").collect()}
    assert len(staged) == 3 and staged[1]["company"] == "Smith, Inc" and staged[2]["phone"] != "6"


def test_bad_records_are_kept_apart(spark, tmp_path):
    land(tmp_path, "cust_1.csv", SAMPLE + "4,short\n")
    feed = [{"source_id": 1, "error_on_column_count_mismatch": "TRUE", "add_record_id_ind": "Y", "target_object_name": "T"}]
    m = control(spark, feed=SAMPLE_FEED, source_feed=feed)
    m = received(spark, m, tmp_path)
    outcome = stage.stage_files(m, f"{tmp_path}/Files", f"{tmp_path}/bronze", full_options=True)
    assert tuple(outcome.select("row_count", "error_row_count").first()) == (4, 2)
    staged = stage.read_stage(spark, f"{tmp_path}/bronze").orderBy("record_id").collect()
    assert [r["record_id"] for r in staged] == [1, 2, 3, 4]
    assert [r[delimited.BAD_RECORD] is None for r in staged] == [True, False, True, False]
    after = stage.registry_after_load(m.data_file, outcome, F.lit(NOW), "STAGED").first()
    assert (after["row_count"], after["fm_error_record_count"], after["stg_good_record_count"], after["file_status"]) == (4, 2, 2, "STAGED")
    strict = stage.stage_files(m, f"{tmp_path}/Files", f"{tmp_path}/bronze2", full_options=True, strict=True).first()
    assert "no TARGET record" in strict["reject_reason"]


def test_fixed_width_stage(spark, tmp_path, rows):
    land(tmp_path, "cust_1.txt", "0000000007 ann  \n      abc  bob  \n")
    m = control(spark, feed=[("id", "BIGINT"), ("name", "VARCHAR")], file_format="FIXED-WIDTH")
    cut = m.source_feed_column.withColumns(
        {
            "fixed_width_start_position": F.when(F.col("column_name") == "id", 1).otherwise(11).cast("long"),
            "fixed_width_length": F.when(F.col("column_name") == "id", 10).otherwise(6).cast("long"),
        }
    )
    m = m.with_tables(source_feed_column=cut, data_object=m.data_object.withColumn("header_row_count", F.lit(0).cast("long")))
    m = received(spark, m, tmp_path)
    outcome = stage.stage_files(m, f"{tmp_path}/Files", f"{tmp_path}/bronze", full_options=True).first()
    assert (outcome["reject_reason"], outcome["row_count"]) == (None, 2)
    assert rows(stage.read_stage(spark, f"{tmp_path}/bronze"), "id", "name") == [(7, "ann"), (None, "bob")]


def test_reader_options():
    row = {
        "column_delimiter": "\t", "text_qualifier": "none", "escape_char": "N/A", "header_row_count": 2, "null_if": "'-','?'",
        "trim_space": "TRUE", "file_encoding": None, "date_format": "AUTO", "timestamp_format": "yyyy", "on_error": "ABORT_STATEMENT",
    }
    options = delimited.feed_options(row)
    assert options == delimited.FeedOptions(
        delimiter="\t", quote=None, header_rows=2, nulls=("-", "?"), trim=True, timestamp_format="yyyy", fail_on_bad=True
    )
    assert delimited.parse_nulls("n/a") == ()
    assert delimited.parse_nulls("'\"\"','',' '") == ('""', "", " ")


def test_fail_on_bad(spark, tmp_path):
    (tmp_path / "f.csv").write_text("1,2\n1,2,3\n")
    rows = delimited.read_delimited(spark, [str(tmp_path)], ["a", "b"], delimited.FeedOptions(header_rows=0, fail_on_bad=True))
    with pytest.raises(Exception, match="MALFORMED"):
        rows.collect()


def test_no_delimiter_reads_one_column(spark, tmp_path, rows):
    (tmp_path / "f.txt").write_text("a,b|c\n")
    options = delimited.FeedOptions(delimiter=None, header_rows=0)
    assert rows(delimited.read_delimited(spark, [str(tmp_path)], ["line"], options), "line") == [("a,b|c",)]
    with pytest.raises(ValueError):
        delimited.read_delimited(spark, [str(tmp_path)], ["a", "b"], options)


def test_stage_schema(spark):
    columns = [delimited.FeedColumn("A", "char", 5), delimited.FeedColumn("b", "Decimal", 9, 3), delimited.FeedColumn("c", "long")]
    schema = stage.stage_schema(columns, record_id=True)
    assert schema.simpleString() == "struct<a:string,b:decimal(9,3),c:bigint,real_customer_score:float,record_id:bigint>"
    spark.sql("CREATE DATABASE IF NOT EXISTS bronze_test")
    stage.create_stage_table(spark, "bronze_test.stg_x", schema)
    stage.create_stage_table(spark, "bronze_test.stg_x", schema)
    assert spark.table("bronze_test.stg_x").schema == schema


def test_labelled_customers_stay_text(spark, tmp_path):
    (tmp_path / "t.csv").write_text('first_name,Phone,zip_code,date_of_birth,label\nAnn,0000000000,01794,1900-01-01,0\n"B, C",5,00000,,1\n')
    rows = {r["first_name"]: r for r in delimited.read_labelled_customers(spark, str(tmp_path / "t.csv")).collect()}
    assert (rows["Ann"]["phone"], rows["Ann"]["zip_code"], rows["Ann"]["date_of_birth"], rows["Ann"]["label"]) == (
        "0000000000", "01794", "1900-01-01", 0,
    )
    assert rows["B, C"]["label"] == 1


def test_header_reader_travels_by_value():
    """Executors need not have this package."""
    import subprocess
    import sys

    from pyspark import cloudpickle
    from tidegate.sources import headers

    captured = []
    original, headers.F.pandas_udf = headers.F.pandas_udf, lambda f, _: captured.append(f)
    try:
        headers._line_reader()
    finally:
        headers.F.pandas_udf = original
    code = "import sys, pickle, pandas as pd; f = pickle.loads(sys.stdin.buffer.read()); print(f(pd.Series(['file:/etc/hostname', '/none']), pd.Series(['UTF-8', 'UTF-8'])).isna().tolist())"
    done = subprocess.run([sys.executable, "-I", "-c", code], input=cloudpickle.dumps(captured[0]), capture_output=True, cwd="/")
    assert done.stdout.decode().strip() == "[False, True]", done.stderr.decode()[-500:]


def test_headers_by_scan_equal_headers_by_seek(spark, tmp_path, monkeypatch):
    from tidegate.sources import headers

    land(tmp_path, "a b.csv", "\ufeffid,name\r\n1,x\r\n")
    land(tmp_path, "big.csv", "long,header\n" + "1,2\n" * 40000)
    land(tmp_path, "z.csv.gz", gzip.compress(b"zip,ped\n1,2\n"))
    root = f"{tmp_path}/Files"
    listed = list_files(spark, root).select("path")
    files = listed.unionByName(spark.createDataFrame([(f"file:{root}/a/gone.csv",)], "path string"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        seek = {tuple(r) for r in headers.first_lines(files, root).collect()}
        monkeypatch.setattr(headers, "qualified", lambda *_: "far://away")
        scan = {tuple(r) for r in headers.first_lines(files, root).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seek == scan
    assert {h for _, h in seek} == {"id,name", "long,header", "zip,ped", None}
