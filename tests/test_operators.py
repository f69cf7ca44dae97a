from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidegate import Meta, schemas
from tidegate.operators import batches, changes, files, processes, readiness, sources, stage, targets

NOW = datetime(2002, 1, 30, 12)


def tables(spark, **data):
    """Control tables from lists of dicts; absent ones are empty."""
    made = {}
    for name, schema in schemas.META_SCHEMAS.items():
        made[name] = spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in data.get(name, [])], schema)
    return Meta(made)


def test_absent_names_give_no_row(spark):
    m = tables(spark, data_object=[{"object_id": 1, "object_name": "A"}])
    asked = spark.createDataFrame([("B",), (" A ",)], "object_name string")
    assert [tuple(r) for r in sources.object_ids(m, asked).collect()] == [("A", 1, 1)]
    assert files.unknown_files(m, spark.createDataFrame([("f",)], "filename string")).count() == 1


def test_two_meanings_of_active(spark):
    rows = [
        {"batch_id": 1, "batch_name": "d", "batch_status": "STARTED"},
        {"batch_id": 5, "batch_name": "d", "batch_status": "STARTED"},
        {"batch_id": 9, "batch_name": "d", "batch_status": "STARTED", "end_time": NOW},
    ]
    m = tables(spark, batch=rows)
    assert tuple(batches.first_active_batch(m).first()) == ("d", 1, 2)
    assert tuple(batches.current_batches(m).first()) == ("d", 9)
    assert spark.range(1).select(batches.current_batch_id(m, "none")).first()[0] == 0


def test_completed_batch_from_both_sides(spark):
    m = tables(
        spark,
        batch=[{"batch_id": i, "batch_name": f"b{i}", "batch_status": s} for i, s in ((1, "COMPLETED"), (2, "COMPLETED"), (3, "STARTED"))],
        data_file=[{"file_id": i, "filename": "f", "batch_id": i} for i in (1, 2, 3)],
        extract_data_file=[{"batch_id": 2, "extract_filename": "f"}],
    )
    out = batches.completed_batch_by_file(m, spark.createDataFrame([(" f",)], "filename string")).collect()
    assert sorted((r["direction"], r["batch_id"]) for r in out) == [("IN", 2), ("OUT", 2)]


def test_file_kept_once_when_batch_repeats(spark):
    m = tables(spark, batch=[{"batch_id": 1, "batch_status": "STARTED"}] * 2, data_file=[{"file_id": 4, "batch_id": 1}])
    assert files.files_by_id(m).count() == 1


def test_active_process_without_open_log(spark):
    m = tables(
        spark,
        process=[{"process_id": 1, "process_name": "a"}, {"process_id": 2, "process_name": "b"}],
        process_log=[{"process_log_id": 7, "process_id": 1}, {"process_log_id": 8, "process_id": 1, "end_time": NOW}],
    )
    out = {r["process_name"]: r["process_log_id"] for r in processes.active_process_logs(m).collect()}
    assert out == {"a": 7, "b": None}


def test_target_view_prefixes(spark):
    m = tables(
        spark,
        target=[{"target_id": 1, "target_name": "T"}, {"target_id": 2, "target_name": "U"}],
        target_view=[{"target_id": 1, "view_name": "v", "source_object_name": n} for n in ("vw_stg_abc", "VW__STG_ABC", "other")],
        data_object=[{"object_id": i, "object_name": n} for i, n in enumerate(("vw_stg_abc", "VW__STG_ABC", "other"))],
        source=[{"source_id": 5, "source_code": "Abc"}],
    )
    out = {(r["target_name"], r["source_object_name"]): r["source_id"] for r in targets.target_attributes(m).collect()}
    assert out == {("T", "vw_stg_abc"): 5, ("T", "VW__STG_ABC"): 5, ("T", "other"): None, ("U", None): None}


def test_datasource_roles_take_the_first(spark):
    cols = [(1, 3, "c", "ds_attrib_name"), (2, 1, "a", "ds_attrib_name"), (3, None, "n", "ds_attrib_value")]
    m = tables(
        spark,
        source_feed_column=[
            {"column_id": i, "source_id": 1, "ordinal_position": o, "column_name": n, "column_property": p} for i, o, n, p in cols
        ],
    )
    assert tuple(sources.datasource_roles(m).first())[:2] == (1, "a")


def test_key_node_pairs(spark):
    props = [("id", "master_key_node"), ("mail", "key_node"), ("x", None)]
    m = tables(
        spark,
        source=[{"source_id": 1, "source_code": "S"}],
        source_feed_column=[{"source_id": 1, "column_name": n, "column_property": p} for n, p in props],
    )
    assert [tuple(r) for r in sources.key_node_pairs(m).collect()] == [("S", "mail", "masterID", "mail", "id")]
    assert sources.key_node_pairs(m, with_isn=True, with_cr=True).count() == 6


def late_meta(spark):
    return tables(
        spark,
        batch=[{"batch_id": 10, "batch_status": "STARTED"}],
        source=[
            {"source_id": i, "source_code": f"s{i}", "source_type": t, "receipt_frequency": f}
            for i, t, f in ((1, "file", "DAILY"), (2, "a file x", " weekly"), (3, "file", "YEARLY"), (4, "file", " "), (5, "file", "DAILY"))
        ],
        data_object=[{"object_id": i, "required_ind": "Y"} for i in range(1, 6)],
        data_file=[
            {"file_id": 1, "object_id": 1, "batch_id": 9, "modified_date": datetime(2002, 1, 28), "stg_good_record_count": 0},
            {"file_id": 2, "object_id": 1, "batch_id": 10, "modified_date": datetime(2002, 1, 30), "stg_good_record_count": 0},
            {"file_id": 3, "object_id": 3, "batch_id": 9, "modified_date": datetime(1990, 1, 1), "stg_good_record_count": 3},
            {"file_id": 4, "object_id": 5, "batch_id": 9, "modified_date": datetime(2002, 1, 28), "stg_good_record_count": 3},
        ],
    )


def test_late_sources(spark, rows):
    m = late_meta(spark)
    shown = ["source_id", "current_batch_file_count", "expected_number_of_files"]
    assert rows(readiness.late_sources(m, NOW, 10), *shown) == [(1, 1, 2), (5, 0, 2)]
    assert rows(readiness.late_sources(m, NOW, skip_empty="y"), *shown) == [(5, 0, 2)]
    with pytest.raises(ValueError):
        readiness.late_sources(m, NOW, 10, "maybe")


def test_missing_counts_agree_with_detail(spark):
    m = tables(
        spark,
        batch=[{"batch_id": i, "batch_name": n} for i, n in ((1, "a"), (2, "a"), (3, "b"), (4, "none"))],
        source=[{"source_id": i, "source_code": f"s{i}", "category": c} for i, c in ((1, "a"), (2, "a"), (3, "b"), (4, None))],
        data_object=[{"object_id": i, "required_ind": "N" if i == 9 else "Y"} for i in range(1, 5)],
        data_file=[
            {"file_id": 1, "object_id": 1, "batch_id": 1, "stg_good_record_count": 5},
            {"file_id": 2, "object_id": 2, "batch_id": 1, "stg_good_record_count": 0},
            {"file_id": 3, "object_id": 3, "batch_id": 1, "stg_good_record_count": 5},
            {"file_id": 4, "object_id": 1, "batch_id": 2, "stg_good_record_count": None},
            {"file_id": 5, "object_id": 3, "batch_id": 3, "stg_good_record_count": 1},
        ],
    )
    detail = readiness.missing_required_files(m, m.batch)
    counted = {r["batch_id"]: r["count"] for r in detail.groupBy("batch_id").count().collect()}
    assert counted == {r["batch_id"]: r["missing_count"] for r in readiness.missing_required_counts(m).collect()} == {1: 1, 2: 2}


def test_delete_keeps_unknown(spark, rows):
    df = spark.createDataFrame([("Doe",), (None,), ("Roe",)], "last_name string")
    assert rows(changes.delete_where(df, F.col("last_name") == "Doe")) == [("Roe",), (None,)]


def test_fill_update(spark, rows):
    table = spark.createDataFrame([(1, "a", 5, NOW), (2, "b", 6, NOW)], "id long, s string, n int, t timestamp")
    new = spark.createDataFrame([(1, None, 9), (7, "z", 1)], "id long, s string, n long")
    out = changes.fill_update(table, new, "id", {"t": F.lit(datetime(2003, 1, 1))})
    assert out.schema == table.schema
    assert rows(out, "id", "s", "n") == [(1, "a", 9), (2, "b", 6)]
    assert {r["id"]: r["t"].year for r in out.collect()} == {1: 2003, 2: 2002}
    assert changes.changed_count(table, new, "id").first()[0] == 1
    with pytest.raises(ValueError):
        changes.fill_update(table, new.withColumn("q", F.lit(1)), "id")
    with pytest.raises(Exception, match="several changes"):
        changes.fill_update(table, new.union(new), "id").collect()


def test_insert_by_name(spark, rows):
    table = spark.createDataFrame([(1, "a")], "id long, s string")
    out = changes.insert_by_name(table, changes.constant_rows(table, [{"s": "b"}, {"id": 3}]))
    assert rows(out) == [(1, "a"), (3, None), (None, "b")]
    with pytest.raises(ValueError):
        changes.insert_by_name(table, spark.createDataFrame([(1,)], "x int"))


def test_load_history_takes_the_last_status_in_text_order(spark):
    log = [("t", 1, 2, "LOADED"), ("t", 1, 1, "PARTIALLY_LOADED"), ("t", 0, 4, "LOAD_FAILED"), ("u", 0, 4, "LOAD_FAILED"), ("u", 1, 1, "LOADED")]
    df = spark.createDataFrame(log, "table_name string, row_count long, row_parsed long, status string")
    out = {r["table_name"]: tuple(r)[1:] for r in stage.load_history(df).collect()}
    assert out["t"] == (2, 7, 5, "PARTIALLY_LOADED", "Staged", "Completed")
    assert out["u"] == (1, 5, 4, "LOAD_FAILED", "Error", "Failed")


def test_create_list_and_count_tables(spark, rows):
    schemas.create_tables(spark, "meta_test")
    schemas.create_tables(spark, "meta_test")
    spark.sql("CREATE TABLE IF NOT EXISTS meta_test.batch_new (x int) USING parquet")
    names = schemas.list_tables(spark, "meta_test")
    assert names == sorted(schemas.META_SCHEMAS)
    m = Meta.from_catalog(spark, "meta_test")
    assert rows(schemas.table_counts({n: getattr(m, n) for n in ("batch", "source")})) == [("batch", 0), ("source", 0)]
    with pytest.raises(AttributeError):
        m.nothing
    assert len(schemas.META_SCHEMAS) == 19 and len(schemas.META_SCHEMAS["data_file"]) == 20
