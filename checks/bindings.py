"""The given tables seen as control tables and customers (Spark side)."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate import Meta

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(number: Column, *values: str | None) -> Column:
    """The value at position ``number``; the last one for all higher numbers."""
    case = None
    for i, v in enumerate(values[:-1]):
        case = F.when(number == i, F.lit(v)) if case is None else case.when(number == i, F.lit(v))
    return case.otherwise(F.lit(values[-1])).cast("string")


def text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def supplier_name() -> Column:
    return F.replace(F.col("s_name"), F.lit("#"), F.lit("_"))


def source(spark, d):
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    code = F.upper(supplier_name())
    return table(spark, d, "supplier").select(
        (k + 1).alias("source_id"),
        (n + 1).cast("long").alias("provider_id"),
        code.alias("source_code"),
        F.when(k % 10 == 9, "table").otherwise("file").alias("source_type"),
        pick(k % 6, "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "CDI").alias("category"),
        F.concat(F.lit("STG_"), code).alias("stage_name"),
        pick(n % 6, "DAILY", "weekly", "Monthly", "QUARTERLY", "", None).alias("receipt_frequency"),
        pick(k % 4, "AGE", "", None).alias("purge_type"),
    )


def data_object(spark, d):
    k = F.col("s_suppkey")
    name = supplier_name()
    return table(spark, d, "supplier").select(
        (k + 1).alias("object_id"),
        F.when(k % 3 == 0, F.concat(F.lit("VW_STG_"), F.upper(name)))
        .when(k % 3 == 1, F.concat(F.lit("VW__STG_"), F.lower(name)))
        .otherwise(F.concat(F.upper(name), F.lit("_FILE")))
        .alias("object_name"),
        F.when(k % 3 == 2, "file").otherwise("view").alias("object_type"),
        F.concat(F.lower(name), F.lit("%")).alias("filename_pattern"),
        F.when(k % 5 != 0, ",").alias("column_delimiter"),
        F.lit("LF").alias("row_delimiter"),
        F.when(k % 4 != 0, 1).cast("long").alias("header_row_count"),
        F.when(k % 7 != 0, 9).cast("long").alias("field_count"),
        pick(k % 3, "delimited", " fixed ", None).alias("file_format"),
        pick(k % 5, "", "n/a", "stg").alias("schema_name"),
        F.when(k % 2 == 0, "Y").otherwise("N").alias("required_ind"),
        F.concat(F.lit("/Files/src"), text(k)).alias("landing_directory"),
    )


def batch(spark, d):
    status = F.col("o_orderstatus")
    return table(spark, d, "orders").select(
        (F.col("o_orderkey") + 1).alias("batch_id"),
        F.col("o_orderpriority").alias("batch_name"),
        F.when(status == "O", "STARTED").when(status == "F", "COMPLETED").otherwise("FAILED").alias("batch_status"),
        F.col("o_orderdate").alias("start_time"),
        F.when(status != "O", F.col("o_orderdate")).alias("end_time"),
    )


def data_file(spark, d):
    grouped = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_suppkey").alias("k"),
        # One-letter codes as numbers, which keeps this a hash aggregate.
        F.char(F.min(F.ascii("l_returnflag"))).alias("flag"),
        F.char(F.max(F.ascii("l_linestatus"))).alias("status"),
        F.sum("l_quantity").cast("long").alias("quantity"),
        F.max("l_shipdate").alias("modified_date"),
    )
    file_id = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return grouped.select(
        file_id.alias("file_id"),
        (F.col("k") + 1).alias("object_id"),
        (F.col("l_orderkey") + 1).alias("batch_id"),
        F.when(F.col("flag") == "N", "REGISTERED").when(F.col("flag") == "R", "COMPLETED").otherwise("staged").alias("file_status"),
        F.concat(F.lit("supplier_"), F.lpad(text("k"), 9, "0"), F.lit("_"), text(file_id), F.lit(".csv")).alias("filename"),
        F.when(F.col("flag") != "A", F.col("quantity")).alias("expected_row_count"),
        F.col("quantity").alias("row_count"),
        F.when(F.col("status") == "F", 0).otherwise(F.col("quantity")).cast("long").alias("stg_good_record_count"),
        F.when(F.col("flag") != "N", F.col("quantity")).alias("fm_good_record_count"),
        F.when(F.col("flag") != "N", 0).cast("long").alias("fm_error_record_count"),
        F.concat(F.lit("/Files/src"), text("k")).alias("file_path"),
        "modified_date",
    )


def target(spark, d):
    p = F.col("p_partkey")
    return table(spark, d, "part").select(
        (p + 1).alias("target_id"),
        F.concat(F.lit("TGT_"), text(p)).alias("target_name"),
        pick(F.col("p_size") % 3, "AGE", "", None).alias("purge_type"),
        F.col("p_size").cast("long").alias("purge_max_length"),
    )


def target_view(spark, d):
    p = F.col("p_partkey")
    return table(spark, d, "part").select(
        (p + 1).alias("target_id"),
        F.concat(F.lit("VW_"), text(p)).alias("view_name"),
        F.concat(
            F.when(p % 2 == 0, "VW_STG_SUPPLIER_").otherwise("VW__STG_supplier_"), F.lpad(text(p % 60), 9, "0")
        ).alias("source_object_name"),
        pick(p % 3, "indiv_key", "", None).alias("indiv_id_change_col"),
        F.when(p % 5 == 0, "addr_key").otherwise("").alias("add_id_change_col"),
        F.when(p % 7 == 0, "house_key").alias("house_id_change_col"),
        F.when(p % 11 == 0, "site_key").otherwise("").alias("site_id_change_col"),
    )


# Declared columns of every source: ordinal, name, type, length, start, and property for even and odd sources.
FEED = [
    (1, "customer_id", "BIGINT", None, 1, 20, "master_key_node", "ds_natural_key"),
    (2, "email", "VARCHAR", 50, 21, 50, "key_node", "ds_attrib_name"),
    (3, "phone", "VARCHAR", 20, 71, 20, "key_node", "ds_attrib_value"),
    (4, "origin", "VARCHAR", 10, 91, 10, "", "ds_attrib_datatype"),
]


def source_feed_column(spark, d):
    k = F.col("s_suppkey")
    columns = F.array(
        *[
            F.struct(
                F.lit(n).cast("long").alias("n"),
                F.lit(name).alias("column_name"),
                F.lit(kind).alias("data_type"),
                F.lit(size).cast("long").alias("max_length"),
                F.lit(start).cast("long").alias("start"),
                F.lit(length).cast("long").alias("length"),
                F.when(k % 2 == 0, even).otherwise(odd).alias("column_property"),
            )
            for n, name, kind, size, start, length, even, odd in FEED
        ]
    )
    rows = table(spark, d, "supplier").select(k, F.explode(columns).alias("c"))
    return rows.select(
        (k * 10 + F.col("c.n")).alias("column_id"),
        (k + 1).alias("source_id"),
        F.col("c.n").alias("ordinal_position"),
        "c.column_name",
        "c.data_type",
        "c.max_length",
        F.lit(None).cast("long").alias("scale"),
        F.col("c.start").alias("fixed_width_start_position"),
        F.col("c.length").alias("fixed_width_length"),
        "c.column_property",
    )


def customers(spark, d):
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    return table(spark, d, "customer").select(
        k.alias("customer_id"),
        F.when(k % 13 == 0, "Test")
        .when(k % 13 == 1, "Mickey")
        .when(k % 13 != 2, F.replace(F.col("c_name"), F.lit("#"), F.lit("")))
        .alias("first_name"),
        F.when(k % 7 == 0, "Null").otherwise(F.concat(F.lit("N"), text("c_nationkey"))).alias("last_name"),
        F.when(k % 5 == 0, "admin@null.com")
        .when(k % 5 != 1, F.concat(F.lower(seg), text(k), F.lit("@mail.com")))
        .alias("email"),
        F.when(k % 9 == 0, "0000000000")
        .when(k % 9 == 1, "411")
        .otherwise(F.concat(F.lit("5"), F.lpad(text(k), 9, "0")))
        .alias("phone"),
        F.when(k % 11 == 0, "1900-01-01").when(k % 11 == 1, "1/1/1900").otherwise("1980-06-15").alias("date_of_birth"),
        F.when(k % 6 == 0, "123 Test St")
        .when(k % 6 == 1, "N/A")
        .otherwise(F.concat(text(k), F.lit(" "), seg, F.lit(" Rd")))
        .alias("address"),
        F.when(k % 8 == 0, "00000")
        .when(k % 8 == 1, "99999")
        .otherwise(F.lpad(text(F.col("c_nationkey") * 977), 5, "0"))
        .alias("zip_code"),
        F.when(k % 10 == 0, "TestCorp").otherwise(seg).alias("company_name"),
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("label"),
    )


def provider(spark, d):
    return table(spark, d, "nation").select(
        (F.col("n_nationkey") + 1).cast("long").alias("provider_id"),
        F.col("n_name").alias("provider_name"),
        F.upper("n_name").alias("provider_code"),
    )


def receiver(spark, d):
    return table(spark, d, "region").select(
        (F.col("r_regionkey") + 1).cast("long").alias("receiver_id"),
        F.col("r_name").alias("receiver_name"),
        F.upper("r_name").alias("receiver_code"),
    )


def process_number(kind: Column) -> Column:
    numbered = F.when(kind == "view", 1).when(kind == "click", 2).when(kind == "purchase", 3).when(kind == "signup", 4)
    return numbered.otherwise(5).cast("long")


def process(spark, d):
    kinds = table(spark, d, "events").select("event_type").distinct()
    return kinds.select(process_number(F.col("event_type")).alias("process_id"), F.col("event_type").alias("process_name"))


def process_log(spark, d):
    kind = F.col("event_type")
    return table(spark, d, "events").select(
        (F.col("event_id") + 1).alias("process_log_id"),
        process_number(kind).alias("process_id"),
        F.col("ts").alias("start_time"),
        F.when(F.col("user_id") % 10 != 0, F.col("ts")).alias("end_time"),
        F.floor("value").cast("long").alias("inserted_rows"),
        F.when(kind == "error", "FAILED").otherwise("COMPLETED").alias("status"),
    )


def extract_data_file(spark, d):
    return data_file(spark, d).filter(F.col("file_id") % 4 == 0).select(
        (F.col("batch_id") + 1).alias("batch_id"), F.col("filename").alias("extract_filename")
    )


def source_feed(spark, d):
    s = F.col("source_id")
    return source(spark, d).filter(s % 5 != 0).select(
        s,
        F.concat(F.lit("TGT_"), text(s - 1)).alias("target_object_name"),
        F.when(s % 2 == 0, "Y").alias("add_record_id_ind"),
        pick(s % 3, "N/A", " none ", None).alias("null_if"),
        pick(s % 4, "gzip", "NONE", None).alias("compression_str"),
        pick(s % 3, "AUTO", "", "yyyy-MM-dd").alias("date_format"),
        pick(s % 4, "none", "TRUE", None).alias("trim_space"),
        pick(s % 6, "NONE", "none", ".gz", "part%", None).alias("split_filename_pattern"),
        pick(s % 5, "None", "N/A", "~", None).alias("escape_char"),
        pick(s % 3, "", "abort", None).alias("on_error"),
    )


def source_view_incremental(spark, d):
    return source(spark, d).filter(F.col("source_id") % 3 == 0).select(
        "source_id", "source_code", F.lit("modified_date").alias("column_name")
    )


def target_view_column_override(spark, d):
    overrides = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.lit(e).alias("transformation_sql"))
            for c, e in (("email", "lower(email)"), ("Phone", "trim(phone)"))
        ]
    )
    views = target_view(spark, d).filter(F.col("target_id") % 4 == 0)
    return views.select("view_name", "target_id", F.explode(overrides).alias("o")).select(
        "view_name", "o.column_name", "target_id", "o.transformation_sql"
    )


def extract_config(spark, d):
    return table(spark, d, "part").select(
        (F.col("p_partkey") + 1).alias("extract_id"),
        F.col("p_name").alias("extract_name"),
        F.lower("p_type").alias("extract_type"),
    )


BINDINGS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        source,
        data_object,
        batch,
        data_file,
        target,
        target_view,
        source_feed_column,
        provider,
        receiver,
        process,
        process_log,
        extract_data_file,
        source_feed,
        source_view_incremental,
        target_view_column_override,
        extract_config,
    )
}


def meta(spark: SparkSession, folder: str) -> Meta:
    return Meta({name: (lambda f=f: f(spark, folder)) for name, f in BINDINGS.items()})
