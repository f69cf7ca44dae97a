"""What the control tables declare about a target, and sources and tables that no other query goes through."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks.bindings import customers, meta, table
from checks.registry import query
from tidegate import schemas
from tidegate.operators import declared, stage
from tidegate.session import scratch_path
from tidegate.sources.delimited import FeedColumn, read_labelled_customers
from tidegate.sources.reference_lists import read_json_list


@query(
    "",
    """SELECT * EXCLUDE (place) FROM (SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC) AS place FROM lineitem) WHERE place = 1""",
)
def latest_by_natural_key(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    return declared.latest_rows(rows, ["l_orderkey"], "l_shipdate desc, l_linenumber desc")


@query(
    "",
    """SELECT * EXCLUDE (place) FROM (SELECT o_custkey, o_orderkey, o_orderdate,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS place FROM orders) WHERE place = 1""",
)
def latest_mixed_order(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return declared.latest_rows(rows, ["o_custkey"], "o_orderdate desc, o_orderkey")


@query("", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' - INTERVAL 30 MONTH")
def retained_orders(spark, d):
    return declared.retained_rows(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", 30, "MONTHS", datetime(1998, 1, 1))


LIMITS = [FeedColumn("p_name", "VARCHAR", 10), FeedColumn("p_brand", "VARCHAR", 7), FeedColumn("p_size", "BIGINT", 1)]


@query(
    "",
    """SELECT p_partkey, left(p_name, 10) AS p_name, left(p_brand, 7) AS p_brand, p_size,
  concat_ws(',', CASE WHEN length(p_name) > 10 THEN 'p_name' END, CASE WHEN length(p_brand) > 7 THEN 'p_brand' END) AS too_long FROM part""",
)
def enforced_lengths(spark, d):
    rows = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    return declared.truncated(rows.withColumn("too_long", F.array_join(declared.too_long(LIMITS), ",")), LIMITS)


@query(
    "data_file",
    """SELECT file_id, object_id FROM (SELECT file_id, object_id, row_count, file_id % 5 AS bad, object_id % 3 * 5 AS pct FROM data_file
  WHERE file_status = 'REGISTERED' AND object_id % 4 <> 0) WHERE 100 * bad > pct * row_count""",
)
def files_over_threshold(spark, d):
    files = stage.registered_files(meta(spark, d))
    outcomes = files.select("file_id", "object_id", "row_count", (F.col("file_id") % 5).alias("error_row_count"))
    limits = meta(spark, d).data_file.select("object_id").distinct()
    pct = F.when(F.col("object_id") % 4 != 0, F.col("object_id") % 3 * 5).alias("error_row_threshold_pct")
    return declared.over_threshold(outcomes, limits.select("object_id", pct)).select("file_id", "object_id")


@query("", "SELECT c_custkey, upper(c_name) AS c_name, CAST(c_nationkey + 100 AS BIGINT) AS c_nationkey FROM customer")
def overridden_columns(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    return declared.overridden(rows, {"c_name": "upper(c_name)", "c_nationkey": "CAST(c_nationkey + 100 AS BIGINT)"})


@query("", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1997-06-30'")
def incremental_pull(spark, d):
    return declared.pulled_since(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", datetime(1997, 6, 30))


@query("", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer")
def extract_files(spark, d):
    """Customers written as an extract says, and read back as text."""
    config = {"location": scratch_path(spark, "extract"), "file_name": "customers", "format_type": "DELIM", "field_delimiter": "|",
              "header": "true", "compression_str": "gzip", "file_name_has_datetime_ind": "Y", "null_if": "N/A"}
    path = declared.extract(table(spark, d, "customer").select("c_custkey", "c_name"), config, datetime(2002, 1, 30))
    return spark.read.option("sep", "|").option("header", True).csv(path)


@query(
    "",
    """SELECT * EXCLUDE (place) FROM (SELECT o_custkey, o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey
  ORDER BY CASE WHEN o_orderpriority < '4' THEN CAST(left(o_orderpriority, 1) AS INTEGER) END NULLS LAST, o_orderkey) AS place FROM orders)
WHERE place = 1""",
)
def best_ranked_source(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    ranks = rows.select("o_orderpriority").distinct().filter("o_orderpriority < '4'")
    ranks = ranks.select("o_orderpriority", F.left("o_orderpriority", F.lit(1)).cast("int").alias("rank"))
    return declared.best_source(rows, ["o_custkey"], "o_orderpriority", ranks, "o_orderkey")


@query("customers", "SELECT * FROM customers")
def labelled_rows(spark, d):
    """Training rows written as CSV and read back: text as it was, the label as a number."""
    path = scratch_path(spark, "labelled")
    customers(spark, d).write.option("header", True).csv(path)
    rows = read_labelled_customers(spark, path)
    return rows.withColumn("customer_id", F.col("customer_id").cast("long"))


@query("", "SELECT DISTINCT p_brand AS name FROM part")
def json_value_list(spark, d):
    """A list of valid values from a file with one JSON array."""
    path = scratch_path(spark, "values")
    names = table(spark, d, "part").agg(F.to_json(F.collect_set("p_brand")).alias("value"))
    names.write.text(path)
    return read_json_list(spark, path, "name")


@query("", "SELECT o_orderkey AS \"order key\", o_orderdate, o_totalprice FROM orders")
def created_stage_table(spark, d):
    """A stage table made from declared columns, filled and read back by name."""
    columns = [FeedColumn("order key", "BIGINT"), FeedColumn("o_orderdate", "TIMESTAMP"), FeedColumn("o_totalprice", "DOUBLE")]
    name = "stage_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    stage.create_stage_table(spark, name, stage.stage_schema(columns, scored=False))
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("order key"), "o_orderdate", "o_totalprice")
    rows.write.insertInto(name)
    return spark.table(name)


@query("data_file", "SELECT 'data_file' AS table_name, count(*) AS row_count FROM data_file")
def catalog_row_counts(spark, d):
    """Control tables made in the catalog, one filled, listed and counted; the empty ones are left out."""
    database = "meta_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    schemas.create_tables(spark, database)
    rows = schemas.conform(meta(spark, d).data_file, spark.table(f"{database}.data_file").schema)
    rows.write.insertInto(f"{database}.data_file")
    counts = schemas.table_counts({n: spark.table(f"{database}.{n}") for n in schemas.list_tables(spark, database)})
    return counts.filter("row_count > 0")
