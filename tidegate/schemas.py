"""Schemas of the control tables, and creating, listing and counting them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

_TYPES = {"bigint": T.LongType(), "string": T.StringType(), "timestamp": T.TimestampType()}

# Column names and types of the control tables, which files and queries of users depend on.
# Every table also carries created_date, created_by, modified_date and modified_by.
_COLUMNS = {
    "file_status_lkp": "file_status string, file_status_id bigint",
    "provider": "provider_id bigint, provider_name string, provider_code string",
    "receiver": "receiver_id bigint, receiver_name string, receiver_code string",
    "batch": (
        "batch_id bigint, batch_name string, batch_description string, batch_type string, batch_rows bigint, "
        "batch_status string, status_message string, start_time timestamp, end_time timestamp"
    ),
    "data_object": (
        "object_id bigint, object_name string, object_type string, object_description string, "
        "database_name string, schema_name string, filename_pattern string, filename_extension string, "
        "control_file_flag string, control_file_pattern string, control_file_extension string, "
        "encryption_flag string, encryption_type string, compression_flag string, compression_type string, "
        "file_encoding string, column_delimiter string, row_delimiter string, field_count bigint, "
        "header_row_count bigint, footer_row_count bigint, record_length bigint, file_format string, "
        "text_qualifier string, error_row_threshold_pct bigint, required_ind string, "
        "file_transfer_method string, landing_directory string"
    ),
    "data_file": (
        "file_id bigint, object_id bigint, file_pattern string, file_date timestamp, "
        "file_received_date timestamp, file_status string, file_byte_size bigint, filename string, "
        "expected_row_count bigint, row_count bigint, fm_file_id bigint, fm_good_record_count bigint, "
        "fm_error_record_count bigint, stg_good_record_count bigint, file_path string, batch_id bigint"
    ),
    "extract_config": (
        "extract_id bigint, extract_name string, extract_type string, target_schema string, "
        "target_object string, location string, file_name string, file_name_has_datetime_ind string, "
        "format_type string, compression_str string, record_delimiter string, field_delimiter string, "
        "file_extension string, escape_character string, escape_unenclosed_field string, date_format string, "
        "time_format string, timestamp_format string, binary_format string, "
        "field_optionally_enclosed_by string, null_if string, overwrite string, single string, "
        "max_file_size bigint, object_schema string, object_name string, sqlquery string, header string"
    ),
    "process": (
        "process_id bigint, parent_process_id bigint, process_name string, process_folder string, "
        "process_qualifier string, process_type string, process_group string, process_text string, "
        "process_path string"
    ),
    "process_log": (
        "process_log_id bigint, process_id bigint, source_id bigint, target_id bigint, src_file_id bigint, "
        "tgt_file_id bigint, process_execute_id bigint, start_time timestamp, end_time timestamp, "
        "inserted_rows bigint, updated_rows bigint, deleted_rows bigint, error_row_count bigint, "
        "status string, status_message string, batch_id bigint"
    ),
    "process_log_detail": (
        "process_log_detail_id bigint, process_log_id bigint, process_name string, log_detail_message string, "
        "sql_query string, start_time timestamp, elapsed_duration bigint, total_row_cnt bigint"
    ),
    "source": (
        "source_id bigint, provider_id bigint, source_code string, source_type string, category string, "
        "sub_category string, source_system_name string, feed_cd string, stage_name string, "
        "count_threshold bigint, filelist_filename string, cr_flag string, cr_rekey_flag string, "
        "receipt_frequency string, receipt_day bigint, receipt_time string, post_validation_sql string, "
        "purge_type string, purge_max_length bigint, purge_max_length_type string"
    ),
    "source_feed": (
        "source_id bigint, validate_prior_to_load_ind string, compression_str string, date_format string, "
        "time_format string, timestamp_format string, escape_char string, escape_unenclosed_field string, "
        "trim_space string, null_if string, error_on_column_count_mismatch string, on_error string, "
        "purge_str string, return_failed_only string, enforce_length string, truncatecolumns string, "
        "force_str string, acceptinvchars string, target_object_name string, add_record_id_ind string, "
        "split_filename_pattern string, strip_outer_element string"
    ),
    "source_feed_column": (
        "column_id bigint, source_id bigint, ordinal_position bigint, column_name string, data_type string, "
        "max_length bigint, scale bigint, fixed_width_start_position bigint, fixed_width_length bigint, "
        "column_property string"
    ),
    "source_view_incremental": (
        "source_id bigint, source_code string, input_sql string, column_name string, last_pull_date string"
    ),
    "source_rank": "source_rank bigint, source_id bigint",
    "target": (
        "target_id bigint, target_name string, receiver_id bigint, target_type string, category string, "
        "sub_category string, delivery_frequency string, delivery_day bigint, delivery_time string, "
        "purge_type string, purge_column string, purge_max_length bigint, purge_max_length_type string"
    ),
    "target_view": (
        "target_id bigint, view_name string, source_object_name string, stage_table_name string, "
        "mdb_table_name string, full_refresh_ind string, cr_ind string, cr_rekey_ind string, "
        "archive_table_ind string, fact_or_dimension string, natural_key string, order_by_cols string, "
        "surrogate_key string, generate_surr_key_ind string, archive_ret_copies bigint, "
        "source_data_2_best string, partition_by_cols string, indiv_id_change_col string, "
        "add_id_change_col string, house_id_change_col string, site_id_change_col string, batch_name string, "
        "batch_table string, id_change_table string, retain_col_list string, drop_stg_tables string"
    ),
    "target_view_column_override": (
        "view_name string, column_name string, target_id bigint, mdb_table_name string, transformation_sql string"
    ),
    "extract_data_file": "batch_id bigint, extract_filename string",
}
_AUDIT = "created_date timestamp, created_by string, modified_date timestamp, modified_by string"
_REQUIRED = {("file_status_lkp", "file_status")}


def _schema(table: str, columns: str) -> T.StructType:
    fields = []
    for item in f"{columns}, {_AUDIT}".split(", "):
        name, kind = item.split(" ")
        fields.append(T.StructField(name, _TYPES[kind], (table, name) not in _REQUIRED))
    return T.StructType(fields)


META_SCHEMAS: dict[str, T.StructType] = {t: _schema(t, c) for t, c in _COLUMNS.items()}

# Results of the usage classifier, with vectors held as arrays.
QUALITY_RESULTS = T.StructType(
    [
        T.StructField("features", T.ArrayType(T.DoubleType())),
        T.StructField("is_test_user", T.LongType()),
        T.StructField("rawPrediction", T.ArrayType(T.DoubleType())),
        T.StructField("probability", T.ArrayType(T.DoubleType())),
        T.StructField("prediction", T.DoubleType()),
    ]
)


def create_tables(spark: SparkSession, database: str, provider: str = "parquet") -> list[str]:
    """Create every control table that is absent. Errors are raised, not printed."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in META_SCHEMAS.items():
        # Parquet tables cannot enforce NOT NULL; keep the declared columns nullable there.
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({ddl}) USING {provider}")
    return list(META_SCHEMAS)


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """Stored tables of a database: no temporary views and no half-built ``*_new`` tables."""
    tables = spark.catalog.listTables(database)
    return sorted(t.name for t in tables if not t.isTemporary and not t.name.endswith("_new"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows, counted in one job."""
    if not tables:
        raise ValueError("no tables to count")
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give ``df`` exactly the columns of ``schema``: extra ones dropped, missing ones NULL, types cast."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
