"""Look-ups over all batches, files, objects, sources, targets and processes."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.bindings import meta, table
from checks.registry import query
from tidegate.operators import batches, files, parties, processes, readiness, sources, targets

AS_OF = "2002-01-30 12:00:00"


@query("batch", "SELECT * FROM batch WHERE end_time IS NULL")
def active_batches(spark, d):
    return batches.active_batches(meta(spark, d))


@query(
    "batch",
    """SELECT batch_name, min(batch_id) AS batch_id, count(*) AS active_count
FROM batch WHERE end_time IS NULL GROUP BY batch_name""",
)
def first_active_batch(spark, d):
    return batches.first_active_batch(meta(spark, d))


@query("batch data_file", "SELECT * FROM batch WHERE batch_id IN (SELECT batch_id FROM data_file)")
def batch_by_id(spark, d):
    m = meta(spark, d)
    return batches.batches_by_id(m, m.data_file.select("batch_id"))


@query(
    "batch extract_data_file",
    """SELECT batch_id, min(batch_name) AS batch_name FROM batch
WHERE batch_id IN (SELECT batch_id FROM extract_data_file) GROUP BY batch_id""",
)
def batch_name_by_id(spark, d):
    m = meta(spark, d)
    return batches.batch_names(m, m.extract_data_file.select("batch_id"))


@query("batch", "SELECT batch_name, max(batch_id) AS batch_id FROM batch WHERE batch_status = 'STARTED' GROUP BY batch_name")
def current_batches(spark, d):
    return batches.current_batches(meta(spark, d))


@query(
    "batch data_file extract_data_file",
    """SELECT l.filename, l.direction, b.* FROM (
  SELECT f.filename, 'IN' AS direction, max(b.batch_id) AS batch_id
  FROM batch b JOIN data_file f ON b.batch_id = f.batch_id WHERE b.batch_status = 'COMPLETED' GROUP BY f.filename
  UNION ALL
  SELECT e.extract_filename, 'OUT', max(b.batch_id)
  FROM batch b JOIN extract_data_file e ON b.batch_id = e.batch_id WHERE b.batch_status = 'COMPLETED' GROUP BY e.extract_filename
) l JOIN batch b ON b.batch_id = l.batch_id""",
)
def completed_batch_by_file(spark, d):
    return batches.completed_batch_by_file(meta(spark, d))


def _line_file_ids(spark, d, flag):
    lines = table(spark, d, "lineitem").filter(F.col("l_returnflag") == flag)
    return lines.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("file_id"), (F.col("l_orderkey") + 1).alias("batch_id"))


@query(
    "batch data_file",
    """SELECT f.* FROM data_file f LEFT JOIN batch b ON b.batch_id = f.batch_id AND b.batch_status = 'STARTED'
WHERE f.file_id IN (SELECT l_orderkey*10+l_linenumber FROM lineitem WHERE l_returnflag = 'R')""",
)
def file_with_open_batch(spark, d):
    return files.files_by_id(meta(spark, d), _line_file_ids(spark, d, "R").select("file_id"))


@query("data_file extract_data_file", "SELECT * FROM data_file WHERE filename IN (SELECT extract_filename FROM extract_data_file)")
def files_by_name(spark, d):
    m = meta(spark, d)
    wanted = m.extract_data_file.select(F.concat(F.lit(" "), "extract_filename", F.lit("  ")).alias("filename"))
    return files.files_by_name(m, wanted)


@query("data_file", "SELECT filename, min(file_id) AS file_id, count(*) AS file_count FROM data_file GROUP BY filename")
def file_id_by_name(spark, d):
    return files.file_ids(meta(spark, d))


@query(
    "data_file",
    """SELECT file_id, filename FROM data_file
WHERE file_id IN (SELECT l_orderkey*10+l_linenumber FROM lineitem WHERE l_returnflag = 'N')""",
)
def file_name_by_id(spark, d):
    return files.file_names(meta(spark, d), _line_file_ids(spark, d, "N").select("file_id"))


@query(
    "data_file",
    """SELECT * FROM data_file WHERE (batch_id, file_id) IN
(SELECT l_orderkey+1, l_orderkey*10+l_linenumber FROM lineitem WHERE l_returnflag = 'A')""",
)
def batch_file(spark, d):
    return files.files_in_batch(meta(spark, d), _line_file_ids(spark, d, "A"))


_ATTRIBUTES = """a.file_id, a.file_path, coalesce(a.expected_row_count, 0) AS expected_row_count, b.column_delimiter,
b.row_delimiter, coalesce(b.header_row_count, 0) AS header_row_count, coalesce(b.field_count, 0) AS field_count, a.filename,
b.object_id, b.object_name, b.file_format, b.schema_name, b.landing_directory"""


@query("data_file data_object", f"SELECT {_ATTRIBUTES} FROM data_file a JOIN data_object b ON a.object_id = b.object_id")
def file_attributes(spark, d):
    return files.file_attributes(meta(spark, d))


@query(
    "data_file data_object extract_data_file",
    f"""SELECT {_ATTRIBUTES} FROM data_file a JOIN data_object b ON a.object_id = b.object_id WHERE a.file_id IN
(SELECT min(file_id) FROM data_file WHERE filename IN (SELECT extract_filename FROM extract_data_file) GROUP BY filename)""",
)
def file_attributes_by_name(spark, d):
    m = meta(spark, d)
    return files.file_attributes_by_name(m, m.extract_data_file.select(F.col("extract_filename").alias("filename")))


@query(
    "data_file",
    """SELECT DISTINCT w.filename, 'No file id for this file name' AS error FROM (
  SELECT filename FROM data_file UNION ALL SELECT 'supplier_' || CAST(page_id AS VARCHAR) || '.csv' FROM pages) w
WHERE w.filename NOT IN (SELECT filename FROM data_file)""",
)
def file_attribute_errors(spark, d):
    m = meta(spark, d)
    other = table(spark, d, "pages").select(
        F.concat(F.lit("supplier_"), F.col("page_id").cast("string"), F.lit(".csv ")).alias("filename")
    )
    return files.unknown_files(m, m.data_file.select("filename").unionByName(other))


@query(
    "batch data_file",
    """SELECT f.*, b.batch_name FROM batch b JOIN data_file f ON b.batch_id = f.batch_id
WHERE b.batch_status = 'STARTED' AND upper(f.file_status) = 'STAGED'""",
)
def staged_batch_files(spark, d):
    return files.staged_batch_files(meta(spark, d))


@query(
    "batch data_file",
    """SELECT f.*, b.batch_name FROM batch b JOIN data_file f ON b.batch_id = f.batch_id
WHERE b.batch_status = 'STARTED' AND upper(f.file_status) IN ('STAGED', 'REGISTERED')""",
)
def pending_batch_files(spark, d):
    return files.pending_batch_files(meta(spark, d))


@query(
    "batch data_file",
    """SELECT * EXCLUDE (rn) FROM (
  SELECT f.*, b.batch_name, row_number() OVER (PARTITION BY b.batch_name, f.object_id ORDER BY f.file_id DESC) AS rn
  FROM batch b JOIN data_file f ON b.batch_id = f.batch_id
  WHERE b.batch_status = 'STARTED' AND upper(f.file_status) IN ('STAGED', 'REGISTERED')) WHERE rn = 1""",
)
def last_batch_files(spark, d):
    return files.last_batch_files(meta(spark, d))


@query(
    "data_file data_object source",
    """SELECT f.filename, o.*, s.source_code FROM (SELECT DISTINCT filename FROM data_file) f
JOIN data_object o ON f.filename LIKE o.filename_pattern JOIN source s ON s.source_id = o.object_id""",
)
def object_for_file(spark, d):
    m = meta(spark, d)
    return files.objects_for_files(m, m.data_file.select("filename"))


@query("data_object data_file", "SELECT * FROM data_object WHERE object_id IN (SELECT object_id FROM data_file)")
def object_by_id(spark, d):
    m = meta(spark, d)
    return sources.objects_by_id(m, m.data_file.select("object_id"))


@query(
    "data_object target_view",
    """SELECT object_name, max(object_id) AS object_id, count(*) AS num_rows FROM data_object
WHERE object_name IN (SELECT source_object_name FROM target_view) GROUP BY object_name""",
)
def object_id_by_name(spark, d):
    m = meta(spark, d)
    return sources.object_ids(m, m.target_view.select(F.concat(F.lit(" "), "source_object_name").alias("object_name")))


@query(
    "data_object",
    "SELECT object_id, object_name, filename_pattern, landing_directory FROM data_object WHERE object_type = 'file'",
)
def file_objects(spark, d):
    return sources.file_objects(meta(spark, d))


@query("process", "SELECT * FROM process WHERE process_name IN (SELECT event_type FROM events)")
def process_by_name(spark, d):
    m = meta(spark, d)
    return processes.processes_by_name(m, table(spark, d, "events").select(F.col("event_type").alias("process_name")))


@query("process", "SELECT process_name, min(process_id) AS process_id, count(*) AS process_count FROM process GROUP BY process_name")
def process_id_by_name(spark, d):
    return processes.process_ids(meta(spark, d))


@query("process_log", "SELECT * FROM process_log WHERE process_log_id IN (SELECT event_id + 1 FROM events WHERE event_type = 'error')")
def process_log_by_id(spark, d):
    failed = table(spark, d, "events").filter("event_type = 'error'")
    return processes.process_logs(meta(spark, d), failed.select((F.col("event_id") + 1).alias("process_log_id")), ordered=True)


@query(
    "process process_log",
    """SELECT p.process_name, p.process_id, max(l.process_log_id) AS process_log_id FROM process p
LEFT JOIN process_log l ON l.process_id = p.process_id AND l.end_time IS NULL GROUP BY p.process_name, p.process_id""",
)
def active_process_log(spark, d):
    return processes.active_process_logs(meta(spark, d))


@query(
    "target target_view data_object source",
    """SELECT t.*, v.target_id AS view_target_id, v.view_name, v.source_object_name, v.indiv_id_change_col, v.add_id_change_col,
  v.house_id_change_col, v.site_id_change_col, o.object_id AS src_object_id, s.source_type, s.source_code, s.source_id,
  t.target_id AS tgt_object_id
FROM target t LEFT JOIN target_view v ON t.target_id = v.target_id
LEFT JOIN data_object o ON v.source_object_name = o.object_name
LEFT JOIN source s ON 'VW_STG_' || upper(s.source_code) = upper(o.object_name)
  OR 'VW__STG_' || upper(s.source_code) = upper(o.object_name)""",
)
def target_attributes(spark, d):
    return targets.target_attributes(meta(spark, d))


@query(
    "target_view",
    """SELECT * FROM target_view WHERE nullif(indiv_id_change_col, '') IS NOT NULL OR nullif(add_id_change_col, '') IS NOT NULL
OR nullif(house_id_change_col, '') IS NOT NULL OR nullif(site_id_change_col, '') IS NOT NULL""",
)
def id_change_views(spark, d):
    return targets.id_change_views(meta(spark, d))


@query(
    "target_view",
    """SELECT * EXCLUDE (site_id_change_col) FROM target_view WHERE nullif(indiv_id_change_col, '') IS NOT NULL
OR nullif(add_id_change_col, '') IS NOT NULL OR nullif(house_id_change_col, '') IS NOT NULL""",
)
def id_change_views_without_site(spark, d):
    m = meta(spark, d)
    return targets.id_change_views(m.with_tables(target_view=m.target_view.drop("site_id_change_col")))


@query(
    "target_view target_view_column_override",
    """SELECT o.*, upper(o.column_name) AS column_name_upper FROM target_view_column_override o
WHERE (o.target_id, o.view_name) IN (SELECT target_id, view_name FROM target_view)""",
)
def column_overrides(spark, d):
    m = meta(spark, d)
    return targets.column_overrides(m, m.target_view.select("target_id", "view_name"))


@query("target", "SELECT * FROM target WHERE coalesce(purge_type, '') <> ''")
def target_purge(spark, d):
    return targets.purgeable_targets(meta(spark, d))


@query(
    "target data_file",
    "SELECT * FROM target WHERE target_id IN (SELECT object_id FROM data_file)",
)
def target_by_object(spark, d):
    m = meta(spark, d)
    return targets.targets_by_object(m, m.data_file.select("object_id"))


@query(
    "data_file source data_object",
    """SELECT f.*, s.source_id, s.provider_id, s.source_code, s.source_type, s.category, s.stage_name, s.receipt_frequency,
  s.purge_type, o.object_id AS source_object_id, o.object_name, o.object_type, o.filename_pattern, o.column_delimiter,
  o.row_delimiter, o.header_row_count, o.field_count, o.file_format, o.schema_name, o.required_ind, o.landing_directory
FROM data_file f JOIN source s ON f.object_id = s.source_id JOIN data_object o ON s.source_id = o.object_id
WHERE coalesce(s.purge_type, '') <> ''""",
)
def file_purge(spark, d):
    return files.purgeable_files(meta(spark, d))


_SOURCE_ATTRIBUTES = """s.*, o.*, f.source_id AS feed_source_id, f.* EXCLUDE (source_id), t.target_id, t.target_name,
t.purge_type AS target_purge_type, t.purge_max_length"""
_SOURCE_JOINS = """source s JOIN data_object o ON s.source_id = o.object_id
LEFT JOIN source_feed f ON s.source_id = f.source_id LEFT JOIN target t ON f.target_object_name = t.target_name"""


@query("source data_object source_feed target", f"SELECT {_SOURCE_ATTRIBUTES} FROM {_SOURCE_JOINS}")
def source_attributes(spark, d):
    return sources.source_attributes(meta(spark, d))


@query(
    "source data_object source_feed target source_view_incremental",
    f"""SELECT {_SOURCE_ATTRIBUTES}, i.source_id AS incremental_source_id, i.source_code AS incremental_source_code, i.column_name
FROM {_SOURCE_JOINS} LEFT JOIN source_view_incremental i ON i.source_id = s.source_id
WHERE s.source_code IN (SELECT upper(replace(s_name,'#','_')) FROM supplier WHERE s_acctbal > 0)""",
)
def source_attributes_by_code(spark, d):
    solvent = table(spark, d, "supplier").filter("s_acctbal > 0")
    codes = solvent.select(F.upper(F.replace(F.col("s_name"), F.lit("#"), F.lit("_"))).alias("source_code"))
    return sources.source_attributes_by_code(meta(spark, d), codes)


_CODED = {
    "coded": """SELECT * EXCLUDE (source_code), CASE category WHEN '1-URGENT' THEN 'KB_Match_Output'
WHEN '2-HIGH' THEN 'crcdi_ee_overlay_output' ELSE 'crcdi_ee_client_output' END AS source_code FROM source""",
    "named": "SELECT * EXCLUDE (batch_name), CASE batch_name WHEN '5-LOW' THEN 'suppression_batch' ELSE batch_name END AS batch_name FROM batch",
}


def _party_meta(spark, d):
    m = meta(spark, d)
    category = F.col("category")
    code = F.when(category == "1-URGENT", "KB_Match_Output").when(category == "2-HIGH", "crcdi_ee_overlay_output")
    name = F.when(F.col("batch_name") == "5-LOW", "suppression_batch").otherwise(F.col("batch_name"))
    return m.with_tables(
        source=m.source.withColumn("source_code", code.otherwise("crcdi_ee_client_output")),
        batch=m.batch.withColumn("batch_name", name),
    )


_CURRENT = "(SELECT batch_name, max(batch_id) AS batch_id FROM named WHERE batch_status = 'STARTED' GROUP BY batch_name)"


@query(
    "data_file source batch",
    f"""SELECT c.batch_name, s.source_code, f.file_id, f.batch_id FROM data_file f JOIN coded s ON f.object_id = s.source_id
JOIN {_CURRENT} c ON f.batch_id = c.batch_id WHERE s.source_code = 'KB_Match_Output'""",
    _CODED,
)
def party_files_kb(spark, d):
    return files.party_files(_party_meta(spark, d))


@query(
    "data_file source batch",
    f"""SELECT c.batch_name, s.source_code, f.file_id, f.batch_id FROM data_file f JOIN coded s ON f.object_id = s.source_id
JOIN {_CURRENT} c ON f.batch_id = c.batch_id WHERE s.source_code =
CASE c.batch_name WHEN 'suppression_batch' THEN 'crcdi_ee_overlay_output' ELSE 'crcdi_ee_client_output' END""",
    _CODED,
)
def party_files_ee(spark, d):
    return files.party_files(_party_meta(spark, d), "EE")


@query(
    "data_file source",
    """SELECT f.file_id, max(upper(lower(s.stage_name) || '_' || right('0000000' || CAST(f.file_id AS VARCHAR), 7))) AS table_name
FROM data_file f JOIN source s ON f.object_id = s.source_id GROUP BY f.file_id""",
)
def stage_table_names(spark, d):
    return files.stage_table_names(meta(spark, d))


@query(
    "source_feed_column data_file",
    """SELECT source_id, column_id, ordinal_position, column_name, data_type, max_length, scale, fixed_width_start_position,
fixed_width_length, column_property FROM source_feed_column WHERE source_id IN (SELECT object_id FROM data_file)""",
)
def feed_columns(spark, d):
    m = meta(spark, d)
    return sources.feed_columns(m, m.data_file.select(F.col("object_id").alias("source_id")))


_ROLE = """(SELECT arg_min(column_name, (ordinal_position, column_id)) FROM source_feed_column c
WHERE c.source_id = s.source_id AND c.column_property = '{0}') AS {0}"""


@query(
    "source_feed_column",
    f"""SELECT s.source_id, {_ROLE.format('ds_attrib_name')}, {_ROLE.format('ds_attrib_value')},
{_ROLE.format('ds_attrib_datatype')} FROM (SELECT DISTINCT source_id FROM source_feed_column) s""",
)
def datasource_roles(spark, d):
    return sources.datasource_roles(meta(spark, d))


@query(
    "source_feed_column",
    "SELECT source_id, column_name, data_type, max_length, scale FROM source_feed_column WHERE column_property = 'ds_natural_key'",
)
def natural_keys(spark, d):
    return sources.natural_keys(meta(spark, d))


_NODES = """SELECT s.source_code, CASE WHEN c.column_property = 'master_key_node' THEN 'masterID' ELSE c.column_name END AS node,
c.column_name AS master FROM source_feed_column c JOIN source s ON c.source_id = s.source_id
WHERE c.column_property IN ('key_node', 'master_key_node')"""
_PAIRS = """SELECT a.source_code, a.node AS left_col, b.node AS right_col, a.master AS left_master, b.master AS right_master
FROM nodes a JOIN nodes b ON a.source_code = b.source_code AND a.node < b.node"""


@query("source_feed_column source", _PAIRS, {"nodes": _NODES})
def key_node_pairs(spark, d):
    return sources.key_node_pairs(meta(spark, d))


@query(
    "source_feed_column source",
    _PAIRS,
    {
        "nodes": f"""{_NODES} UNION ALL SELECT source_code, 'ISN', 'ISN' FROM source
UNION ALL SELECT source_code, 'cr_indiv_key', 'cr_indiv_key' FROM source"""
    },
)
def key_node_pairs_with_constants(spark, d):
    return sources.key_node_pairs(meta(spark, d), with_isn=True, with_cr=True)


@query("provider", "SELECT * FROM provider WHERE provider_name IN (SELECT n_name FROM nation JOIN supplier ON s_nationkey = n_nationkey)")
def provider_by_name(spark, d):
    used = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return parties.providers_by_name(meta(spark, d), used.select(F.col("n_name").alias("provider_name")))


@query("provider source", "SELECT * FROM provider WHERE provider_id IN (SELECT provider_id FROM source)")
def provider_by_id(spark, d):
    m = meta(spark, d)
    return parties.providers_by_id(m, m.source.select("provider_id"))


@query(
    "receiver",
    """SELECT * FROM receiver WHERE receiver_name IN (SELECT r_name FROM region JOIN nation ON r_regionkey = n_regionkey
JOIN customer ON c_nationkey = n_nationkey)""",
)
def receiver_by_name(spark, d):
    nations = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    used = table(spark, d, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return parties.receivers_by_name(meta(spark, d), used.select(F.col("r_name").alias("receiver_name")))


@query(
    "receiver",
    """SELECT * FROM receiver WHERE receiver_id IN (SELECT n_regionkey + 1 FROM nation JOIN customer ON c_nationkey = n_nationkey)""",
)
def receiver_by_id(spark, d):
    used = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return parties.receivers_by_id(meta(spark, d), used.select((F.col("n_regionkey") + 1).alias("receiver_id")))


@query(
    "extract_config",
    "SELECT * FROM extract_config WHERE extract_name IN (SELECT p_name FROM part WHERE p_retailprice > 915)",
)
def extract_by_name(spark, d):
    dear = table(spark, d, "part").filter("p_retailprice > 915")
    return parties.extracts_by_name(meta(spark, d), dear.select(F.col("p_name").alias("extract_name")))


@query("source data_file", "SELECT * FROM source WHERE source_id IN (SELECT object_id FROM data_file)")
def source_by_object(spark, d):
    m = meta(spark, d)
    return sources.sources_by_object(m, m.data_file.select("object_id"))


@query("source", "SELECT * FROM source WHERE source_type = 'file' AND category <> 'CDI'")
def file_sources(spark, d):
    return sources.file_sources(meta(spark, d))


_MONTHS = """((year({b}) * 12 + month({b})) - (year({a}) * 12 + month({a}))
- CASE WHEN (day({b}), CAST({b} AS TIME)) < (day({a}), CAST({a} AS TIME)) THEN 1 ELSE 0 END)"""
_UNTIL = "TIMESTAMP '2002-01-30 12:00:00'"
_MONTH_COUNT = _MONTHS.format(a="max(f.modified_date)", b=_UNTIL)
_BATCH = "(SELECT coalesce(max(batch_id), 0) FROM batch WHERE batch_status = 'STARTED')"


def _late(test: str, join: str) -> str:
    return f"""SELECT * FROM (SELECT s.source_id, s.source_code, max(f.batch_id) AS batch_last_receiving_file,
  coalesce(c.current_count, 0) AS current_batch_file_count, s.receipt_frequency, n.expected_number_of_files, o.required_ind
FROM source s JOIN data_object o ON o.object_id = s.source_id {join} JOIN data_file f ON f.object_id = o.object_id
LEFT JOIN (SELECT f.object_id, count(f.file_id) AS current_count FROM data_file f
  WHERE f.batch_id = {_BATCH} AND {test} GROUP BY f.object_id) c ON c.object_id = s.source_id
LEFT JOIN (SELECT s.source_id, CAST(CASE upper(s.receipt_frequency)
    WHEN 'DAILY' THEN date_sub('day', max(f.modified_date), {_UNTIL})
    WHEN 'WEEKLY' THEN date_sub('week', max(f.modified_date), {_UNTIL})
    WHEN 'MONTHLY' THEN {_MONTH_COUNT}
    WHEN 'QUARTERLY' THEN {_MONTH_COUNT} // 3 END AS BIGINT) AS expected_number_of_files
  FROM data_file f JOIN source s ON f.object_id = s.source_id
  WHERE f.batch_id < {_BATCH} AND {test} GROUP BY s.source_id, s.receipt_frequency) n ON n.source_id = s.source_id
WHERE trim(nullif(s.receipt_frequency, '')) <> '' AND {test} AND o.required_ind = 'Y' AND s.source_type LIKE '%file%'
GROUP BY s.source_id, s.source_code, c.current_count, s.receipt_frequency, n.expected_number_of_files, o.required_ind)
WHERE current_batch_file_count < expected_number_of_files"""


@query("source data_object data_file batch", _late("1 = 1", "LEFT"))
def required_files_n(spark, d):
    return readiness.late_sources(meta(spark, d), F.to_timestamp_ntz(F.lit(AS_OF)))


@query("source data_object data_file batch", _late("coalesce(f.stg_good_record_count, 0) <> 0", ""))
def required_files_y(spark, d):
    return readiness.late_sources(meta(spark, d), F.to_timestamp_ntz(F.lit(AS_OF)), skip_empty="Y")


_EXPECTED = """SELECT b.batch_id, b.batch_name, s.source_id, s.source_code, o.required_ind, 1 AS expected_count,
  coalesce(e.existing_count, 0) AS existing_count
FROM data_object o JOIN source s ON o.object_id = s.source_id JOIN batch b ON b.batch_name = s.category
LEFT JOIN (SELECT batch_id, object_id, CASE WHEN coalesce(sum(stg_good_record_count), 0) > 0 THEN 1 ELSE 0 END AS existing_count
  FROM data_file GROUP BY batch_id, object_id) e ON e.object_id = s.source_id AND e.batch_id = b.batch_id
WHERE o.required_ind = 'Y'"""


@query(
    "source data_object data_file batch",
    f"""SELECT * FROM ({_EXPECTED} AND b.batch_id IN
  (SELECT max(batch_id) FROM batch WHERE batch_status = 'STARTED' GROUP BY batch_name)) WHERE expected_count > existing_count""",
)
def missing_required_files(spark, d):
    m = meta(spark, d)
    return readiness.missing_required_files(m, batches.current_batches(m))


@query(
    "source data_object data_file batch",
    f"""SELECT batch_id, batch_name, CAST(sum(expected_count) AS BIGINT) AS expected_count,
  CAST(sum(existing_count) AS BIGINT) AS existing_count, CAST(sum(expected_count - existing_count) AS BIGINT) AS missing_count
FROM ({_EXPECTED}) GROUP BY batch_id, batch_name HAVING sum(expected_count) > sum(existing_count)""",
)
def missing_required_counts(spark, d):
    return readiness.missing_required_counts(meta(spark, d))
