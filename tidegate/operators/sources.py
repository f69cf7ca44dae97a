"""Source, object and feed-column look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegate.meta import Meta
from tidegate.plans.keys import beside, matching

KEY_NODE = "key_node"
MASTER_KEY_NODE = "master_key_node"
MASTER_ID = "masterID"
ISN_COLUMN = "ISN"
CR_COLUMN = "cr_indiv_key"

FEED_COLUMNS = [
    "source_id",
    "column_id",
    "ordinal_position",
    "column_name",
    "data_type",
    "max_length",
    "scale",
    "fixed_width_start_position",
    "fixed_width_length",
    "column_property",
]


def objects_by_id(meta: Meta, ids: DataFrame | None = None) -> DataFrame:
    return matching(meta.data_object, ids, "object_id")


def object_ids(meta: Meta, names: DataFrame | None = None) -> DataFrame:
    """Highest object id per object name, and how many objects share the name. Unknown names give no row."""
    found = matching(meta.data_object, names, "object_name", trim=True)
    return found.groupBy("object_name").agg(F.max("object_id").alias("object_id"), F.count("*").alias("num_rows"))


def file_objects(meta: Meta) -> DataFrame:
    """Objects that arrive as files, with what a landing scan needs."""
    return meta.data_object.filter("object_type = 'file'").select(
        "object_id", "object_name", "filename_pattern", "landing_directory"
    )


def sources_by_object(meta: Meta, ids: DataFrame | None = None) -> DataFrame:
    """Source rows by object_id; source and object share their id."""
    wanted = None if ids is None else ids.select(F.col("object_id").alias("source_id"))
    return matching(meta.source, wanted, "source_id")


def file_sources(meta: Meta) -> DataFrame:
    """File sources outside the CDI category; a source without a category is left out."""
    return meta.source.filter("source_type = 'file' AND category <> 'CDI'")


def source_attributes(meta: Meta, ids: DataFrame | None = None) -> DataFrame:
    """Source, its object, its feed options and its target in one row. Key: source_id.

    Clashing names get the prefix ``object_``, ``feed_`` or ``target_``.
    """
    return _described(matching(meta.source, ids, "source_id"), meta)


def _described(sources: DataFrame, meta: Meta) -> DataFrame:
    out = beside(sources, meta.data_object, "object_", {"source_id": "object_id"})
    out = beside(out, meta.source_feed, "feed_", {"source_id": "source_id"}, "left")
    return beside(out, meta.target, "target_", {"target_object_name": "target_name"}, "left")


def source_attributes_by_code(meta: Meta, codes: DataFrame | None = None) -> DataFrame:
    """As ``source_attributes``, by source_code, with the incremental-view settings."""
    out = _described(matching(meta.source, codes, "source_code"), meta)
    return beside(out, meta.source_view_incremental, "incremental_", {"source_id": "source_id"}, "left")


def feed_columns(meta: Meta, ids: DataFrame | None = None) -> DataFrame:
    """Declared columns of each source, in file order."""
    columns = matching(meta.source_feed_column, ids, "source_id").select(*FEED_COLUMNS)
    return columns.orderBy("source_id", "ordinal_position", "column_id")


def datasource_roles(meta: Meta, ids: DataFrame | None = None) -> DataFrame:
    """First column of each source that holds the attribute name, value and data type; one pass for all three."""
    columns = matching(meta.source_feed_column, ids, "source_id")
    place = F.struct("ordinal_position", "column_id")

    def first(role: str):
        return F.min_by("column_name", F.when(F.col("column_property") == role, place)).alias(role)

    return columns.groupBy("source_id").agg(first("ds_attrib_name"), first("ds_attrib_value"), first("ds_attrib_datatype"))


def natural_keys(meta: Meta, ids: DataFrame | None = None) -> DataFrame:
    keys = matching(meta.source_feed_column, ids, "source_id").filter("column_property = 'ds_natural_key'")
    return keys.select("source_id", "column_name", "data_type", "max_length", "scale")


def key_node_pairs(
    meta: Meta, codes: DataFrame | None = None, with_isn: bool = False, with_cr: bool = False
) -> DataFrame:
    """Unordered pairs of the key columns of each source; the master key goes by the name masterID.

    A pair is the result itself, so its number follows the key columns a source declares.
    """
    sources = matching(meta.source, codes, "source_code").select("source_id", "source_code")
    property_ = F.col("column_property")
    keys = meta.source_feed_column.filter(property_.isin(KEY_NODE, MASTER_KEY_NODE)).select(
        "source_id",
        F.when(property_ == MASTER_KEY_NODE, MASTER_ID).otherwise(F.col("column_name")).alias("node"),
        F.col("column_name").alias("master"),
    )
    nodes = keys.join(sources, "source_id").select("source_code", "node", "master")
    extra = [name for name, wanted in ((ISN_COLUMN, with_isn), (CR_COLUMN, with_cr)) if wanted]
    for name in extra:
        constant = sources.select("source_code").distinct().select("source_code", F.lit(name).alias("node"), F.lit(name).alias("master"))
        nodes = nodes.unionByName(constant)
    left = nodes.select("source_code", F.col("node").alias("left_col"), F.col("master").alias("left_master"))
    right = nodes.select("source_code", F.col("node").alias("right_col"), F.col("master").alias("right_master"))
    pairs = left.join(right, "source_code").filter("left_col < right_col")
    return pairs.select("source_code", "left_col", "right_col", "left_master", "right_master")
