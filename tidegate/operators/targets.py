"""Target and target-view look-ups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidegate.functions.text import is_set
from tidegate.meta import Meta
from tidegate.plans.keys import beside, matching

VIEW_PREFIXES = ("VW_STG_", "VW__STG_")
ID_CHANGE_COLUMNS = ["indiv_id_change_col", "add_id_change_col", "house_id_change_col", "site_id_change_col"]


def target_attributes(meta: Meta, names: DataFrame | None = None) -> DataFrame:
    """Targets with their views, and the object and source each view reads. Key: target_name.

    A view object is named after its source with one of two prefixes. The prefixes exclude each other, so stripping
    whichever is there leaves one key to join on, where an OR of two conditions would compare all pairs.
    """
    targets = matching(meta.target, names, "target_name")
    out = beside(targets, meta.target_view, "view_", {"target_id": "target_id"}, "left")
    objects = meta.data_object.select(F.col("object_id").alias("src_object_id"), F.col("object_name").alias("_object_name"))
    out = out.join(objects, out.source_object_name == objects._object_name, "left")
    upper = F.upper("_object_name")
    short, long = VIEW_PREFIXES
    code = F.when(upper.startswith(short), F.substr(upper, F.lit(len(short) + 1))).when(
        upper.startswith(long), F.substr(upper, F.lit(len(long) + 1))
    )
    sources = meta.source.select("source_type", "source_code", "source_id", F.upper("source_code").alias("_code"))
    out = out.withColumn("_wanted", code)
    out = out.join(sources, F.col("_wanted") == F.col("_code"), "left")
    return out.withColumn("tgt_object_id", F.col("target_id")).drop("_object_name", "_wanted", "_code")


def id_change_views(meta: Meta) -> DataFrame:
    """Views with any id-change column set. Older tables have no site column."""
    views = meta.target_view
    there = [c for c in ID_CHANGE_COLUMNS if c in views.columns]
    return views.filter(reduce(lambda a, b: a | b, [is_set(F.col(c)) for c in there]))


def column_overrides(meta: Meta, keys: DataFrame | None = None) -> DataFrame:
    """Column overrides by (target_id, view_name)."""
    found = matching(meta.target_view_column_override, keys, "target_id", "view_name")
    return found.withColumn("column_name_upper", F.upper("column_name"))


def purgeable_targets(meta: Meta) -> DataFrame:
    return meta.target.filter(is_set(F.col("purge_type")))


def targets_by_object(meta: Meta, ids: DataFrame | None = None) -> DataFrame:
    wanted = None if ids is None else ids.select(F.col("object_id").alias("target_id"))
    return matching(meta.target, wanted, "target_id")
