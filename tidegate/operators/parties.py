"""Provider, receiver and extract look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidegate.meta import Meta
from tidegate.plans.keys import matching


def providers_by_name(meta: Meta, names: DataFrame | None = None) -> DataFrame:
    return matching(meta.provider, names, "provider_name")


def providers_by_id(meta: Meta, ids: DataFrame | None = None) -> DataFrame:
    return matching(meta.provider, ids, "provider_id")


def receivers_by_name(meta: Meta, names: DataFrame | None = None) -> DataFrame:
    return matching(meta.receiver, names, "receiver_name")


def receivers_by_id(meta: Meta, ids: DataFrame | None = None) -> DataFrame:
    return matching(meta.receiver, ids, "receiver_id")


def extracts_by_name(meta: Meta, names: DataFrame | None = None) -> DataFrame:
    return matching(meta.extract_config, names, "extract_name")
