"""The set of control tables an operator reads."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tidegate import schemas


class Meta:
    """Control tables by name. Entries may be DataFrames or functions that build one on first use."""

    def __init__(self, tables: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        self._tables = dict(tables)

    def __getattr__(self, name: str) -> DataFrame:
        tables = self.__dict__.get("_tables", {})
        if name not in tables:
            raise AttributeError(f"no control table {name!r}")
        entry = tables[name]
        if callable(entry) and not isinstance(entry, DataFrame):
            entry = tables[name] = entry()
        return entry

    def names(self) -> list[str]:
        return sorted(self._tables)

    def with_tables(self, **tables: DataFrame) -> "Meta":
        return Meta({**self._tables, **tables})

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> "Meta":
        return cls({t: (lambda t=t: spark.table(f"{database}.{t}")) for t in schemas.list_tables(spark, database)})

    @classmethod
    def from_folder(cls, spark: SparkSession, root: str) -> "Meta":
        """One parquet folder per control table, read with the declared schema."""
        return cls(
            {
                name: (lambda name=name, schema=schema: spark.read.schema(schema).parquet(f"{root}/{name}"))
                for name, schema in schemas.META_SCHEMAS.items()
            }
        )
