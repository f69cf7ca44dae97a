"""Changes to stored tables as functions from the old rows to the new ones.

Parquet tables cannot be updated in place, so an operator returns the new table and the caller writes it to a fresh folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.plans.keys import require_columns


def fill_update(table: DataFrame, changes: DataFrame, key: str, stamp: dict[str, Column] | None = None) -> DataFrame:
    """Replace values by the non-NULL ones of ``changes``; ``stamp`` is set on changed rows.

    Two changes for one key would multiply the row, so the query fails on them.
    """
    require_columns(changes, [key], "changes")
    stamp = stamp or {}
    new = [c for c in changes.columns if c != key]
    unknown = [c for c in [*new, *stamp] if c not in table.columns]
    if unknown:
        raise ValueError(f"the table lacks {', '.join(unknown)}")
    single = changes.groupBy(F.col(key).alias("_key")).agg(
        *[F.first(c).alias(f"_new_{c}") for c in new], F.count(F.lit(1)).alias("_changes")
    )
    repeated = F.raise_error(F.concat(F.lit(f"several changes for {key} "), F.col("_key").cast("string")))
    side = single.withColumn("_key", F.when(F.col("_changes") > 1, repeated.cast(changes.schema[key].dataType)).otherwise(F.col("_key")))
    joined = table.join(side, F.col(key) == F.col("_key"), "left")
    hit = F.col("_key").isNotNull()
    columns = []
    for field in table.schema.fields:
        c = field.name
        if c in new:
            value = F.coalesce(F.col(f"_new_{c}").cast(field.dataType), F.col(c))
        else:
            value = F.col(c)
        if c in stamp:
            value = F.when(hit, stamp[c].cast(field.dataType)).otherwise(value)
        columns.append(value.alias(c))
    return joined.select(*columns)


def changed_count(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """How many rows an update with ``changes`` touches."""
    return table.join(changes.select(key), key, "left_semi").agg(F.count("*").alias("updated_rows"))


def delete_where(table: DataFrame, condition: Column) -> DataFrame:
    """Rows that stay after a delete: those for which the condition is false or unknown."""
    return table.filter(~F.coalesce(condition, F.lit(False)))


def set_where(table: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """Rows after an update of all rows that meet the condition."""
    types = {f.name: f.dataType for f in table.schema.fields}
    return table.withColumns(
        {c: F.when(condition, v.cast(types[c])).otherwise(F.col(c)) for c, v in values.items()}
    )


def insert_by_name(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows by column name; columns they lack become NULL, columns the table lacks are refused."""
    extra = [c for c in rows.columns if c not in table.columns]
    if extra:
        raise ValueError(f"the table lacks {', '.join(extra)}")
    have = set(rows.columns)
    typed = rows.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema.fields]
    )
    return table.unionByName(typed)


def constant_rows(table: DataFrame, rows: list[dict[str, object]]) -> DataFrame:
    """Constant rows in the types of the table, to insert."""
    spark = table.sparkSession
    types = {f.name: f.dataType for f in table.schema.fields}
    made = [
        spark.range(1).select(*[F.lit(v).cast(types[c]).alias(c) for c, v in row.items()]) for row in rows
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), made)
