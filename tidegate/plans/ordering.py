"""Numbering and running totals over a whole table without a single-task window.

The table is range-partitioned, so partitions follow each other in the requested order. Each partition works out its own
positions, and one small total per partition (at most one row per shuffle partition) says where each of them starts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.session import written

_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row position in its low 33 bits


def _chunked(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range-partition and sort, note partition and position, and keep the result on shared storage.

    Keeping it makes both passes below see the same partitions even if executors are lost in between.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    tagged = ranged.withColumn("_at", F.monotonically_increasing_id())
    return written(
        tagged.select(
            *df.columns,
            F.shiftright("_at", 33).alias("_chunk"),
            F.col("_at").bitwiseAND(F.lit(_LOW_BITS)).alias("_pos"),
        ),
        "ordered",
    )


def _starts(chunk_totals: DataFrame, names: Sequence[str]) -> DataFrame:
    """Total of all earlier chunks. One row per partition, so the single-task window here is bounded."""
    earlier = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    return chunk_totals.select("_chunk", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_start_{n}") for n in names])


def number_rows(df: DataFrame, order: Sequence[Column], name: str, first: Column) -> DataFrame:
    """Add consecutive numbers from ``first`` in the given order, which must not have ties."""
    chunked = _chunked(df, order)
    starts = _starts(chunked.groupBy("_chunk").agg(F.count(F.lit(1)).alias("n")), ["n"])
    return chunked.join(F.broadcast(starts), "_chunk").select(
        *df.columns, (first + F.col("_start_n") + F.col("_pos")).cast("long").alias(name)
    )


def running_totals(df: DataFrame, order: Sequence[Column], sums: dict[str, str]) -> DataFrame:
    """Add, for each ``column -> name``, the total of ``column`` up to and including the row."""
    chunked = _chunked(df, order)
    starts = _starts(chunked.groupBy("_chunk").agg(*[F.sum(c).alias(c) for c in sums]), list(sums))
    inside = Window.partitionBy("_chunk").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    return (
        chunked.select("*", *[F.sum(c).over(inside).alias(f"_inside_{c}") for c in sums])
        .join(F.broadcast(starts), "_chunk")
        .select(*df.columns, *[(F.col(f"_start_{c}") + F.col(f"_inside_{c}")).alias(n) for c, n in sums.items()])
    )


def next_id(table: DataFrame, column: str) -> Column:
    """One more than the highest id, or 1 for an empty table, as a scalar subquery."""
    return table.agg((F.coalesce(F.max(column), F.lit(0)) + 1).cast("long")).scalar()


def line_places(df: DataFrame, file: str, block: str, at: str, place: str, total: str | None = None) -> DataFrame:
    """Add the place of each row in its file, from 1, and on request how many rows the file has.

    ``block`` is the offset of the file split a row came from and ``at`` its ``monotonically_increasing_id``; rows of one
    split have consecutive ids. So a row's place follows from its split alone plus the sizes of earlier splits, and a file
    that holds most of the data is still numbered by many tasks. Rows are not copied: a first pass counts them per split, a
    second one, whenever the result is read, gives the numbers. ``df`` must come from a scan, so that both passes see the same
    splits; a row that the first pass did not see at its place is an error.
    """
    counts = df.groupBy(file, block).agg(F.min(at).alias("_first"), F.max(at).alias("_last"), F.count(F.lit(1)).alias("_size"))
    sizes = written(counts, "splits")
    earlier = Window.partitionBy(file).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col(file).alias("_file"),
        F.col(block).alias("_block_at"),
        "_first",
        "_last",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_size").over(Window.partitionBy(file)).alias("_total"),
    )
    joined = df.join(starts, (F.col(file) == F.col("_file")) & (F.col(block) == F.col("_block_at")), "left")
    seen = (F.col(at) >= F.col("_first")) & (F.col(at) <= F.col("_last"))
    number = F.when(seen, F.col("_before") + F.col(at) - F.col("_first") + 1).otherwise(F.raise_error(F.lit("the splits of a file have changed")))
    return joined.select(*df.columns, number.cast("long").alias(place), *([F.col("_total").alias(total)] if total else []))


def number_lines(df: DataFrame, file: str, block: str, at: str, name: str) -> DataFrame:
    """Number the rows of each file from 1 in file order; see ``line_places``."""
    return line_places(df, file, block, at, name)
