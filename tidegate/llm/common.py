"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.session import written

# White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def has_word(text: Column) -> Column:
    return F.ltrim(text, F.lit(SPACES)) != ""


def folded(docs: DataFrame, *used: str) -> DataFrame:
    """The used columns, and all others folded into ``_rest``, so that no name can clash with one that an operator adds."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in used]
    return docs.select(*used, (F.struct(*rest) if rest else F.lit(0)).alias("_rest"))


def unfolded(df: DataFrame, columns: list[str], used: tuple[str, ...], **new: Column) -> list[Column]:
    """The columns that ``folded`` was given, in their order; ``new`` replaces used ones."""
    return [(new[c] if c in new else df[c] if c in used else F.col(f"_rest.`{c}`")).alias(c) for c in columns]


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1, the smallest node reachable over the given links."""
    roots = np.arange(n)
    while True:
        low = np.minimum(roots[left], roots[right])
        new = roots.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, roots[left], low)
        np.minimum.at(new, roots[right], low)
        new = new[new]
        if np.array_equal(new, roots):
            return roots
        roots = new


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node, root`` for every node that has an edge to another one; the root is the smallest node reachable.

    Alternates two steps until nothing changes: link all larger neighbours of a node to its smallest neighbour, then link all
    smaller neighbours and the node itself to the smallest of them. Both are a minimum per node, combined before the shuffle,
    and a join with those minima, which are written first so that adaptive execution may split it: a node with very many neighbours
    is no single task's work. Each round is written to the shared folder; only a count and a checksum come to the driver.
    """
    a, b = F.col(left), F.col(right)
    current = written(edges.where(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "edges")
    state = _state(current)
    while state[0]:
        both = current.union(current.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").alias("n"), F.least("hi", "m").alias("m"))
        least = written(least, "least")
        large = both.join(least, F.col("hi") == F.col("n")).where(F.col("lo") > F.col("hi")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        large = written(large.distinct(), "large")
        first = written(large.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").alias("n"), "m"), "first")
        small = large.join(first, F.col("hi") == F.col("n")).where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        current = written(small.union(first.select(F.col("n").alias("hi"), F.col("m").alias("lo"))).distinct(), "edges")
        before, state = state, _state(current)
        if before == state:
            break
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
