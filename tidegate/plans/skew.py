"""Joins that stay even when one key holds a large share of the rows.

Adaptive execution splits the hot side of a sort-merge join only if both sides are freshly shuffled for it. Where one side is
itself the result of a join or an aggregate on the same key, these helpers take over.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidegate.session import written

SALTS = 16
TASK_ROWS = 1_000_000


def salted_join(
    facts: DataFrame, lookup: DataFrame, on: Sequence[str], by: Sequence[str], how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Join many rows to a much smaller table. Rows with the same key are dealt out to ``salts`` tasks by a hash of ``by``.

    ``by`` should tell rows of one key apart. Each row of ``lookup`` is sent to every salt, so nothing is lost.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("only the first table can be spread")
    dealt = facts.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return dealt.join(copies, [*on, "_salt"], how).drop("_salt")


def measured_join(
    facts: DataFrame, lookup: DataFrame, on: Sequence[str], by: Sequence[str], how: str = "inner", rows: int = TASK_ROWS
) -> DataFrame:
    """As ``salted_join``, with as many salts for a key as it has times ``rows`` rows, and none for all other keys.

    The keys of ``facts`` are counted first, combined before the shuffle. At most one in ``rows`` rows can be a hot key, so
    what is known of them stays small; only their rows of ``lookup`` are copied. NULL keys are dealt out as well.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("only the first table can be spread")
    counts = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows)
    names = [f"_hot_{i}" for i in range(len(on))]
    hot = written(counts.select(*[F.col(c).alias(n) for c, n in zip(on, names)], F.ceil(F.col("_n") / rows).cast("int").alias("_salts")), "hot")

    def with_salts(df: DataFrame) -> DataFrame:
        same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(hot[n]) for c, n in zip(on, names)])
        return df.join(hot, same, "left").drop(*names).withColumn("_salts", F.coalesce("_salts", F.lit(1)))

    dealt = with_salts(facts).withColumn("_salt", F.pmod(F.xxhash64(*by), F.col("_salts")).cast("int")).drop("_salts")
    copies = with_salts(lookup).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    return dealt.join(copies, [*on, "_salt"], how).drop("_salt")


def thinned(keys: DataFrame) -> DataFrame:
    """Keys for a semi- or anti-join, repeats dropped within each partition.

    A hot key shrinks to one row per input partition before it is shuffled. Dropping all repeats would leave this side
    partitioned by the key, and adaptive execution could then no longer split the other side.
    """
    return keys.withColumn("_part", F.spark_partition_id()).distinct().drop("_part")
