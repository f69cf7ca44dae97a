"""A sieve in front of an exact join: a distributed Bloom filter with one hash, made of built-in bitmaps.

Every wanted key sets one of a power of two of bits, at least ``BITS`` of them a key. The bits are collected in bitmaps of 4 KB by a
partial aggregate. Rows whose bit is not set cannot match, so they are dropped where they are read, before anything is shuffled;
the few that slip through are for the exact join behind. The bitmaps are broadcast, so their size has a bound, ``MOST`` bits (32 MB): beyond it there
is no sieve and all rows go to the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS = 16
LEAST = 1 << 15
MOST = 1 << 28


def sieve_size(keys: int) -> int | None:
    """Bits for that many keys, None if they were too many."""
    size = max(LEAST, 1 << (BITS * keys - 1).bit_length() if keys else LEAST)
    return size if size <= MOST else None


def _slot(key: Column, size: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(size)) + 1  # bitmaps count from one


def likely(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows whose key is in the one column of ``wanted``, and about one in ``BITS`` others; null keys are dropped.

    ``wanted`` is counted and read again, so it should be written.
    """
    size = sieve_size(wanted.count())
    if size is None:
        return rows
    slot = _slot(F.col(wanted.columns[0]), size)
    marks = wanted.groupBy(F.bitmap_bucket_number(slot).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_bits"))
    mine = _slot(F.col("_key"), size)
    found = rows.select(F.struct(*rows.columns).alias("_row"), F.col(column).alias("_key")).filter("_key IS NOT NULL")
    found = found.select("_row", F.bitmap_bit_position(mine).alias("_at"), F.bitmap_bucket_number(mine).alias("_of"))
    joined = found.join(F.broadcast(marks), F.col("_of") == F.col("_bucket"))
    byte = F.conv(F.hex(F.substring("_bits", (F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, (F.col("_at") % 8).cast("int")).bitwiseAND(F.lit(1))
    return joined.filter(bit == 1).select("_row.*")
