"""Line dedup by content-defined chunks.

A rolling hash over the hashes of the last ``WINDOW`` lines says after which lines a chunk ends, so an inserted or missing line
moves boundaries only near itself. Documents have few lines, so the window is a single line and every second line ends a chunk in
the mean: a shared passage has the same boundaries from its first line on. A chunk of two lines or more whose bytes also occur earlier, in order of doc_id and place,
is removed; the first occurrence stays.

Texts are cut at line feeds; null and empty texts are one empty line and lose nothing. Chunks without a word stay. Rows with the
same doc_id and text count as one document and lose the same chunks; a null doc_id comes after all others, and such documents
keep what has no earlier occurrence. Other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm.common import folded, has_word, unfolded
from tidegate.session import written

WINDOW = 1
DIVISOR = 2
FACTOR = 1_000_003
MODULUS = 2_147_483_647
MIN_LINES = 2
LAST = (1 << 62) - 1  # sorts documents without a doc_id behind all others


def chunked(docs: DataFrame) -> DataFrame:
    """Add ``_chunks``: the text as an array of chunks, in order; joined by line feeds they are the text."""
    df = docs.withColumn("_lines", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    df = df.withColumn("_hashes", F.expr("transform(_lines, x -> cast(conv(substr(md5(x), 1, 8), 16, 10) AS bigint))"))
    rolled = " + ".join(f"coalesce(get(_hashes, i - {k}), 0L) * {pow(FACTOR, k, MODULUS) % 65_521}L" for k in range(WINDOW))
    ends = f"filter(transform(_hashes, (x, i) -> IF(i = size(_hashes) - 1 OR ({rolled}) % {MODULUS} % {DIVISOR} = 0, i, -1)), i -> i >= 0)"
    df = df.withColumn("_ends", F.expr(ends))
    cut = "transform(_ends, (e, k) -> slice(_lines, coalesce(get(_ends, k - 1), -1) + 2, e - coalesce(get(_ends, k - 1), -1)))"
    df = df.withColumn("_parts", F.expr(cut))
    df = df.withColumn("_chunks", F.transform("_parts", lambda x: F.array_join(x, "\n")))
    return df.withColumn("_sizes", F.transform("_parts", F.size)).drop("_lines", "_hashes", "_ends", "_parts")


def _doc(df: DataFrame) -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))


def _each(df: DataFrame) -> DataFrame:
    """One row per multi-line chunk: its document, place, hash and bytes."""
    parts = df.select(_doc(df).alias("doc"), F.xxhash64("text").alias("row"), F.posexplode(F.arrays_zip("_chunks", "_sizes")).alias("at", "part"))
    parts = parts.where((F.col("part._sizes") >= MIN_LINES) & has_word(F.col("part._chunks")))
    return parts.select("doc", "row", "at", F.md5("part._chunks").alias("hash"), F.col("part._chunks").alias("bytes"))


def _place(doc: str, at: str) -> Column:
    return F.col(doc).cast("decimal(38,0)") * F.lit(1_000_000_000).cast("decimal(10,0)") + F.col(at)


def repeats(df: DataFrame) -> DataFrame:
    """``doc, row, gone``: per doc_id and hash of the text the keys ``place:hash`` of the chunks that occur earlier.

    The hash of the text bounds a group by the chunks of one text, however many rows share a doc_id or have none.

    Grouping compares the bytes themselves, and a map-side minimum shrinks copies before the shuffle. A hash under which two
    different texts were found (none is known for this hash) removes nothing.
    """
    each = _each(df)
    texts = each.groupBy("hash", "bytes").agg(F.min(_place("doc", "at")).alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = texts.groupBy("hash").agg(F.min("first").alias("first"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
    firsts = written(firsts.where("n > 1 AND texts = 1").select(F.col("hash").alias("h"), "first"), "chunks")
    places = each.select("doc", "row", "at", "hash").join(firsts, F.col("hash") == F.col("h"))
    later = places.where(_place("doc", "at") > F.col("first"))
    return later.groupBy("doc", "row").agg(F.collect_set(F.concat_ws(":", "at", "hash")).alias("gone"))


USED = ("doc_id", "text")


def _deduplicated(docs: DataFrame) -> DataFrame:
    df = chunked(folded(docs, *USED))
    gone = written(repeats(df), "repeats").withColumnsRenamed({"doc": "_d", "row": "_r"})
    df = df.join(gone, (_doc(df) == F.col("_d")) & (F.xxhash64("text") == F.col("_r")), "left")
    keys = F.transform("_chunks", lambda x, i: F.concat_ws(":", i, F.md5(x)))
    df = df.withColumn("_stay", F.array_except(keys, F.coalesce("gone", F.array().cast("array<string>"))))
    df = df.withColumn("_stay", F.transform("_stay", lambda x: F.substring_index(x, ":", 1).cast("int")))
    same = F.size("_stay") == F.size("_chunks")
    text = F.when(same, F.col("text")).otherwise(F.array_join(F.transform("_stay", lambda i: F.get("_chunks", i)), "\n"))
    return df.withColumn("_kept", text)


def deduplicated(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` without repeated chunks in their text."""
    df = _deduplicated(docs)
    return df.select(*unfolded(df, docs.columns, USED, text=F.col("_kept")))


def report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, the text that stays, n_chunks, n_removed_chunks and n_removed_lines."""
    df = _deduplicated(docs)
    total = F.aggregate("_sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    left = F.aggregate("_stay", F.lit(0).cast("long"), lambda a, i: a + F.get("_sizes", i))
    return df.select(
        "doc_id",
        F.col("_kept").alias("text"),
        F.size("_chunks").cast("long").alias("n_chunks"),
        (F.size("_chunks") - F.size("_stay")).cast("long").alias("n_removed_chunks"),
        (total - left).alias("n_removed_lines"),
    )
