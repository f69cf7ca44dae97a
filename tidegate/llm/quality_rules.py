"""Quality rules: lines that many documents of one host share are removed, and documents with too little left are rejected.

The host is ``documents.source``; a null source is a host of its own. A line counts once per distinct text, so exact copies of
a document don't make its lines common: they are left to the near-duplicate stage. A line is over the limit if it occurs in more
than ``LIMIT_SHARE`` of the host's distinct texts and in more than ``LIMIT_TEXTS`` of them.

Near copies make each other's lines common. Of the documents of a host that pass the base rules but have less than
``MIN_LEFT_PERCENT`` of their words outside the same set of common lines, the one with the smallest doc_id therefore stays, with
its whole text, so that the later stages have one of each group to keep.

Lines are compared in lower case with runs of white space as one space, by a 64-bit hash. Null and empty texts have no words
and fail the base rules. Repeated rows are judged alike. Other columns pass through
untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm.common import folded, has_word, unfolded, words
from tidegate.session import written

LIMIT_SHARE = 0.05
LIMIT_TEXTS = 20
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_LEFT_PERCENT = 30
NO_SYMBOL = "[^#*$%&|<>]+"
LAST = (1 << 62) - 1  # sorts documents without a doc_id behind all others


def normalised(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def common_lines(docs: DataFrame, share: float = LIMIT_SHARE, texts: int = LIMIT_TEXTS) -> DataFrame:
    """``host, common``: per host the hashes of the lines over the limit.

    Each distinct text of a host holds a line at most once, so a host has at most (mean lines of a text) / ``share`` of them.
    """
    base = docs.select(F.col("source").alias("host"), F.xxhash64("text").alias("doc"), _lines(F.col("text")).alias("lines"))
    hosts = base.select("host", "doc").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("of"))
    each = base.select("host", "doc", F.explode("lines").alias("line")).where(has_word(F.col("line")))
    each = each.select("host", "doc", F.xxhash64(normalised(F.col("line"))).alias("line")).distinct()
    counts = each.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > texts)
    h = hosts.select(F.col("host").alias("_host"), "of")
    over = counts.join(h, F.col("host").eqNullSafe(F.col("_host"))).where(F.col("n") > share * F.col("of"))
    return over.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("common"))


def with_counts(docs: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words, all over the whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.withColumn("_words", words(text)).withColumn("n_words", F.size("_words").cast("long"))
    df = df.withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
    df = df.withColumn("n_symbols", F.length(F.regexp_replace(text, NO_SYMBOL, "")).cast("long"))
    df = df.withColumn("_lines", F.filter(_lines(F.col("text")), has_word))
    df = df.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    windows = F.expr("transform(slice(_words, 1, greatest(n_words - 2, 0L)), (x, i) -> xxhash64(x, _words[i + 1], _words[i + 2]))")
    df = df.withColumn("_triples", windows)
    return df.withColumn("n_repeat_words", _repeated())


def _repeated() -> Column:
    """Words covered by 3-word windows that occur twice or more.

    Equal windows are neighbours once sorted with their positions; each of them covers three words, or fewer up to the next.
    """
    pairs = "sort_array(transform(_triples, (x, i) -> struct(x AS h, i AS i)))"
    twice = "transform(filter(p, (s, i) -> get(p, i - 1).h = s.h OR get(p, i + 1).h = s.h), s -> s.i)"
    covered = "aggregate(transform(q, (x, i) -> least(3, coalesce(get(q, i + 1), x + 3) - x)), 0L, (a, x) -> a + x)"
    positions = f"transform(array({pairs}), p -> sort_array({twice}))"
    return F.expr(f"CASE WHEN size(array_distinct(_triples)) = size(_triples) THEN 0L ELSE transform({positions}, q -> {covered})[0] END")


USED = ("doc_id", "source", "text")


def _listed(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """For documents with ``_words`` and ``_lines``: ``n_common_words``, and ``_lost``, the common lines of a text that has little else."""
    df = docs.join(lists, F.col("source").eqNullSafe(F.col("_host")), "left").drop("_host")
    found = F.filter("_lines", lambda x: F.array_contains("_common", F.xxhash64(normalised(x))))
    df = df.withColumn("_found", F.when(F.col("_common").isNotNull(), found))
    lost = F.aggregate("_found", F.lit(0).cast("long"), lambda a, x: a + F.size(words(x)))
    df = df.withColumn("n_common_words", F.coalesce(lost, F.lit(0).cast("long")))
    hashes = F.transform("_found", lambda x: F.xxhash64(normalised(x)))
    return df.withColumn("_lost", F.when(_mostly_common(F.col("n_words")), hashes)).drop("_found")


def _mostly_common(n_words: Column) -> Column:
    return (F.col("n_common_words") > 0) & (100 * (n_words - F.col("n_common_words")) < MIN_LEFT_PERCENT * n_words)


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _set() -> Column:
    """The set of common lines of a document that has little else; any other document has a set of its own."""
    return F.coalesce(F.xxhash64(F.sort_array(F.array_distinct("_lost"))), F.xxhash64("doc_id", "text"))


def _doc() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))


def _firsts(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """``_of, _set, _first``: per host and set of common lines the smallest document that consists of little else."""
    df = docs.withColumn("n_words", F.size(words(F.col("text"))).cast("long"))
    df = _listed(df.withColumn("_lines", F.filter(_lines(F.col("text")), has_word)), lists)
    # As in ``filtered``, the number keeps the filters above the arrays that they read.
    df = df.withColumn("_row", F.monotonically_increasing_id()).where("_lost IS NOT NULL AND _row >= 0")
    near = written(df.select("doc_id", "source", "text", _set().alias("_set")), "near_copies")
    sets = with_counts(near).withColumn("_first", F.when(~_base_failed(), _doc()))
    sets = sets.groupBy(F.col("source").alias("_of"), F.col("_set").alias("_s")).agg(F.min("_first").alias("_first"))
    return sets.where("_first IS NOT NULL")


def _judged(docs: DataFrame, share: float, texts: int) -> DataFrame:
    lists = written(common_lines(docs, share, texts), "common_lines")
    lists = lists.select(F.col("host").alias("_host"), F.col("common").alias("_common"))
    base = folded(docs, *USED)
    firsts = written(_firsts(base, lists), "firsts")
    df = _listed(with_counts(base), lists)
    if firsts.isEmpty():
        df = df.withColumn("_whole", F.lit(False))
    else:
        df = df.withColumn("_set", _set())
        df = df.join(firsts, F.col("source").eqNullSafe(F.col("_of")) & (F.col("_set") == F.col("_s")), "left")
        df = df.withColumn("_whole", F.col("_lost").isNotNull() & F.coalesce(_doc() == F.col("_first"), F.lit(False))).drop("_of", "_s", "_set", "_first")
    left = F.col("n_words") - F.col("n_common_words")
    depleted = _mostly_common(F.col("n_words")) | ((F.col("n_common_words") > 0) & (left < MIN_WORDS))
    df = df.withColumn("base_failed", _base_failed()).withColumn("kept", ~F.col("base_failed") & (~depleted | F.col("_whole")))
    return df.drop("_words", "_triples", "_lines", "_lost")


def judged(docs: DataFrame, share: float = LIMIT_SHARE, texts: int = LIMIT_TEXTS) -> DataFrame:
    """Per row: doc_id, the counts, ``n_common_words`` (words in lines over the limit), ``base_failed`` and ``kept``.

    A document is kept if it passes the base rules and, without its common lines, still has ``MIN_WORDS`` words and
    ``MIN_LEFT_PERCENT`` of those it had, or if it is the first of a group of near copies.
    """
    kept = _judged(docs, share, texts)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_common_words")
    return kept.select("doc_id", *counts, "base_failed", "kept")


def filtered(docs: DataFrame, share: float = LIMIT_SHARE, texts: int = LIMIT_TEXTS) -> DataFrame:
    """The kept documents without their common lines, in the columns of ``docs``; the first of a group of near copies stays whole."""
    # A number per row, which the filter reads, keeps the optimizer from moving the filter below the counts: merged into them,
    # their arrays would be worked out anew for every word.
    df = _judged(docs, share, texts).withColumn("_row", F.monotonically_increasing_id()).where("kept AND _row >= 0")
    left = F.filter(_lines(F.col("text")), lambda x: ~(has_word(x) & F.array_contains("_common", F.xxhash64(normalised(x)))))
    cleaned = F.when((F.col("n_common_words") > 0) & ~F.col("_whole"), F.array_join(left, "\n")).otherwise(F.col("text"))
    return df.select(*unfolded(df, docs.columns, USED, text=cleaned))
