"""Mixing sources to target weights: hash-random order within each source, distributed prefix sums, exact cut at the budget.

Sizes are words. Weights are dealt to the sources in code-point order, null last. All targets together are ``SHARE`` of all
sizes; no target exceeds ``MAX_EPOCHS`` times its source's size, and what is above goes to the other sources by weight.

A source is repeated as often as its target holds it whole; the rest is cut from its documents in the order of a hash of the
doc_id, and the document on the border is cut too, so that every source gives its target to the word (rounded down). Runs
agree, because nothing but the rows decides. Rows with the same doc_id (and those where it is null) are ordered by a hash of
their text; rows that agree in both are interchangeable. Null and empty texts have size 0 and take nothing. Other
columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.llm.common import SPACES, folded, unfolded, words
from tidegate.plans.ordering import running_totals
from tidegate.session import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MAX_EPOCHS) -> DataFrame:
    """``_group, source_size, target, _before`` from ``_group, source_size``; one row per source in and out.

    Targets are ``min(most * size, level * weight)``. In the order of size / weight the first ones reach their limit; the level
    is what remains, per weight of the others. A window over one row per source, not over documents.
    """
    by_code = Window.orderBy("_group")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.row_number().over(by_code) - 1, F.lit(len(weights))) + 1)
    df = sizes.withColumn("_weight", weight.cast("double"))
    df = df.withColumn("_before", F.coalesce(F.sum("source_size").over(by_code.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    everything = Window.partitionBy()
    size = F.col("source_size").cast("double")
    order = Window.orderBy(size / F.col("_weight"), "_group").rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_budget", share * F.sum(size).over(everything)).withColumn("_all", F.sum("_weight").over(everything))
    df = df.withColumn("_full", most * F.coalesce(F.sum(size).over(order), F.lit(0.0))).withColumn("_gone", F.coalesce(F.sum("_weight").over(order), F.lit(0.0)))
    level = (F.col("_budget") - F.col("_full")) / (F.col("_all") - F.col("_gone"))
    fits = level * F.col("_weight") <= most * size
    df = df.withColumn("_level", F.min(F.when(fits, F.struct(size / F.col("_weight"), F.col("_group"), level.alias("level")))).over(everything)["level"])
    target = F.least(most * size, F.coalesce(F.col("_level") * F.col("_weight"), most * size))
    return df.select("_group", "source_size", target.alias("target"), "_before")


def source_group(source: Column) -> Column:
    """Sorts by code point with null last, and never is null itself."""
    return F.struct(source.isNull().alias("none"), F.coalesce(source, F.lit("")).alias("name"))


def mixed(docs: DataFrame, *keep: str) -> DataFrame:
    """Per row: the ``keep`` columns, doc_id, size, source_size, target and taken (words, repeats counted)."""
    size = F.size(words(F.col("text"))).cast("long")
    rows = docs.select(F.col("doc_id"), *keep, source_group(F.col("source")).alias("_group"), F.xxhash64("text").alias("_text"), size.alias("size"))
    rows = rows.withColumn("_key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    ordered = running_totals(rows, [F.col("_group"), F.col("_key"), F.col("_text")], {"size": "_upto"})
    ordered = written(ordered, "mix_order")
    plan = targets(ordered.groupBy("_group").agg(F.sum("size").alias("source_size")))
    plan = written(plan, "mix_targets").withColumnRenamed("_group", "_of")
    df = ordered.join(plan, F.col("_group") == F.col("_of"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.floor(F.col("target")) - epochs * F.col("source_size")
    start = F.col("_upto") - F.col("size") - F.col("_before")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - start))
    return df.select("doc_id", *keep, "size", "source_size", "target", (epochs * F.col("size") + part).cast("long").alias("taken"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to its n-th word."""
    trimmed = F.ltrim(text, F.lit(SPACES))
    rest = F.get(F.split(trimmed, r"[\x20\x09-\x0D]+", n + 1), n)
    return F.rtrim(F.substring(trimmed, F.lit(1), F.length(trimmed) - F.length(rest)), F.lit(SPACES))


def drawn(docs: DataFrame) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row for each time a document is taken, the one on the border cut short."""
    used = ("doc_id", "source", "text")
    rows = folded(docs, *used).withColumn("_row", F.xxhash64(*used, F.to_json(F.struct("_rest"))))
    taken = mixed(rows, "_row").where("taken > 0").groupBy("doc_id", "_row", "size", "taken").agg(F.count(F.lit(1)).alias("_same"))
    taken = taken.select(F.col("_row").alias("_r"), F.col("doc_id").alias("_d"), "size", "taken", "_same")
    df = rows.dropDuplicates(["doc_id", "_row"]).join(taken, (F.col("_row") == F.col("_r")) & F.col("doc_id").eqNullSafe(F.col("_d")))
    part = F.col("taken") % F.col("size")
    cut = F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("_take", F.explode(F.concat(F.array_repeat(F.col("size"), F.expr("CAST(taken DIV size AS INT)")), cut)))
    df = df.withColumn("_again", F.explode(F.expr("sequence(1L, _same)")))  # rows that are alike
    whole = F.col("_take") == F.col("size")
    text = F.when(whole, F.col("text")).otherwise(first_words(F.col("text"), F.col("_take").cast("int")))
    return df.select(*unfolded(df, docs.columns, used, text=text))
