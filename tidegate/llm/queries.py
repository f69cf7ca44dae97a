"""The operators as queries over the given tables, with SQL that states a result where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.llm import html_text, line_chunks, mixing, packing, periodic_runs, projection_forest, quality_rules, secrets, simhash, suffix_dedup, surrogates, token_alignment, warc
from tidegate.llm.common import table
from tidegate.llm.oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op1_projection_forest(spark, d):
    return projection_forest.near_duplicates(table(spark, d, "embeddings"))


@query
def op2_surrogates(spark, d):
    return surrogates.replaced(table(spark, d, "documents")).select("doc_id", "text", "n_entities")


@query
def op3_simhash_vantage(spark, d):
    return simhash.grouped(table(spark, d, "documents"))


@query
def op4_page_text(spark, d):
    return html_text.main_texts(table(spark, d, "pages"))


@query
def op5_secret_automaton(spark, d):
    return secrets.secrets(table(spark, d, "documents"))


@query
def op6_quality_rules(spark, d):
    return quality_rules.judged(table(spark, d, "documents"))


@query
def op7_source_mix(spark, d):
    return mixing.mixed(table(spark, d, "documents"))


@query
def op8_best_two_fit(spark, d):
    return packing.packed(table(spark, d, "documents"))


@query
def op9_line_chunks(spark, d):
    df = line_chunks.report(table(spark, d, "documents"))
    return df.select(
        "doc_id", "n_chunks", "n_removed_chunks", "n_removed_lines", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


@query
def op10_suffix_dedup(spark, d):
    return suffix_dedup.removed(table(spark, d, "documents"))


@query
def op11_warc(spark, d):
    return warc.round_trip(table(spark, d, "pages"))


@query
def op12_periodic_runs(spark, d):
    return periodic_runs.periodic_runs(table(spark, d, "documents"), changed=periodic_runs.planted)


@query
def op13_token_alignment(spark, d):
    return token_alignment.alignment(table(spark, d, "documents"))
