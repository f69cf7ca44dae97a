"""Join names to the patterns they match without comparing every name to every pattern.

A pattern starts with a *head*: the characters before its first variable-length wildcard. The head fixes which characters
a matching name has at which positions, so names and patterns can be joined on those characters first, and only the
pairs that agree are tested against the full pattern. Heads of the same length with one-character wildcards in the same
places share a *shape*; a name takes part once per shape, and there are at most ``MAX_SHAPES`` + 9 of them.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

MAX_SHAPES = 64
_SHORT_HEADS = (128, 64, 32, 16, 8, 4, 2, 1, 0)


def glob_to_regex(pattern: Column) -> Column:
    """Anchored regular expression for a file-name pattern. ``%`` counts as ``*``; ``_`` is an ordinary character."""
    out = F.regexp_replace(pattern, r"([.^$+{}()|\\])", r"\\$1")
    out = F.regexp_replace(out, r"\[(?!.[^\]]*\])", r"\\[")
    out = F.regexp_replace(out, r"\[!", "[^")
    out = F.regexp_replace(out, "[%*]+", ".*")
    out = F.regexp_replace(out, r"(?<!\\)\?", ".")
    return F.concat(F.lit(r"(?s)\A"), out, F.lit(r"\z"))


def _probe(name: Column, shape: str) -> Column:
    """The characters of ``name`` that a head of this shape fixes; NULL if the name is too short."""
    pieces = [
        F.substring(name, run.start() + 1, len(run.group())) if run.group()[0] == "x" else F.lit(run.group())
        for run in re.finditer("x+|_+", shape)
    ]
    return F.when(F.length(name) >= len(shape), F.concat(*pieces) if pieces else F.lit(""))


def _join(
    names: DataFrame,
    name: str,
    patterns: DataFrame,
    pattern: str,
    head: Column,
    shape: Column,
    ends: Column,
    test: Column,
    on: Sequence[str],
    catalog: DataFrame | None,
) -> DataFrame:
    known = (patterns if catalog is None else catalog).filter(F.col(pattern).isNotNull()).select(shape.alias("_shape"))
    top = known.groupBy("_shape").count().orderBy(F.desc("count"), "_shape").limit(MAX_SHAPES)
    common = [r["_shape"] for r in top.collect()]
    shaped = patterns.filter(F.col(pattern).isNotNull()).select("*", head.alias("_head"), shape.alias("_shape"))
    if not common:
        common = [""]
    # Heads of a rarer shape are cut to a plain prefix, which is still necessary for a match.
    plain = F.regexp_extract("_head", "^[^_]*", 0)
    cut = reduce(
        lambda rest, n: F.when(F.length(plain) >= n, F.substring(plain, 1, n)).otherwise(rest),
        reversed(_SHORT_HEADS[:-1]),
        F.lit(""),
    )
    usual = F.col("_shape").isin(common)
    keyed = shaped.select(
        *patterns.columns,
        F.when(usual, F.col("_shape")).otherwise(F.repeat(F.lit("x"), F.length(cut))).alias("_shape"),
        F.when(usual, F.col("_head")).otherwise(cut).alias("_key"),
        (usual & ends).alias("_sure"),
    )
    shapes = list(dict.fromkeys(common + (["x" * n for n in _SHORT_HEADS] if len(common) == MAX_SHAPES else [])))
    probes = F.array(*[F.struct(F.lit(s).alias("shape"), _probe(F.col(name), s).alias("key")) for s in shapes])
    probed = names.select("*", F.explode(probes).alias("_p")).filter(F.col("_p.key").isNotNull())
    probed = probed.select(*names.columns, F.col("_p.shape").alias("_shape"), F.col("_p.key").alias("_key"))
    # A pattern that is its head and one last wildcard is decided by the join; only the others are tested.
    return probed.join(keyed, ["_shape", "_key", *on]).filter(F.when(F.col("_sure"), True).otherwise(test)).drop("_shape", "_key", "_sure")


def like_join(
    names: DataFrame,
    name: str,
    patterns: DataFrame,
    pattern: str,
    on: Sequence[str] = (),
    catalog: DataFrame | None = None,
) -> DataFrame:
    """Pairs where ``name LIKE pattern``; ``%`` and ``_`` are wildcards.

    ``catalog`` is a cheaper table with the same patterns, to look up the shapes in.
    """
    # A backslash escapes the next character, so the head ends before it, and at the first wildcard of either kind.
    head = F.when(F.contains(pattern, F.lit("\\")), F.regexp_extract(pattern, r"^[^%_\\]*", 0)).otherwise(
        F.regexp_extract(pattern, "^[^%]*", 0)
    )
    shape = F.regexp_replace(head, "(?s)[^_]", "x")
    test = F.like(F.col(name), F.col(pattern))
    ends = (F.col(pattern) == F.concat(head, F.lit("%"))) & ~F.contains(pattern, F.lit("\\"))
    return _join(names, name, patterns, pattern, head, shape, ends, test, on, catalog)


def glob_join(
    names: DataFrame,
    name: str,
    patterns: DataFrame,
    pattern: str,
    on: Sequence[str] = (),
    catalog: DataFrame | None = None,
) -> DataFrame:
    """Pairs where the whole ``name`` matches a file-name pattern; case matters."""
    head = F.regexp_extract(pattern, r"^[^%*?\[]*", 0)
    shape = F.regexp_replace(head, "(?s).", "x")
    ends = F.col(pattern).isin(F.concat(head, F.lit("%")), F.concat(head, F.lit("*")))
    test = F.rlike(F.col(name), glob_to_regex(F.col(pattern)))
    return _join(names, name, patterns, pattern, head, shape, ends, test, on, catalog)
