"""Embedding near-duplicates with a forest of random-projection trees.

Vectors are compared only within a label. Each of ``TREES`` trees splits the vectors of a label again and again at the median of
a random projection (one direction per tree and depth); vectors within ``spill`` of the median go to both sides. A node stays a
leaf once it has at most ``LEAF`` vectors, or if a split would leave nearly all of them on both sides. Within leaves all pairs are
compared by cosine in double precision, in blocks of bounded size. Two linked vectors are ``chord`` apart at most, so their
projections differ by about chord / sqrt(dimensions); a tree parts them only if both lie beyond the spill on different sides, and
a link is lost only if every tree does so.

A pair may share several leaves. Every vector carries the leaves it is in, and a pair counts only in the smallest one that both
share, so links are counted exactly without writing down pairs. Equal vectors of a label are one node with a number of copies;
copies link with each other.

Vectors that are null, empty or zero, or hold null or non-finite components, and vectors without a label, link with nothing.
Vectors of different length never link. Rows with the same vec_id are vectors of their own that share an id; a null vec_id stays
null and never names a component that has another id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidegate.llm.common import components, local_roots
from tidegate.session import written

COSINE = 0.98
TREES = 10
LEAF = 512
DEPTH = 40
SEED = 17
SPILL = 0.5  # in standard deviations of the difference between two projections at the largest distance that links


def _directions(dim: int, depth: int, trees: int, seed: int) -> np.ndarray:
    found = np.random.default_rng([seed, dim]).standard_normal((trees * depth, dim))
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def nodes(vectors: DataFrame) -> DataFrame:
    """Distinct usable vectors per label: ``rid, label, dim, vector, copies, least`` (smallest vec_id)."""
    usable = F.expr(
        "label IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))"
        " AND exists(embedding, x -> x <> 0)"
    )
    vector = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))  # -0.0 becomes 0.0
    plain = vectors.where(usable).select("vec_id", "label", vector.alias("vector"))
    same = plain.groupBy("label", "vector").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    return same.select(F.xxhash64("label", "vector").alias("rid"), "label", F.size("vector").alias("dim"), "vector", "copies", "least")


def _projected(found: DataFrame, trees: int, seed: int, spill: float, cosine: float, depth: int) -> DataFrame:
    """A row per vector and tree with its projections by depth."""

    def project(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, part in frame.groupby("dim"):
                x = np.stack(part["vector"].to_numpy())
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                at = (x @ _directions(int(dim), depth, trees, seed).T).reshape(len(part), trees, depth).astype(np.float32)
                margin = spill * math.sqrt(2 * (1 - cosine)) / math.sqrt(dim)
                for tree in range(trees):
                    yield pd.DataFrame({"rid": part["rid"], "label": part["label"], "dim": part["dim"], "tree": tree, "spill": margin, "at": list(at[:, tree])})

    return found.select("rid", "label", "dim", "vector").mapInPandas(project, "rid long, label string, dim int, tree int, spill double, at array<float>")


def placed(found: DataFrame, trees: int = TREES, leaf: int = LEAF, cosine: float = COSINE, spill: float = SPILL, seed: int = SEED, depth: int = DEPTH) -> DataFrame:
    """``leaf, rid``: the leaves of all trees."""
    found = found.withColumn("label", F.col("label").cast("string"))
    rows = _projected(found, trees, seed, spill, cosine, depth)
    rows = written(rows.select(F.xxhash64("label", "dim", "tree").alias("node"), "rid", "spill", "at"), "projected")
    done = None
    for level in range(depth):
        p = F.element_at("at", level + 1)
        node = rows.groupBy("node").agg(
            F.count(F.lit(1)).alias("n"), F.percentile_approx(p, [0.2, 0.5, 0.8], 1000).alias("q"), F.first("spill").alias("s")
        )
        q = F.col("q")
        cuts = node.where((F.col("n") > leaf) & (q[2] > q[1] + F.col("s")) & (q[0] < q[1] - F.col("s")))
        cuts = written(cuts.select(F.col("node").alias("_n"), q[1].cast("double").alias("cut")), "cuts")
        if cuts.isEmpty():
            break
        ended = rows.join(cuts, F.col("node") == F.col("_n"), "left_anti")
        done = ended if done is None else done.union(ended)
        split = rows.join(cuts, F.col("node") == F.col("_n"))
        sides = F.array_compact(F.array(F.when(p <= F.col("cut") + F.col("spill"), F.lit(0)), F.when(p > F.col("cut") - F.col("spill"), F.lit(1))))
        split = split.withColumn("side", F.explode(sides))
        rows = written(split.select(F.xxhash64("node", F.lit(level), "side").alias("node"), "rid", "spill", "at"), "projected")
    done = rows if done is None else done.union(rows)
    return done.select(F.col("node").alias("leaf"), "rid")


def _compared(found: DataFrame, leaves: DataFrame, cosine: float, block: int) -> DataFrame:
    """``rid, links, root``: per row of a block the links that count there, copies included, and an edge to a linked vector."""
    own = leaves.groupBy("rid").agg(F.sort_array(F.collect_set("leaf")).alias("leaves"))
    sizes = leaves.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = sizes.select(F.col("leaf").alias("_l"), F.ceil(F.col("n") / block).cast("int").alias("parts"))
    full = found.select("rid", "vector", "copies").join(own, "rid").withColumn("leaf", F.explode("leaves"))
    full = full.join(parts, F.col("leaf") == F.col("_l"))
    full = full.withColumn("part", F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    dealt = full.select("leaf", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", "rid", "copies", "vector", "leaves")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        leaf, a, b = int(frame["leaf"].iloc[0]), frame["a"].iloc[0], frame["b"].iloc[0]
        x = np.stack(frame["vector"].to_numpy())
        norm = np.sqrt(np.einsum("ij,ij->i", x, x))
        left, right = np.flatnonzero(frame["part"].to_numpy() == a), np.flatnonzero(frame["part"].to_numpy() == b)
        i, j = np.nonzero((x[left] @ x[right].T) / (norm[left][:, None] * norm[right][None, :]) >= cosine)
        i, j = left[i], right[j]
        i, j = (i[i < j], j[i < j]) if a == b else (i, j)
        counts = not_before(frame["leaves"].to_numpy(), leaf, i, j)
        roots = local_roots(len(frame), i, j)
        i, j = i[counts], j[counts]
        copies = frame["copies"].to_numpy().astype(np.int64)
        links = np.bincount(i, copies[j], len(frame)) + np.bincount(j, copies[i], len(frame))
        rid = frame["rid"].to_numpy()
        some = (links > 0) | (roots != np.arange(len(frame)))
        return pd.DataFrame({"rid": rid[some], "links": links[some].astype(np.int64), "root": rid[roots[some]]})

    def not_before(leaves_of: np.ndarray, leaf: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether no leaf smaller than this one holds both ends of a link."""
        if not len(i):
            return np.zeros(0, dtype=bool)
        rows = np.unique(np.concatenate((i, j)))
        smaller = [leaves_of[r][leaves_of[r] < leaf] for r in rows]
        names = np.unique(np.concatenate(smaller)) if any(map(len, smaller)) else np.zeros(0, dtype=np.int64)
        member = np.zeros((len(rows), len(names)), dtype=np.float32)
        for k, s in enumerate(smaller):
            member[k, np.searchsorted(names, s)] = 1
        shared = member @ member.T
        return shared[np.searchsorted(rows, i), np.searchsorted(rows, j)] == 0

    return dealt.groupBy("leaf", "a", "b").applyInPandas(compare, "rid long, links long, root long")


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL, seed: int = SEED
) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links (other vectors linked directly), component_id (smallest vec_id reachable) and kept."""
    found = written(nodes(vectors), "vectors")
    leaves = written(placed(found, trees, leaf, cosine, spill, seed), "leaves")
    compared = written(_compared(found, leaves, cosine, leaf), "compared")
    counts = compared.groupBy("rid").agg(F.sum("links").alias("links"))
    roots = components(compared.select("rid", "root"), "rid", "root")
    of = found.select("rid", "copies", "least").join(roots, F.col("rid") == F.col("node"), "left")
    of = of.select("rid", "copies", "least", F.coalesce("root", "rid").alias("root"))
    ids = of.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "_root")
    named = of.join(ids, F.col("root") == F.col("_root")).join(counts.withColumnRenamed("rid", "_rid"), F.col("rid") == F.col("_rid"), "left")
    named = written(named.select("rid", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "named")
    vector = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    out = vectors.select("vec_id", F.xxhash64("label", vector).alias("_key"), F.col("label").isNotNull().alias("_labelled"))
    out = out.join(named, F.col("_labelled") & (F.col("_key") == F.col("rid")), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
