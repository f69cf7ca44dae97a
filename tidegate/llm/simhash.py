"""SimHash near-duplicates: 64-bit fingerprints, linked at ``MAX_BITS`` or fewer differing bits, found with vantage-point trees.

The 64 bits are parted into ``MAX_BITS + 1`` blocks, and each block has a tree. A node of the tree picks ``VANTAGES`` of its fingerprints by hash,
measures the Hamming distance of all others to each within the block, and cuts at the median distances, so it falls into up to
2**VANTAGES cells. Two fingerprints that differ in ``MAX_BITS`` bits or fewer agree in one of the blocks. There their distance is
zero, so by the triangle inequality they have the same distance to every vantage point and no cut of that tree parts them: the
overlap that a query needs beyond a cut has width zero, every other branch is pruned, and each fingerprint is in just one leaf of
a tree. So every close pair meets in a leaf, and the pairs found, compared by all 64 bits, are exact.

A node of more than ``LEAF`` fingerprints that all agree in the block cannot be cut any further. Its fingerprints go into trees of their own over the
blocks of the bits that are left (16, then 12, 9, 6 bits and so on), in the same way. After six steps 12 bits are left, in which
there are no more than 4096 different fingerprints. So no leaf is larger than that, whatever the texts, and nothing is compared beyond its leaf.

Text is lower-cased in A-Z; words are runs without white space; shingles of three words keep their repeats. Fewer words make a
single shingle; null, empty and blank texts have fingerprint zero, linked like any other. Rows with a null doc_id are in a group
through their text; a group with no doc_id at all has a null id. Equal fingerprints are one node of the tree. Other columns
pass through untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm.common import components, folded, local_roots, unfolded
from tidegate.session import written

SHINGLE = 3
MAX_BITS = 3
VANTAGES = 3
LEAF = 4096
BLOCK = 256
LEAF_ROW, INNER, EQUAL = 0, 1, 2
SEED = 42
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
AT_ONCE = 1 << 15  # shingles whose bits are counted together


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint as an unsigned number."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    plain = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(plain[a:b], SEED) for a, b in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), AT_ONCE):
        some = np.array(hashes[at : at + AT_ONCE], dtype=">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The other columns of ``docs`` (doc_id, row) and ``fp``: the fingerprint as a signed 64-bit number."""
    rest = [c for c in docs.columns if c != "text"]

    def prints(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = np.array([fingerprint(t, shingle) for t in frame["text"]], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({**{c: frame[c].astype("Int64") for c in rest}, "fp": values})

    schema = ", ".join(f"{c} long" for c in [*rest, "fp"])
    return docs.select(*[F.col(c).cast("long") for c in rest], "text").mapInPandas(prints, schema)


def _forest(rows: DataFrame, width: int, parts: int) -> DataFrame:
    """A tree for each of ``parts`` blocks of the ``width`` bits in ``rest``: the block becomes ``key``, the other bits stay in ``rest``."""
    size, trees = width // parts, []
    for t in range(parts):
        at = t * size
        wide = size if t < parts - 1 else width - at
        key = F.shiftrightunsigned("rest", at).bitwiseAND(F.lit((1 << wide) - 1 if wide < 64 else -1))
        below = F.col("rest").bitwiseAND(F.lit((1 << at) - 1))
        above = F.lit(0).cast("long") if at + wide >= width else F.shiftleft(F.shiftrightunsigned("rest", at + wide), at)
        trees.append(F.struct(F.xxhash64("node", F.lit(t)).alias("node"), key.alias("key"), above.bitwiseOR(below).alias("rest")))
    return rows.select("fp", F.explode(F.array(*trees)).alias("t")).select("t.node", "fp", "t.key", "t.rest")


def _distance(vantage: str) -> Column:
    return F.bit_count(F.col("key").bitwiseXOR(F.col(vantage)))


def _nodes(rows: DataFrame, leaf: int) -> DataFrame:
    """``_n, equal, v0.., m0..`` for nodes of more than ``leaf`` rows: vantage points and where their distances are cut.

    A vantage point is a block of the node, so the distances to it start at zero; the cut is their median, or below the largest
    distance, so that both sides have rows. A node all of whose blocks are equal has no cuts.
    """
    picks = [F.min_by("key", F.xxhash64("fp", F.lit(i))).alias(f"v{i}") for i in range(VANTAGES)]
    sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), (F.min("key") == F.max("key")).alias("equal"), *picks)
    large = written(sizes.where(F.col("n") > leaf).drop("n").withColumnRenamed("node", "_n"), "large")
    away = rows.join(large.where("NOT equal"), F.col("node") == F.col("_n"))
    cuts = [F.least(F.percentile_approx(_distance(f"v{i}"), 0.5, 200), F.max(_distance(f"v{i}")) - 1).alias(f"m{i}") for i in range(VANTAGES)]
    cut = away.groupBy("node").agg(*cuts)
    return written(large.join(cut, F.col("_n") == F.col("node"), "left").drop("node"), "nodes")


def _placed(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """All rows with what becomes of them: LEAF_ROW, INNER (in the cell of their node that holds them) or EQUAL."""
    cell = F.lit(0)
    for i in range(VANTAGES):
        cell = cell + F.when(_distance(f"v{i}") > F.col(f"m{i}"), 1 << i).otherwise(0)
    state = F.when(F.col("_n").isNull(), LEAF_ROW).when(F.col("equal"), EQUAL).otherwise(INNER)
    node = F.when(state == INNER, F.xxhash64("node", cell)).otherwise(F.col("node"))
    return rows.join(nodes, F.col("node") == F.col("_n"), "left").select(node.alias("node"), "fp", "key", "rest", state.alias("state"))


def leaves(prints: DataFrame, bits: int = MAX_BITS, leaf: int = LEAF) -> DataFrame:
    """``node, fp`` for distinct fingerprints: the leaves of all trees. Fingerprints within ``bits`` share a leaf of one tree or more."""
    parts, width = bits + 1, 64
    rest = prints.select(F.lit(0).cast("long").alias("node"), "fp", F.col("fp").alias("rest"))
    done = []
    while rest is not None:
        rows, equal = written(_forest(rest, width, parts), "vantage"), []
        while True:
            nodes = _nodes(rows, leaf)
            if nodes.isEmpty():
                break
            placed = written(_placed(rows, nodes), "vantage")
            done.append(placed.where(F.col("state") == LEAF_ROW))
            equal.append(placed.where(F.col("state") == EQUAL))
            rows = placed.where(F.col("state") == INNER).drop("state")
        done.append(rows)
        width -= width // parts
        rest = reduce(DataFrame.unionByName, equal) if equal else None
        if rest is not None and width < parts:  # a handful of bits: no more fingerprints than they have values
            done.append(rest)
            rest = None
        if rest is not None and rest.isEmpty():
            rest = None
    return reduce(DataFrame.unionByName, [d.select("node", "fp") for d in done])


def links(placed: DataFrame, bits: int = MAX_BITS, at_once: int = BLOCK) -> DataFrame:
    """``a, b``: edges that connect all fingerprints within ``bits`` of each other; at most one per row of a leaf."""

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        nodes = np.unique(frame["fp"].to_numpy())
        fps = nodes.view(np.uint64)
        roots = np.arange(len(nodes))
        for at in range(0, len(nodes), at_once):
            i, j = np.nonzero(np.bitwise_count(fps[at : at + at_once, None] ^ fps[None, at:]) <= bits)
            apart = roots[at + i] != roots[at + j]
            if apart.any():
                left, right = np.concatenate((np.arange(len(nodes)), at + i[apart])), np.concatenate((roots, at + j[apart]))
                roots = local_roots(len(nodes), left, right)
        off = np.flatnonzero(roots != np.arange(len(nodes)))
        return pd.DataFrame({"a": nodes[off], "b": nodes[roots[off]]})

    return placed.groupBy("node").applyInPandas(compare, "a long, b long")


def _row_hash() -> Column:
    """Of a row with its other columns folded."""
    return F.xxhash64("doc_id", "text", F.to_json(F.struct("_rest")))


def _classes(docs: DataFrame, shingle: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their fingerprint and a hash of the row; and per fingerprint the one that stands for its group."""
    rows = folded(docs, "doc_id", "text").select("doc_id", "text", _row_hash().alias("row"))
    prints = written(with_fingerprints(rows, shingle), "fingerprints")
    nodes = written(prints.select("fp").distinct(), "nodes")
    roots = components(links(leaves(nodes, bits), bits), "a", "b")
    of = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(F.col("fp").alias("_fp"), F.coalesce("root", "fp").alias("root"))
    return prints, written(of, "classes")


def grouped(docs: DataFrame, shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable over links."""
    prints, of = _classes(docs, shingle, bits)
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).join(of, F.col("fp") == F.col("_fp"))
    ids = least.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "_root")
    named = written(of.join(ids, F.col("root") == F.col("_root")).select("_fp", "component_id"), "named")
    out = prints.join(named, F.col("fp") == F.col("_fp"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def first_of_each(docs: DataFrame, shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` per group: the one with the smallest doc_id, then the smallest hash of the row; null ids come last."""
    prints, of = _classes(docs, shingle, bits)
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    least = prints.groupBy("fp").agg(F.min(key).alias("key")).join(of, F.col("fp") == F.col("_fp"))
    stay = least.groupBy("root").agg(F.min("key").alias("key"))
    stay = written(stay.select(F.coalesce("key.doc_id", F.lit(-1)).alias("_d"), F.col("key.row").alias("_r")), "stay")
    marked = folded(docs, "doc_id", "text").withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)))
    marked = marked.withColumn("_row", _row_hash())
    kept = marked.join(stay, (F.col("_id") == F.col("_d")) & (F.col("_row") == F.col("_r")))
    kept = kept.dropDuplicates(["_id", "_row"])
    return kept.select(*unfolded(kept, docs.columns, ("doc_id", "text")))
