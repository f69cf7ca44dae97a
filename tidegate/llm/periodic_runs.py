"""Periodic runs of words: maximal stretches that repeat with a period, found by internal pattern matching.

A run is a stretch of consecutive words whose smallest period is q, with at least ``max(LEAST, POWER * q)`` words, which no neighbouring
word extends. Periods from B/2 up to B - 1 are found with the blocks of B words that start at multiples of B, for every power of
two B: a run of four periods is as long as two such blocks, so it contains a whole one, and on one side of that at least one
more period. So the block occurs again q words further, inside the run; were there an occurrence nearer by, the block and
the way to it would lie in the run with two periods and be as long as both together, and the run would have a smaller one. Occurrences
of a block in a window no longer than itself are an arithmetic progression through the block, so the nearest one gives the difference,
a candidate period. The stretch is then extended both ways as far as the words agree at that distance.

Occurrences are found in a suffix array: those of a block are neighbours in it, and the nearest in the text to either side is the
successor or predecessor of the block's position among the values of that range, which a wavelet tree answers. The array comes from
prefix doubling, whose ranks after k rounds name all blocks of 2**k words; the extension goes through the same names from
long to short. Suffixes whose first two words do not recur are in no query's range and left out of the tree.

Documents are worked on in chunks of about ``CHUNK`` words, a longer one in a chunk of its own (about ``8 * n * log2(n)`` bytes for n
words that are periodic throughout, far less for others). Words are numbered per document, so no block is equal to one of another document. Null, empty
and blank texts have no words. Nothing is shuffled: rows with the same doc_id, or without one, are documents of their own; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

LEAST = 6
POWER = 4
CHUNK = 1 << 18
ROWS = 512  # documents that are passed on together


class WaveletTree:
    """Order statistics of ranges of a sequence of numbers below ``2**bits``; all queries are arrays."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            zeros = np.zeros(len(values) + 1, dtype=np.int32)
            np.cumsum(~one, out=zeros[1:])
            self.levels.append((bit, zeros))
            values = np.concatenate((values[~one], values[one]))

    def smaller(self, lo: np.ndarray, hi: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many numbers of ``[lo, hi)`` are below the limit, which must be below ``2**bits``."""
        count = np.zeros(len(lo), dtype=np.int64)
        for bit, zeros in self.levels:
            a, b = zeros[lo], zeros[hi]
            one = (limit >> bit & 1).astype(bool)
            count += np.where(one, b - a, 0)
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - b, b)
        return count

    def ranked(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest number of ``[lo, hi)``, from 0; it must be there."""
        out = np.zeros(len(lo), dtype=np.int64)
        for bit, zeros in self.levels:
            a, b = zeros[lo], zeros[hi]
            one = k >= b - a
            k = np.where(one, k - (b - a), k)
            out |= one.astype(np.int64) << bit
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - b, b)
        return out


def suffix_order(words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and for each k the name of every block of ``2**k`` words: the first place of its suffixes in the array.

    Rounds go on until all blocks differ; in each one only suffixes that share their block are sorted anew.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    sorted_words = words[order]
    starts = np.flatnonzero(np.concatenate(([True], sorted_words[1:] != sorted_words[:-1])))
    sizes = np.diff(np.append(starts, n))
    rank = np.empty(n, dtype=np.int32)
    rank[order] = np.repeat(starts, sizes)
    names = [rank]
    places = np.flatnonzero(np.repeat(sizes, sizes) > 1)  # of the array, whose suffixes share their block
    width = 1
    while len(places):
        at = order[places]
        own = rank[at].astype(np.int64)
        after = at + width
        key = own * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)], -1) + 1
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[places] = at
        first = np.concatenate(([True], key[1:] != key[:-1]))
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(key)))
        rank = rank.copy()
        rank[at] = np.repeat(places[starts], sizes)
        names.append(rank)
        places = places[np.repeat(sizes, sizes) > 1]
        width *= 2
    return order, names


def _group_ends(order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each place of the suffix array that starts a group of equal blocks, where the group ends."""
    n = len(order)
    starts = np.flatnonzero(rank[order] == np.arange(n))
    ends = np.zeros(n, dtype=np.int64)
    ends[starts] = np.append(starts[1:], n)
    return ends


def _extended(left: np.ndarray, right: np.ndarray, names: list[np.ndarray], back: bool) -> np.ndarray:
    """How many words from ``left`` and ``right`` on (or before them) agree. The longest blocks all differ, so each width is used once."""
    n, got = len(names[0]), np.zeros(len(left), dtype=np.int64)
    for k in range(len(names) - 1, -1, -1):
        width, name = 1 << k, names[k]
        shift = -got - width if back else got
        i, j = left + shift, right + shift
        fits = (np.minimum(i, j) >= 0) & (np.maximum(i, j) + width <= n)
        got += width * (fits & (name[np.clip(i, 0, n - 1)] == name[np.clip(j, 0, n - 1)]))
    return got


def runs(words: np.ndarray, least: int = LEAST, power: int = POWER) -> np.ndarray:
    """``start, length, period`` of all runs of a sequence of numbers, by start and then period."""
    none = np.zeros((0, 3), dtype=np.int64)
    n = len(words)
    if n < least:
        return none
    order, names = suffix_order(words)
    if len(names) < 2:
        return none
    # The tree holds the suffixes whose first two words recur, by their place in the text.
    ends = _group_ends(order, names[1])
    sizes = ends[names[1][order]] - names[1][order]
    held = sizes > 1
    before = np.concatenate(([0], np.cumsum(held)))
    if not before[-1]:
        return none
    positions = np.sort(order[held])  # text positions by their number in the tree
    number = np.full(n, -1, dtype=np.int64)
    number[positions] = np.arange(len(positions))
    tree = WaveletTree(number[order[held]], int(len(positions)).bit_length())
    found = []
    for k in range(1, len(names)):
        block, name = 1 << k, names[k]
        at = np.arange(0, n - block + 1, block)
        ends = _group_ends(order, name)
        lo = name[at].astype(np.int64)
        hi = ends[lo]
        many = hi - lo > 1
        at, lo, hi = at[many], before[lo[many]], before[hi[many]]
        if not len(at):
            continue
        own = tree.smaller(lo, hi, number[at])
        for step in (1, -1):
            there = own + step
            exists = (there >= 0) & (there < hi - lo)
            near = positions[tree.ranked(lo[exists], hi[exists], there[exists])]
            start = at[exists]
            period = np.abs(near - start)
            fits = (period >= block >> 1) & (period < block)
            found.append(np.column_stack((start, period))[fits])
    start, period = np.concatenate(found).T if found else none.T[:2]
    if not len(start):
        return none
    first = start - _extended(start, start + period, names, True)
    length = start + period + _extended(start, start + period, names, False) - first
    out = np.column_stack((first, length, period))[length >= np.maximum(least, power * period)]
    return np.unique(out, axis=0)


def planted(words: list[bytes], doc_id: str | None) -> list[bytes]:
    """Every tenth document by the checksum of its id repeats some of its words to the end; without an id none does."""
    n = len(words)
    if doc_id is None or not n:
        return words
    g, rest = divmod(zlib.crc32(doc_id.encode()), 10)
    if rest:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    piece = words[a : a + p]
    return words[:a] + (piece * ((n - a) // p + 1))[: n - a]


def _described(doc: str | None, words: list[bytes], found: np.ndarray) -> tuple:
    """The report of a document from its runs."""
    if not len(found):
        return doc, 0, None, None, None, None, hashlib.sha256().hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()
    rows = sorted(map(tuple, found.tolist()), key=lambda r: (r[0], r[2]))
    best = rows[0]
    for r in rows[1:]:
        if r[1] * best[2] > best[1] * r[2]:
            best = r
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    kept = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in rows)
    digest = hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()
    return doc, len(rows), *best, 1000 * best[1] // best[2], *digest


def periodic_runs(
    docs: DataFrame,
    least: int = LEAST,
    power: int = POWER,
    changed: Callable[[list[bytes], str | None], list[bytes]] | None = None,
    chunk: int = CHUNK,
) -> DataFrame:
    """Per document: doc_id, n_runs, the run with the greatest exponent (start, length, period, exponent_milli), and checksums.

    ``changed`` may replace the words of a document before. ``runs_sha256`` is over the list of runs, ``collapsed_sha256`` over the words
    that stay if every run keeps its first period only. ``power`` must be 4 at least, as the search relies on that.
    """
    if power < 4:
        raise ValueError("runs of less than four periods are not all found")

    def described(batch: list[tuple[str | None, list[bytes]]]) -> Iterator[tuple]:
        sizes = [len(w) for _, w in batch]
        ids = np.empty(sum(sizes), dtype=np.int64)
        at = base = 0
        for (_, words), n in zip(batch, sizes):
            known: dict[bytes, int] = {}
            ids[at : at + n] = [known.setdefault(w, base + len(known)) for w in words]
            at, base = at + n, base + len(known)
        found = runs(ids, least, power)
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        cuts = np.searchsorted(found[:, 0], bounds)
        for k, (doc, words) in enumerate(batch):
            mine = found[cuts[k] : cuts[k + 1]]
            yield _described(doc, words, mine - np.array([bounds[k], 0, 0]))

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        batch, size = [], 0
        for frame in frames:
            for doc, text in zip(frame["doc_id"], frame["text"]):
                words = (text or "").encode().split()  # at the same six characters of white space
                words = changed(words, doc) if changed else words
                if batch and size + len(words) > chunk:
                    yield from described(batch)
                    batch, size = [], 0
                batch.append((doc, words))
                size += len(words)
        if batch:
            yield from described(batch)

    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

    def table(some: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(some, columns=names)
        return out.astype({c: "Int64" for c in names[1:6]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        some = []
        for row in rows(frames):
            some.append(row)
            if len(some) >= ROWS:
                yield table(some)
                some = []
        yield table(some)

    texts = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text")  # pandas has no whole numbers with nulls
    schema = "doc_id string, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return texts.mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast("long"))
