"""Periodic runs against a search over all periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tidegate.llm import periodic_runs as pr

SCHEMA = "doc_id long, text string, n_runs string, start string, row long"


def all_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                piece = words[i : i + length]
                if not any(piece[p:] == piece[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(12))
def test_runs_of_random_words(seed):
    rnd = random.Random(seed)
    for _ in range(60):
        words = []
        while len(words) < rnd.randint(0, 400):
            if rnd.random() < 0.4:
                piece = [rnd.randrange(rnd.choice((2, 3, 50))) for _ in range(rnd.choice((1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 33)))]
                words += (piece * 6)[: rnd.randint(1, 6 * len(piece))]
            else:
                words += [rnd.randrange(rnd.choice((1, 2, 3, 200))) for _ in range(rnd.randint(1, 12))]
        found = sorted(map(tuple, pr.runs(np.array(words, dtype=np.int64)).tolist()), key=lambda r: (r[0], r[2]))
        assert found == all_runs(words), words


def test_range_successor():
    rnd = np.random.default_rng(1)
    values = rnd.permutation(300)
    tree = pr.WaveletTree(values, 9)
    for _ in range(200):
        lo, hi = sorted(rnd.integers(0, 301, 2))
        limit = int(rnd.integers(0, 300))
        part = np.sort(values[lo:hi])
        assert tree.smaller(np.array([lo]), np.array([hi]), np.array([limit]))[0] == (part < limit).sum()
        for k in range(min(len(part), 5)):
            assert tree.ranked(np.array([lo]), np.array([hi]), np.array([k]))[0] == part[k]


def corpus():
    rnd = random.Random(2)
    texts = [None, "", " \n\t ", "x", "a " * 5, "a " * 6, "a b " * 9, "word " * 9000, "la di da " * 700 + "end"]
    for _ in range(250):
        parts = [" ".join(rnd.choice(("the", "an", "é", "of", "to")) if rnd.random() < 0.5 else str(rnd.random()) for _ in range(rnd.randint(1, 60))) for _ in range(3)]
        if rnd.random() < 0.3:
            parts.insert(1, " ".join([" ".join(f"w{k}" for k in range(rnd.randint(1, 9)))] * rnd.randint(3, 9)))
        texts.append(rnd.choice("\n \t").join(parts))
    rows = [(k * 7 - 30 if k != 20 else None, t, "n", "s", k) for k, t in enumerate(texts)]
    return rows + [rows[12], rows[12], (rows[12][0], rows[13][1], "n", "s", 1)]


def expected(rows):
    out = []
    for doc, text, *_ in rows:
        words = [w.encode() for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
        n = len(words)
        h = zlib.crc32(str(doc).encode()) if doc is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        found = [(0, n, 1)] if n > 1000 and len(set(words)) == 1 else all_runs(words)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else None
        gone = {i for s, length, q in found for i in range(s + q, s + length)}
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        out.append((doc, len(found), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_periodic_runs(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = expected(rows)
    for chunk in (pr.CHUNK, 500):
        assert sorted(map(tuple, pr.periodic_runs(docs, changed=pr.planted, chunk=chunk).collect()), key=repr) == want
    assert sum(r[1] > 0 for r in want) > 30 and any(r[1] > 1 for r in want)
    assert pr.periodic_runs(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        pr.periodic_runs(docs, power=3)
