"""The whole pipeline against plain Python: its stages one after the other, each by its docstring, and the rows of ``run`` compared."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from test_documents import SPACE, fingerprint, prose, words
from tidegate.llm import line_chunks, quality_rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row string, size long"
LAST = 1 << 62
SIGNED = lambda h: h - (1 << 64) if h >> 63 else h


def corpus():
    rnd = random.Random(31)
    line = lambda n: prose(n, rnd).replace("\n", " ")
    license_line, passages, copied = "All rights reserved by the Owner", [[line(9) for _ in range(4)] for _ in range(3)], [line(14) for _ in range(9)]
    texts = []
    for k in range(150):
        parts = [line(rnd.randint(20, 40)) for _ in range(rnd.randint(2, 6))]
        if k % 4 == 0:
            parts[1:1] = passages[k % 3]
        if k % 2:
            parts.append(license_line if k % 3 else license_line.upper() + "  ")
        texts.append("\n".join(parts))
    texts += ["\n".join([*copied, f"edited {j}", license_line]) for j in range(25)]  # near copies whose lines are common
    texts += [texts[10], texts[10].replace(" ", "  ", 2), texts[11] + " end", None, "", " \n ", "short text", "again " * 400, license_line]
    rows = [(k if k != 120 else None, t, "en", ("a", "b", None)[k % 3] if k < 150 or k >= 175 else "a", 0, "r", 1) for k, t in enumerate(texts)]
    return rows + [rows[20], rows[20]]


def quality(rows):
    hosts, seen = collections.defaultdict(set), collections.defaultdict(set)
    normal = lambda x: " ".join(words(x)).lower()
    lines = [(r[1] or "").split("\n") for r in rows]
    for r, own in zip(rows, lines):
        hosts[r[3]].add(r[1])
        for x in own:
            if words(x):
                seen[r[3], normal(x)].add(r[1])
    judged, firsts = [], {}
    for r, own in zip(rows, lines):
        w = words(r[1])
        n = len(w)
        windows = collections.Counter(zip(w, w[1:], w[2:]))
        covered = {j for i in range(n - 2) if windows[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        failed = n < 50 or 100 * len(covered) > 50 * n
        common = [x for x in own if words(x) and len(seen[r[3], normal(x)]) > max(quality_rules.LIMIT_TEXTS, quality_rules.LIMIT_SHARE * len(hosts[r[3]]))]
        lost = sum(len(words(x)) for x in common)
        mostly = lost > 0 and 100 * (n - lost) < quality_rules.MIN_LEFT_PERCENT * n
        group = (r[3], frozenset(map(normal, common)))
        doc = r[0] if r[0] is not None else LAST
        if mostly and not failed:
            firsts[group] = min(doc, firsts.get(group, doc))
        judged.append((r, own, set(common), failed, lost, mostly, mostly or 0 < lost and n - lost < 50, group, doc))
    out = []
    for r, own, common, failed, lost, mostly, depleted, group, doc in judged:
        whole = mostly and firsts.get(group) == doc
        if not failed and (not depleted or whole):
            text = r[1] if whole or not lost else "\n".join(x for x in own if x not in common)
            out.append((r[0], text, *r[2:]))
    return out


def without_repeated_chunks(rows):
    def chunks(text):
        out, at, own = [], [], (text or "").split("\n")
        h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in own]
        for i, x in enumerate(own):
            at.append(x)
            rolled = sum(h[i - k] * (pow(line_chunks.FACTOR, k, line_chunks.MODULUS) % 65_521) for k in range(line_chunks.WINDOW) if i >= k)
            if i == len(own) - 1 or rolled % line_chunks.MODULUS % line_chunks.DIVISOR == 0:
                out.append(at)
                at = []
        return out

    owner = {}
    for doc, text in sorted({(r[0] if r[0] is not None else LAST, r[1]) for r in rows}):
        for k, c in enumerate(chunks(text)):
            if len(c) >= line_chunks.MIN_LINES and words("\n".join(c)):
                owner.setdefault("\n".join(c), (doc, k))
    out = []
    for r in rows:
        doc, parts = r[0] if r[0] is not None else LAST, chunks(r[1])
        stay = [c for k, c in enumerate(parts) if owner.get("\n".join(c), (doc, k)) == (doc, k)]
        out.append((r[0], r[1] if len(stay) == len(parts) else "\n".join("\n".join(c) for c in stay), *r[2:]))
    return out


def one_of_each(rows):
    prints, groups = [fingerprint(r[1]) for r in rows], []
    for r, p in zip(rows, prints):
        near = [g for g in groups if any((p ^ q).bit_count() <= 3 for _, q in g)]
        groups = [g for g in groups if g not in near] + [sum(near, []) + [(r, p)]]
    return [min((r for r, _ in g), key=lambda r: (r[0] is None, r[0])) for g in groups]


def mix(rows):
    sizes = collections.defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, left, open_ = {}, 1.5 * sum(sizes.values()), set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        for s in full or open_:
            target[s] = 2.0 * sizes[s] if full else level * weight[s]
        left -= sum(target[s] for s in full)
        open_ -= full or set(open_)
    out = []
    for s in order:
        mine = [r for r in rows if r[3] == s]
        key = lambda r: (hashlib.md5(("-" if r[0] is None else str(r[0])).encode()).hexdigest(), SIGNED(xxhash.xxh64((r[1] or "").encode(), seed=42).intdigest()))
        epochs = math.floor(target[s] / sizes[s])
        rest = math.floor(target[s]) - epochs * sizes[s]
        for r in sorted(mine, key=key):
            out += [r] * epochs
            part = min(len(words(r[1])), rest)
            rest -= part
            if part == len(words(r[1])):
                out += [r] * (part > 0)
            elif part:
                text = re.match(rf"(?:[^\x20\x09-\x0D]+{SPACE.pattern}){{{part - 1}}}[^\x20\x09-\x0D]+", r[1].lstrip(" \t\n\x0b\f\r"))[0]
                out.append((r[0], text, *r[2:]))
    return [r for r in out if words(r[1])]


def pieces(rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for r in rows:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        out += [(r[0], k, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    return out


def test_stages_and_run(spark, tmp_path):
    now, plain = corpus(), (quality, without_repeated_chunks, one_of_each, mix)
    spark.createDataFrame(now, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs, changed = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for (name, stage), mine in zip(corpus_pipeline.STAGES, plain):
        after = mine(now)
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(after, key=repr), name
        changed.append((len(now) - len(after), sum(a[1] != b[1] for a, b in zip(sorted(now, key=repr), sorted(after, key=repr)))))
        now, docs = after, spark.createDataFrame(after, SCHEMA)
    assert all(any(c) for c in changed)
    run = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((tuple(r)[:5] for r in run), key=repr) == sorted(pieces(now), key=repr)
    filled = collections.defaultdict(list)
    for r in run:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for content in filled.values():
        content.sort()
        assert [o for o, _ in content] == [sum(n for _, n in content[:k]) for k in range(len(content))] and sum(n for _, n in content) <= 2048
    assert len(filled) <= -(-sum(r["length"] for r in run) // 2048) + 1


def test_the_sql_of_the_quality_rules_states_the_first_of_near_copies(spark, tmp_path):
    import duckdb

    from tidegate.llm.oracles import OP6

    rows = corpus()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    mine = quality_rules.judged(docs)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = con.execute(OP6)
    names = [c[0] for c in found.description]
    assert sorted(map(tuple, mine.select(*names).collect()), key=repr) == sorted(found.fetchall(), key=repr)
    copies = {r["doc_id"]: r["kept"] for r in mine.collect() if r["doc_id"] is not None and 150 <= r["doc_id"] < 175}
    assert sum(copies.values()) == 1 and copies[150]
