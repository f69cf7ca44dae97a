"""Alignment against plain loops over both tokenizations."""

import collections
import hashlib
import random

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tidegate.llm import token_alignment as ta

SCHEMA = "doc_id long, text string, n_a string, pairs long, link string, row string"


def texts():
    rnd = random.Random(5)
    words = ["the", "thanedble", "naïve", "日本語", "😀", "Привет", "foo_bar", "1234567", "'s", "\t", "\x00", "ﬁ", "▁", "　", "<s>", "<0x41>", "<|endoftext|>", "é", "  ", "\n\n"]
    out = [None, "", " ", "a", " a", "a ", "a\n b", "<|endoftext|>", "</s>", "▁x", "x" * 5000, "word " * 3000 + "end", "é" * 300]
    for _ in range(150):
        out.append(" ".join(rnd.choice(words[: 10 if rnd.random() < 0.7 else 20]) for _ in range(rnd.randint(1, 60))))
    return out + [out[20]] * 5


def plain(rows):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = ta.byte_letters()
    found, counts = [], collections.Counter()
    for doc, text, *_ in rows:
        whole = (" " + (text or "")).encode()
        a = [(i, bytes(letters[c] for c in tok.id_to_token(i))) for i in tok.encode(whole.decode(), add_special_tokens=False).ids] if text else []
        b = []
        for i in sp.encode(text) if text else []:
            p = sp.id_to_piece(i)
            b.append((i, bytes.fromhex(p[3:5]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()))
        if not text or any(b"".join(t for _, t in x) != whole for x in (a, b)):
            a = b = []
        groups, links, left, right = [], [], list(a), list(b)
        while left:
            ga, gb, na, nb = [], [], 0, 0
            while not ga or na != nb:
                if na <= nb:
                    ga.append(left[0][0])
                    na += len(left.pop(0)[1])
                else:
                    gb.append(right[0][0])
                    nb += len(right.pop(0)[1])
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            links.append((ga[-1], gb[-1]))
        counts.update(links)
        found.append((doc, len(a), len(b), groups, links))
    most = collections.Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for doc, n, m, groups, links in found:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((doc, n, m, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), digest))
    return out


def test_alignment(spark):
    rows = [(k if k != 14 else None, t, "a", 1, "l", "r") for k, t in enumerate(texts())]
    rows += [rows[20], rows[20]]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    expected = plain(rows)
    assert sorted(map(tuple, ta.alignment(docs).collect()), key=repr) == sorted(expected, key=repr)
    assert 5 < sum(r[1] == 0 for r in expected) < len(rows) / 2
    assert ta.alignment(spark.createDataFrame([], SCHEMA)).count() == 0
    kept = ta.aligned(docs.where("doc_id = 3"), ta.files()).first()
    assert kept["groups"] and hashlib.sha256(kept["groups"].encode()).hexdigest() == kept["groups_sha256"]


def test_the_table_of_pairs_is_bounded():
    assert ta.most_pairs(*ta.files()) < 2_000_000
