"""Alignment of two tokenizations of the same text: ``A`` byte-level pairs, ``B`` sentence pieces.

A gets a space and the text, B the text, before which it puts the space itself. A token's bytes are what it stands for: for A its
characters decoded by the byte-level table, for B its piece in UTF-8 with the mark U+2581 as a space and ``<0xHH>`` as a byte. Each
side's cumulative ends go into a dictionary from end to token; the intersection of the two key sets, sorted, holds the places where
both end a token. They cut both id lists into groups, and each group is a slice of either list.

A link joins two token occurrences that end at the same byte: the last ones of each group, so there is one for each group. Links
are counted by id pair over all texts; a link is best if no pair with the same B id is counted more often.

Texts that are null or empty, or whose joined tokens of A or B are not a space and the text (B folds white space and some
characters), have no tokens: counts are zero, the groups are the empty text. Special tokens are not added, and their names in a
text are ordinary text. A text is encoded whole. Rows with the same doc_id, or without one, are texts of their own. Other
columns are not read.

Counts of pairs are added up before the shuffle. Two tokens that end together cover the same bytes where both reach, so one is an ending of the
other, and there are no more pairs than the tokens of both vocabularies have endings (twice that, as a byte has two spellings in B):
a table with a proven bound (``most_pairs``, below a million for these vocabularies), however much text there is. It is broadcast.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, functions as F

from tidegate.llm.packing import Encoder
from tidegate.session import written

VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
SPACE_MARK = "▁"
ROWS = 512  # documents that are passed on together
BYTES = 1 << 20  # about the text that is encoded together
LATIN = 0x24F  # up to here both encoders of A know the same letters


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes are themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Side:
    """One vocabulary: the bytes of each id."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.lengths = [len(t) for t in tokens]

    def spell(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def ends(self, ids: list[int]) -> list[int]:
        """Byte offsets at which the tokens end."""
        return list(accumulate(map(self.lengths.__getitem__, ids)))


def level_tokens(vocabulary: str) -> list[bytes]:
    """Bytes of the ids of a byte-level vocabulary; added tokens are their text."""
    with open(vocabulary, encoding="utf-8") as text:
        known = json.load(text)
    letters = byte_letters()
    named = {i: bytes(letters[c] for c in token) for token, i in known["model"]["vocab"].items() if all(c in letters for c in token)}
    named |= {t["id"]: t["content"].encode() for t in known.get("added_tokens", [])}
    return [named.get(i, b"") for i in range(max(named) + 1)]


def piece_tokens(pieces) -> list[bytes]:
    def spelled(i: int) -> bytes:
        piece = pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace(SPACE_MARK, " ").encode()

    return [spelled(i) for i in range(pieces.get_piece_size())]


def _latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return bool(np.frombuffer(text.encode("utf-32-le"), dtype="<u4").max() <= LATIN)
    return True


class Aligner:
    def __init__(self, vocabulary: str, ranks: str, pieces: str):
        os.environ.setdefault("OMP_NUM_THREADS", "1")
        import sentencepiece

        self.encoder = Encoder(vocabulary, ranks)
        self.spaces = re.compile(r"\s{256}")
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.a, self.b = Side(level_tokens(vocabulary)), Side(piece_tokens(self.pieces))
        self.most = max(len(self.a.tokens), len(self.b.tokens))
        # How an id is spelled before another id of its list, at the end of A's part, and at the end of a group.
        self.spelled = np.array([f"{i}{mark}" for mark in ",|;" for i in range(self.most)], dtype="S")

    def ids_a(self, text: str) -> list[int]:
        """By the quick encoder where it gives the same ids: see ``packing``."""
        if _latin(text) and not self.spaces.search(text):
            return self.encoder.quick.encode_ordinary(text)
        return self.encoder.tokenizer.encode(text, add_special_tokens=False).ids

    def align(self, text: str | None, ids_b: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of A and of B, and for each group the number of the token that closes it, in A and in B."""
        if not text:
            return None
        whole = (" " + text).encode()
        ids_a = self.ids_a(" " + text)
        if self.b.spell(ids_b) != whole or self.encoder.quick.decode_bytes(ids_a) != whole:
            return None
        ends_a, ends_b = self.a.ends(ids_a), self.b.ends(ids_b)
        at_a, at_b = dict(zip(ends_a, range(len(ids_a)))), dict(zip(ends_b, range(len(ids_b))))
        common = sorted(at_a.keys() & at_b.keys())
        last_a, last_b = (np.fromiter(map(at.__getitem__, common), dtype=np.int64, count=len(common)) for at in (at_a, at_b))
        return np.array(ids_a), np.array(ids_b), last_a, last_b

    def groups(self, ids_a: np.ndarray, ids_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3`` in ASCII: the slices of both lists, in order."""
        n, m = len(ids_a), len(ids_b)
        signs = np.empty(n + m, dtype=np.int64)
        # A token stands behind all tokens of its list, and behind the other list's tokens of earlier groups, or of its own too.
        place_a = np.arange(n) + np.repeat(np.concatenate(([0], last_b[:-1] + 1)), np.diff(last_a, prepend=-1))
        place_b = np.arange(m) + np.repeat(last_a + 1, np.diff(last_b, prepend=-1))
        signs[place_a], signs[place_b] = ids_a, ids_b
        signs[place_a[last_a]] += self.most
        signs[place_b[last_b]] += 2 * self.most
        return self.spelled[signs].tobytes().translate(None, b"\0")[:-1]  # texts of one width, without their padding

    def alignments(self, texts: list[str | None]) -> Iterator[tuple | None]:
        """``align`` for texts, some of which are encoded together."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and size < BYTES:
                size += len(texts[end] or "")
                end += 1
            some = texts[at:end]
            for text, ids_b in zip(some, self.pieces.encode([t or "" for t in some], num_threads=1)):
                yield self.align(text, ids_b)
            at = end


def files(vocabulary: str | None = None, ranks: str | None = None, pieces: str | None = None) -> tuple[str, str, str]:
    path = public_tokenizers.path
    return vocabulary or path(VOCABULARY), ranks or path(RANKS), pieces or path(PIECES)


def most_pairs(vocabulary: str, ranks: str, pieces: str) -> int:
    """An upper bound for the number of different id pairs that can end together."""
    aligner = Aligner(vocabulary, ranks, pieces)
    return 2 * (sum(aligner.a.lengths) + sum(aligner.b.lengths))


def aligned(docs: DataFrame, named: tuple[str, str, str], keep_groups: bool = True) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, groups (the text form, if kept), groups_sha256, and its links by id pair.

    ``pairs`` holds the pairs as ``a << 32 | b``, each once, ``times`` how often the document has them.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = Aligner(*named)
        names = ["doc_id", "n_a", "n_b", "n_groups", "groups", "groups_sha256", "pairs", "times"]
        none = (0, 0, 0, "", "", np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))

        def row(found: tuple | None) -> tuple:
            if found is None:
                return none
            ids_a, ids_b, last_a, last_b = found
            spelled = aligner.groups(*found)
            pairs, times = np.unique(ids_a[last_a] << 32 | ids_b[last_b], return_counts=True)
            digest = hashlib.sha256(spelled).hexdigest()
            return len(ids_a), len(ids_b), len(last_a), spelled.decode() if keep_groups else None, digest, pairs, times

        for frame in frames:
            for at in range(0, len(frame), ROWS):
                some = frame.iloc[at : at + ROWS]
                found = aligner.alignments(some["text"].tolist())
                yield pd.DataFrame([(doc, *row(each)) for doc, each in zip(some["doc_id"], found)], columns=names)

    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")  # pandas has no whole numbers with nulls
    schema = "doc_id string, n_a long, n_b long, n_groups long, groups string, groups_sha256 string, pairs array<long>, times array<long>"
    return texts.mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, count, best``: links of each id pair over all rows of ``aligned``, and whether none of its B id has more."""
    links = rows.select(F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    counts = written(links.groupBy(F.col("link.pairs").alias("pair")).agg(F.sum("link.times").alias("count")), "pairs")
    of_b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = counts.groupBy(of_b.alias("_b")).agg(F.max("count").alias("_most"))
    return counts.join(most, of_b == F.col("_b")).select("pair", "count", (F.col("count") == F.col("_most")).alias("best"))


def alignment(docs: DataFrame, vocabulary: str | None = None, ranks: str | None = None, pieces: str | None = None) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    rows = aligned(docs, files(vocabulary, ranks, pieces), keep_groups=False).withColumn("row", F.monotonically_increasing_id())
    rows = written(rows.drop("groups"), "aligned")
    counts = written(pair_counts(rows), "counts")
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    links = links.join(F.broadcast(counts), F.col("link.pairs") == F.col("pair"))
    times = F.col("link.times")
    sums = links.groupBy(F.col("row").alias("_row")).agg(F.sum(F.when(F.col("best"), times)).alias("best"), F.sum(times * F.col("count")).alias("total"))
    joined = rows.drop("pairs", "times").join(sums, F.col("row") == F.col("_row"), "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), F.coalesce("best", zero).alias("n_best"),
        F.coalesce("total", zero).alias("count_sum"), "groups_sha256",
    )
