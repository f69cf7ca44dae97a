"""Best-two-fit packing of tokenized documents into sequences of at most ``LENGTH`` tokens.

A document is its token ids and a closing ``END``. Longer ones are cut into full pieces; the remainder is the first piece.
Pieces are dealt by a hash of their number into shards of about ``SHARD`` pieces, equal ones too, which are packed apart from each other; a shard loses less than
one sequence or so against packing all at once. Within a shard a bin is filled greedily with the longest piece that still fits.
If a gap stays, the bin's shortest piece is put back and two unpacked pieces take its place that together fill more of the gap
it leaves.

Null and empty texts are the closing id alone. Rows with the same doc_id are packed as documents of their own; rows that agree in
doc_id and ids are interchangeable. A null doc_id stays null.

The ids are those of the `tokenizers` library. Texts of Latin letters are encoded by the same vocabulary's merge ranks in
`tiktoken`, which gives the same ids in less than a third of the time; texts with other letters, where the two might know different
versions of Unicode, and texts with very long runs of white space go through `tokenizers` itself.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, functions as F

from tidegate.session import written

LENGTH = 2048
END = 0
VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
SHARD = 20_000
SLOW = re.compile(r"[^\x00-\u024f]|\s{256}")


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit numbers."""

    def __init__(self, vocabulary: str, ranks: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
        with open(ranks, "rb") as lines:
            known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.quick = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})

    def encode(self, text: str) -> bytes:
        if SLOW.search(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.quick.encode_ordinary(text)
        return np.array(ids, dtype="<u4").tobytes()


def pieces(docs: DataFrame, length: int = LENGTH, vocabulary: str | None = None, ranks: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the pieces of every document."""
    files = vocabulary or public_tokenizers.path(VOCABULARY), ranks or public_tokenizers.path(RANKS)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(*files)
        closing = np.array([END], dtype="<u4").tobytes()
        for frame in frames:
            rows = []
            for doc, text in zip(frame["doc_id"], frame["text"]):
                ids = encoder.encode(text) + closing
                n = len(ids) // 4
                start = 0
                for k, stop in enumerate(range(n % length or length, n + 1, length)):
                    rows.append((doc, k, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])))
                    start = stop
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64", "piece": "int32"})

    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInPandas(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def bins(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Positions of ``lengths`` by bin, each within ``capacity``: greedy filling, then two for one where that is tighter."""
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    for at in range(len(lengths) - 1, -1, -1):
        waiting[lengths[at]].append(at)
    there = 0  # bit n: a piece of length n waits
    for n, items in enumerate(waiting):
        there |= bool(items) << n

    def longest(most: int) -> int:
        return (there & ((1 << (most + 1)) - 1)).bit_length() - 1

    def take(n: int) -> int:
        nonlocal there
        at = waiting[n].pop()
        if not waiting[n]:
            there &= ~(1 << n)
        return at

    out = []
    while there:
        gap, content = capacity, []
        while gap and (n := longest(gap)) > 0:
            content.append((n, take(n)))
            gap -= n
        if gap and len(content) > 1 and there:
            short, at = content[-1]
            room, best, pair = gap + short, short, None
            a = longest(room - 1)
            while a > 0 and 2 * a > best:
                b = longest(min(a, room - a))
                if b == a and len(waiting[a]) < 2:
                    b = longest(a - 1)
                if b > 0 and a + b > best:
                    best, pair = a + b, (a, b)
                    if best == room:
                        break
                a = longest(a - 1)
            if pair:
                content.pop()
                waiting[short].append(at)
                there |= 1 << short
                content += [(n, take(n)) for n in pair]
        out.append([at for _, at in content])
    return out


def packed(docs: DataFrame, length: int = LENGTH, vocabulary: str | None = None, shard: int = SHARD) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset within the sequence."""
    # Pieces are numbered and then written, so that equal ones are dealt out like all others, and alike whenever they are read.
    cut = written(pieces(docs, length, vocabulary).withColumn("number", F.monotonically_increasing_id()), "pieces")
    shards = -(-cut.count() // shard) or 1
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("number"), F.lit(shards))).drop("number")

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece", "ids_crc32"], kind="stable").reset_index(drop=True)
        lengths = frame["length"].to_numpy()
        contents = bins(lengths, length)
        order = np.array([at for content in contents for at in content], dtype=np.int64)
        sequence = np.repeat(np.arange(len(contents)), [len(c) for c in contents])
        ends = np.cumsum(lengths[order])
        before = ends - lengths[order]
        first = np.searchsorted(sequence, sequence)
        out = frame.iloc[order].assign(sequence_id=(frame["shard"].iloc[0] << 32) + sequence, offset=before - before[first])
        return out.drop(columns="shard").astype({"doc_id": "Int64"})

    return dealt.groupBy("shard").applyInPandas(
        pack, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
