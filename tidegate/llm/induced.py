"""Suffixes of many short texts in order, with the common prefixes of neighbours, by induced sorting.

Each text ends in a separator that is smaller than any byte; equal suffixes of different texts are in the order of the texts. A
suffix is of type S if it is smaller than the one that starts a byte later, else of type L; an S after an L is a "left-most S".
Once those are in order, all L are induced from smaller to larger first bytes and all S from larger to smaller ones: a suffix that
leaves the priority queue puts the suffix before it in. Keys enter in the order in which they leave, so the queue is a list per
first byte, which goes to disk when it is large. What is taken out at once is handled as an array. Every entry carries the length
of the prefix it shares with the entry before it, which a smallest value over the entries in between and one more gives.

The left-most S are ordered by inducing once from their first bytes alone, naming the pieces from one to the next by what they
share, and sorting the sequences of names by doubling.
"""

from __future__ import annotations

import tempfile

import numpy as np

CAP = 250  # common prefixes are counted up to here
IN_MEMORY = 64 << 20


class Lists:
    """Entries by first byte: positions and common prefixes, kept on disk beyond ``IN_MEMORY`` bytes."""

    def __init__(self, symbols: int):
        self.parts: list[list] = [[] for _ in range(symbols)]
        self.held = 0
        self.file = None

    def put(self, symbol: int, at: np.ndarray, shared: np.ndarray) -> None:
        self.held += at.nbytes + shared.nbytes
        self.parts[symbol].append((at, shared))
        if self.held > IN_MEMORY:
            self._to_disk()

    def _to_disk(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for part in self.parts:
            for k, entry in enumerate(part):
                if isinstance(entry[0], np.ndarray):
                    part[k] = (self.file.tell(), len(entry[0]))
                    self.file.write(entry[0].tobytes())
                    self.file.write(entry[1].tobytes())
        self.held = 0

    def read(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for entry in self.parts[symbol]:
            if isinstance(entry[0], np.ndarray):
                found.append(entry)
            else:
                self.file.seek(entry[0])
                found.append((np.frombuffer(self.file.read(4 * entry[1]), dtype=np.int32), np.frombuffer(self.file.read(entry[1]), dtype=np.uint8)))
        if not found:
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.uint8)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def take(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        found = self.read(symbol)
        self.held -= sum(a.nbytes + b.nbytes for a, b in self.parts[symbol] if isinstance(a, np.ndarray))
        self.parts[symbol] = []
        return found


def _range_min(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The smallest of values[first..last], both included, for many ranges."""
    width = last - first + 1
    out = np.empty(len(first), dtype=values.dtype)
    level, step = values, 1
    while True:
        now = (width >= step) & (width < 2 * step)
        if now.any():
            out[now] = np.minimum(level[first[now]], level[last[now] - step + 1])
        if not (width >= 2 * step).any():
            return out
        level = np.minimum(level[:-step], level[step:])
        step *= 2


class _Induction:
    """One scan: takes entries in order and puts the suffixes before them into the lists of their first bytes."""

    def __init__(self, text: np.ndarray, of_type: np.ndarray, symbols: int):
        self.text, self.of_type = text, of_type
        self.lists = Lists(symbols)
        self.low = np.full(symbols, CAP, dtype=np.uint8)  # smallest common prefix since a list last got an entry
        self.seen = np.zeros(symbols, dtype=bool)

    def scan(self, at: np.ndarray, shared: np.ndarray) -> None:
        if not len(at):
            return
        before = at - 1
        index = np.flatnonzero((before >= 0) & self.of_type[before])
        symbols = self.text[before[index]]
        order = np.argsort(symbols, kind="stable")
        index, symbols = index[order], symbols[order]
        total = shared.min()
        if not len(index):
            self.low = np.minimum(self.low, total)
            return
        starts = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]])
        first = np.r_[0, index[:-1] + 1]
        first[starts] = 0
        least = _range_min(shared, first, index)
        own = symbols[starts]
        least[starts] = np.where(self.seen[own], np.minimum(least[starts], self.low[own]), 255)
        new = np.minimum(least.astype(np.int16) + 1, CAP).astype(np.uint8)
        new[starts[~self.seen[own]]] = 0
        self.low = np.minimum(self.low, total)
        stops = np.r_[starts[1:], len(index)]
        ends = index[stops - 1] + 1
        rest = np.full(len(own), CAP, dtype=np.uint8)
        open_ = ends < len(shared)
        rest[open_] = _range_min(shared, ends[open_], np.full(int(open_.sum()), len(shared) - 1))
        self.low[own] = rest
        self.seen[own] = True
        for symbol, a, b in zip(own.tolist(), starts.tolist(), stops.tolist()):
            self.lists.put(symbol, before[index[a:b]], new[a:b])


def _induce(text: np.ndarray, small: np.ndarray, runs: np.ndarray, symbols: int, lms: np.ndarray, shared: np.ndarray, bounds: np.ndarray):
    """All suffixes in order with common prefixes, by first byte, from the left-most S in order: yields L and S parts."""
    cap = lambda p, q: np.uint8(min(int(runs[p]) - p, int(runs[q]) - q, CAP))  # noqa: E731  an L and an S with the same first byte
    large = _Induction(text, ~small, symbols)
    done = Lists(symbols)
    for c in range(symbols):
        last = -1
        at, common = large.lists.take(c)
        while len(at):
            done.put(c, at, common)
            last = int(at[-1])
            large.scan(at, common)
            at, common = large.lists.take(c)
        at, common = lms[bounds[c] : bounds[c + 1]], shared[bounds[c] : bounds[c + 1]].copy()
        if len(at):
            common[0] = cap(last, int(at[0])) if last >= 0 else 0
            large.scan(at, common)
    tail = _Induction(text, small & (text != 0), symbols)
    result = []
    for c in range(symbols - 1, 0, -1):
        last, parts = -1, []
        at, common = tail.lists.take(c)
        while len(at):
            parts.append((at, common))
            last = int(at[-1])
            tail.scan(at, common)
            at, common = tail.lists.take(c)
        up, up_common = done.take(c)
        if len(up):
            back = np.empty_like(up_common)
            back[1:] = up_common[:0:-1]
            back[0] = cap(int(up[-1]), last) if last >= 0 else 0
            tail.scan(up[::-1], back)
        down = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, dtype=np.int32)
        down_common = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, dtype=np.uint8)
        s_common = np.empty_like(down_common)
        if len(down):
            s_common[1:] = down_common[:0:-1]
            s_common[0] = cap(int(up[-1]), int(down[-1])) if len(up) else 0
        result.append((np.concatenate((up, down[::-1])), np.concatenate((up_common, s_common))))
    result.append((lms[: bounds[1]], np.zeros(bounds[1], dtype=np.uint8)))  # separators, in the order of the texts
    result.reverse()
    return np.concatenate([r[0] for r in result]), np.concatenate([r[1] for r in result])


def _doubled(names: np.ndarray) -> np.ndarray:
    """Positions of a sequence of names in the order of its suffixes."""
    rank, n, step = names.astype(np.int64), len(names), 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        new = np.r_[0, np.cumsum(ranked[1:] != ranked[:-1])]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        if new[-1] == n - 1 or step >= n:
            return order
        step *= 2


def _shared(data: np.ndarray, left: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of the suffixes at p and q, up to ``CAP``; ``left`` bytes are left in a text."""
    most = np.minimum(np.minimum(left[p], left[q]), CAP)
    out = np.zeros(len(p), dtype=np.int64)
    active = np.flatnonzero(most > 0)
    word = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    while len(active):
        differ = word[p[active] + out[active]] ^ word[q[active] + out[active]]
        same = np.where(differ == 0, 8, np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) // 8)
        out[active] += same
        active = active[(same == 8) & (out[active] < most[active])]
    return np.minimum(out, most).astype(np.uint8)


def sorted_suffixes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``at, shared, text_of, start_of``: suffixes in order and what they share with the one before; separators come first.

    Positions count in all texts, each followed by its separator; ``text_of[position]`` and ``start_of[text]`` lead back.
    """
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"\0".join(texts) + b"\0" * (CAP + 16), dtype=np.uint8)
    n = int(lengths.sum()) + len(texts)
    start_of = np.r_[0, np.cumsum(lengths + 1)[:-1]]
    if n >= 1 << 31:
        raise ValueError("positions are 32-bit numbers")
    text_of = np.repeat(np.arange(len(texts), dtype=np.int32), lengths + 1)
    text = data[:n].astype(np.int16) + 1
    ends = start_of + lengths
    text[ends] = 0
    left = (ends[text_of] - np.arange(n)).astype(np.int32)
    # The type follows from the next different symbol; separators differ from each other, a later one being larger.
    change = np.flatnonzero(np.r_[(text[1:] != text[:-1]) | (text[:-1] == 0), True])
    run_end = np.repeat((change + 1).astype(np.int32), np.diff(np.r_[-1, change]))
    following = np.r_[text, [0]][run_end]
    small = following > text
    small[text == 0] = True
    lms = np.flatnonzero(small & np.r_[False, ~small[:-1]] | (text == 0)).astype(np.int32)
    symbols = 257
    by_first = np.argsort(text[lms], kind="stable")
    bounds = np.searchsorted(text[lms][by_first], np.arange(symbols + 1))
    first_common = np.full(len(lms), 1, dtype=np.uint8)
    first_common[: bounds[1]] = 0
    first_common[bounds[:-1][bounds[:-1] < len(lms)]] = 0
    at, common = _induce(text, small, run_end, symbols, lms[by_first], first_common, bounds)
    # The left-most S among them, named by what they share up to the next left-most S.
    number = np.full(n, -1, dtype=np.int32)
    number[lms] = np.arange(len(lms))
    is_lms = number[at] >= 0
    found = at[is_lms]
    marks = np.flatnonzero(is_lms)
    least = np.minimum.reduceat(common[: marks[-1] + 1], np.r_[0, marks[:-1] + 1])
    upto = np.r_[lms[1:], n] - lms + 1
    span = upto[number[found]]
    same = (least[1:] >= np.minimum(span[1:], CAP)) & (span[1:] == span[:-1]) & (text[found[1:]] != 0)
    long = np.flatnonzero(same & (span[1:] > CAP))
    for k in long.tolist():  # longer than common prefixes are counted: look again
        a, b, w = int(found[k]), int(found[k + 1]), int(span[k])
        same[k] = bool((text[a : a + w] == text[b : b + w]).all())
    names = np.empty(len(lms), dtype=np.int64)
    names[number[found]] = np.r_[0, np.cumsum(~same)]
    order = lms[_doubled(names)] if len(lms) else lms
    shared = np.r_[np.zeros(1, dtype=np.uint8), _shared(data, left, order[:-1], order[1:])][: len(order)]
    at, common = _induce(text, small, run_end, symbols, order, shared, bounds)
    return at, common, text_of, start_of
