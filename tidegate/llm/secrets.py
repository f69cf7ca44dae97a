"""Secret scan with one automaton for all rules.

The rules' patterns are read into one nondeterministic automaton over bytes, made deterministic by subset construction and
minimised by partition refinement. Its transition array is walked once over every byte; the bytes of a batch of texts are cut
into lanes that are walked side by side. A lane starts in the state that the lane before it ended in: lanes that began with a wrong
guess are walked again until they meet the states they had.

The automaton says in which lines a rule ends a match; only those lines are looked at again. There a rule's spans come from two
small automata of its own, made the same way: one for the pattern backwards, which walked from the end of the line says where matches
start, and one that from the first start on says how far the longest match goes. The next span starts behind that. So spans are leftmost and
longest, and a match that is too short uses up its characters as well. No rule can match across a line feed, which is checked when the rules are compiled.
Spans count code points, end exclusive. Null and empty texts have no spans. Rows are independent, so repeated rows and other columns
change nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as op
from re import _parser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds candidates; those whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The first three are fixed; matches that are too short are dropped after the search, so they still use up their characters.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
MORE = (
    Rule("forge", r"gh[opsu]_[A-Za-z0-9]+", 0, 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    Rule("payment", r"sk_live_[A-Za-z0-9]+", 0, 32),
    Rule("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
)
RULES = BASE + MORE
LANE = 512
SAME, STRETCH = 32, 1 << 16  # bytes that keep a state before a stretch of them is looked at, and how many at once


class Nfa:
    """States with byte-set moves and empty moves, built from the parse of a pattern."""

    def __init__(self) -> None:
        self.moves: list[list[tuple[frozenset, int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def add(self, parsed, start: int, fold: bool) -> int:
        """Append a parsed sequence after ``start``; the state it ends in."""
        for kind, value in parsed:
            start = self._item(kind, value, start, fold)
        return start

    def _item(self, kind, value, start: int, fold: bool) -> int:
        if kind is op.SUBPATTERN:
            _, on, off, inner = value
            return self.add(inner, start, (fold or bool(on & re.IGNORECASE)) and not off & re.IGNORECASE)
        end = self.state()
        if kind is op.BRANCH:
            for branch in value[1]:
                self.free[self.add(branch, start, fold)].append(end)
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            low, high, inner = value
            for _ in range(low):
                start = self.add(inner, start, fold)
            if high is op.MAXREPEAT:
                again = self.state()
                self.free[start].append(again)
                self.free[self.add(inner, again, fold)].append(again)
                start = again
            else:
                for _ in range(high - low):
                    self.free[start].append(end)
                    start = self.add(inner, start, fold)
            self.free[start].append(end)
        else:
            self.moves[start].append((_bytes(kind, value, fold), end))
        return end


def _bytes(kind, value, fold: bool) -> frozenset:
    if kind is op.LITERAL:
        found = {value}
    elif kind is op.IN and value[0][0] is not op.NEGATE:
        found = set()
        for item, at in value:
            if item not in (op.LITERAL, op.RANGE):
                raise ValueError(f"class item {item} is not supported")
            found |= {at} if item is op.LITERAL else set(range(at[0], at[1] + 1))
    else:
        raise ValueError(f"{kind} is not supported")
    if fold:
        found |= {ord(c) for b in found for c in (chr(b).lower(), chr(b).upper())}
    if max(found) > 127 or 10 in found:
        raise ValueError("rules are limited to ASCII without line feeds")
    return frozenset(found)


@dataclass(frozen=True)
class Automaton:
    """``classes`` maps a byte to its column; ``table[state * width + column]`` is the next state. 0 is the start.

    States from ``first_hit`` on end a match; ``hits[state]`` has a bit per rule.
    """

    classes: np.ndarray
    table: np.ndarray
    width: int
    first_hit: int
    hits: np.ndarray


def _automaton(nfa: Nfa, root: int, ends: dict[int, int], search: bool) -> Automaton:
    """Subset construction and minimisation. With ``search`` a match may begin at every byte, else only at the first one."""

    def closure(states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for s in nfa.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    signature = {b: tuple(b in symbols for moves in nfa.moves for symbols, _ in moves) for b in range(256)}
    columns = {s: i for i, s in enumerate(dict.fromkeys(signature.values()))}
    classes = np.array([columns[signature[b]] for b in range(256)], dtype=np.uint8)
    sample = [int(np.flatnonzero(classes == i)[0]) for i in range(len(columns))]
    start = closure([root])
    number, todo, rows, found = {start: 0}, [start], [], []
    while todo:
        states = todo.pop(0)
        found.append(sum({ends[s] for s in states if s in ends}))
        row = []
        for b in sample:
            after = closure([t for s in states for symbols, t in nfa.moves[s] if b in symbols] + [root] * search)
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            row.append(number[after])
        rows.append(row)
    return _minimal(classes, np.array(rows), np.array(found))


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Automaton:
    nfa = Nfa()
    root = nfa.state()
    ends: dict[int, int] = {}
    for number, rule in enumerate(rules):
        begin = nfa.state()
        nfa.free[root].append(begin)
        ends[nfa.add(_counted(rule) or _parser.parse(rule.pattern), begin, False)] = 1 << number
    return _automaton(nfa, root, ends, True)


def _backwards(parsed) -> list:
    """A parsed sequence whose matches are those of ``parsed`` read from their end."""
    out = []
    for kind, value in reversed(list(parsed)):
        if kind is op.SUBPATTERN:
            value = (*value[:3], _backwards(value[3]))
        elif kind is op.BRANCH:
            value = (value[0], [_backwards(branch) for branch in value[1]])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            value = (value[0], value[1], _backwards(value[2]))
        out.append((kind, value))
    return out


class Reader:
    """Reads the spans of one rule in a line: the leftmost and longest matches behind each other."""

    def __init__(self, rule: Rule):
        self.rule = rule
        parsed = _counted(rule) or list(_parser.parse(rule.pattern))
        self.starts = self._of(_backwards(parsed), True)
        self.longest = self._walker(parsed)
        # The value whose length counts ends the match; it is a repeated class, and begins where what is before it can first end.
        self.before = self.value = None
        if rule.group:
            self.before = self._walker(parsed[:-1])
            self.value = self._walker(parsed[-1:])

    @staticmethod
    def _of(parsed, search: bool) -> Automaton:
        nfa = Nfa()
        root = nfa.state()
        return _automaton(nfa, root, {nfa.add(parsed, root, False): 1}, search)

    def _walker(self, parsed) -> tuple[bytes, list[list[int]], list[bool], int, np.ndarray]:
        """Byte classes, moves and ends of an anchored automaton, the state from which no match comes, and which bytes keep a state."""
        machine = self._of(parsed, False)
        table = machine.table.reshape(-1, machine.width)
        moves, ends = table.tolist(), [bool(h) for h in machine.hits]
        dead = next((k for k, row in enumerate(moves) if not ends[k] and all(t == k for t in row)), -1)
        return machine.classes.tobytes(), moves, ends, dead, table[:, machine.classes] == np.arange(len(table))[:, None]

    @staticmethod
    def _ends(walker: tuple, line: bytes, start: int) -> Iterator[int]:
        """Where matches from ``start`` end, from shorter to longer."""
        classes, moves, ends, dead, _ = walker
        state = 0
        for at in range(start, len(line)):
            state = moves[state][classes[line[at]]]
            if state == dead:
                return
            if ends[state]:
                yield at + 1

    @staticmethod
    def _longest(walker: tuple, line: bytes, start: int) -> int:
        """Where the longest match from ``start`` ends. A long stretch that keeps the state is passed over as an array."""
        classes, moves, ends, dead, keeps = walker
        state, end, at, same = 0, start, start, 0
        while at < len(line):
            after = moves[state][classes[line[at]]]
            if after == dead:
                break
            at += 1
            same = same + 1 if after == state else 0
            state = after
            while same >= SAME and at < len(line):
                kept = keeps[state][np.frombuffer(line, dtype=np.uint8, count=min(STRETCH, len(line) - at), offset=at)]
                step = len(kept) if kept.all() else int(kept.argmin())
                at += step
                if step < len(kept):
                    same = 0
            if ends[state]:
                end = at
        return end

    def _value(self, line: bytes, start: int, end: int) -> int:
        """Where the counted value of a match begins."""
        for at in self._ends(self.before, line, start):
            if at < end and next(self._ends(self.value, line[at : at + 1], 0), 0):
                return at
        return start

    def spans(self, lines: list[bytes]) -> list[list[tuple[int, int]]]:
        """Per line its spans; where matches start is found for all lines in one pass."""
        data = b"\n".join(line[::-1] for line in lines)
        at, _ = scan(self.starts, data)
        at.sort()
        firsts = np.cumsum([0] + [len(line) + 1 for line in lines])
        cuts = np.searchsorted(at, firsts).tolist()
        out = []
        for k, line in enumerate(lines):
            starts = (int(firsts[k]) + len(line) - 1 - at[cuts[k] : cuts[k + 1]])[::-1]
            found, behind, place = [], 0, 0
            while (place := place + int(np.searchsorted(starts[place:], behind))) < len(starts):
                start = int(starts[place])
                end = self._longest(self.longest, line, start)
                if end - (self._value(line, start, end) if self.before else start) >= self.rule.least:
                    found.append((start, end))
                behind = end
            out.append(found)
        return out


def _counted(rule: Rule):
    """For a rule that is a repeated class and nothing else, the class repeated as often as the shortest match that is kept.

    Such a class has matches in ordinary words. Other rules begin with rare letters, and counting theirs too would multiply states.
    """
    parsed = list(_parser.parse(rule.pattern))
    kind, value = parsed[0]
    if len(parsed) > 1 or rule.group or kind is not op.MAX_REPEAT or value[1] is not op.MAXREPEAT or value[2].getwidth() != (1, 1):
        return None
    return [(kind, (max(value[0], rule.least), value[1], value[2]))]


def _minimal(classes: np.ndarray, rows: np.ndarray, hits: np.ndarray) -> Automaton:
    """Merge states that no continuation tells apart, and number those that end a match last."""
    block = np.unique(hits, return_inverse=True)[1]
    while True:
        refined = np.unique(np.column_stack((block, block[rows])), axis=0, return_inverse=True)[1].ravel()
        if refined.max() == block.max():
            break
        block = refined
    first = np.unique(block, return_index=True)[1]
    order = sorted(range(len(first)), key=lambda b: (hits[first[b]] != 0, b != block[0], b))
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    kept = first[order]
    table = place[block[rows[kept]]]
    return Automaton(classes, table.astype(np.int32).ravel(), rows.shape[1], int((hits[kept] == 0).sum()), hits[kept])


def scan(machine: Automaton, data: bytes, lane: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """Positions of bytes at which some rule ends a match, and the state reached there, over ``data`` in one pass."""
    n = len(data)
    lanes = -(-n // lane)
    columns = np.full(lanes * lane, machine.classes[10], dtype=np.uint8)
    columns[:n] = machine.classes[np.frombuffer(data, dtype=np.uint8)]
    columns = np.ascontiguousarray(columns.reshape(lanes, lane).T).astype(np.int32)
    states = np.zeros((lane, lanes), dtype=np.int16 if len(machine.hits) < 1 << 15 else np.int32)
    now = np.zeros(lanes, dtype=np.int32)
    for at in range(lane):
        now = machine.table[now * machine.width + columns[at]]
        states[at] = now
    began = np.zeros(lanes, dtype=np.int32)
    ahead = 1
    while True:
        ends = np.concatenate(([0], states[-1, :-1])).astype(np.int32)
        wrong = np.flatnonzero(ends != began)
        if not len(wrong):
            break
        # A lane that ended as it began, like one inside a long value, hands its state on to lanes that are all like it. So the next
        # lanes, twice as many in each round, are walked from the same state as well; where that is wrong, a later round mends it.
        kept = (wrong > 0) & (began[wrong - 1] == ends[wrong])
        stop = np.minimum(np.append(wrong[1:], lanes), np.where(kept, wrong + ahead, wrong + 1))
        sizes = stop - wrong
        begin = np.repeat(ends[wrong], sizes)
        todo = np.repeat(wrong - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
        ahead *= 2
        began[todo] = begin
        now = begin
        for at in range(lane):
            now = machine.table[now * machine.width + columns[at, todo]]
            differ = states[at, todo] != now
            if not differ.any():
                break
            states[at, todo] = now
    step, which = np.nonzero(states >= machine.first_hit)
    return which * lane + step, states[step, which]


def _lines(data: bytes, machine: Automaton) -> Iterator[tuple[int, int, int]]:
    """``start, end, bits`` of the lines of ``data`` in which rules end a match."""
    at, state = scan(machine, data)
    if not len(at):
        return
    order = np.argsort(at, kind="stable")
    at, bits = at[order], machine.hits[state[order]]
    breaks = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 10)
    line = np.searchsorted(breaks, at)
    firsts = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
    for k, found in zip(line[firsts].tolist(), np.bitwise_or.reduceat(bits, firsts).tolist()):
        yield (int(breaks[k - 1]) + 1 if k else 0), (int(breaks[k]) if k < len(breaks) else len(data)), found


def found_in(
    texts: list[str | None], machine: Automaton, rules: tuple[Rule, ...] = RULES, readers: list[Reader] | None = None
) -> list[list[tuple[int, int, int]]]:
    """Per text its spans as ``start, number of the rule, end``, sorted."""
    readers = readers or [Reader(r) for r in rules]
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = b"\n".join(raw)
    begins = np.cumsum([0] + [len(r) + 1 for r in raw])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    marked, last, chars_at, bytes_at = [], -1, 0, 0
    for start, end, bits in _lines(data, machine):
        doc = int(np.searchsorted(begins, start, side="right")) - 1
        if doc != last:
            last, chars_at, bytes_at = doc, 0, int(begins[doc])
        chars_at += len(data[bytes_at:start].decode("utf-8", "surrogatepass"))
        bytes_at = start
        marked.append((doc, data[start:end], bits, chars_at))
    for number, reader in enumerate(readers):
        mine = [m for m in marked if m[2] >> number & 1]
        for (doc, line, _, chars), found in zip(mine, reader.spans([m[1] for m in mine]) if mine else ()):
            # Code points before each byte: bytes that go on with one don't count.
            before = range(len(line) + 1) if line.isascii() else np.cumsum([0, *((np.frombuffer(line, dtype=np.uint8) & 0xC0) != 0x80)])
            out[doc] += [(chars + int(before[a]), number, chars + int(before[b])) for a, b in found]
    return [sorted(spans) for spans in out]


def written_out(spans: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> str:
    return ",".join(f"{rules[number].kind}:{start}:{end}" for start, number, end in spans)


AT_ONCE = 4 << 20


def secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row of ``docs``: doc_id, the number of spans of each base kind, a digest of the base spans, and all spans."""
    machine, readers = compile_rules(rules), [Reader(r) for r in rules]
    base = len(BASE)

    def batches(texts: list) -> Iterator[list]:
        some, size = [], 0
        for t in texts:
            some.append(t)
            size += len(t or "")
            if size > AT_ONCE:
                yield some
                some, size = [], 0
        if some:
            yield some

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [spans for some in batches(list(frame["text"])) for spans in found_in(some, machine, rules, readers)]
            first = [[s for s in spans if s[1] < base] for spans in found]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"].astype("Int64"),
                    **{f"n_{rules[k].kind}": [sum(s[1] == k for s in spans) for spans in first] for k in range(base)},
                    "base_sha256": [hashlib.sha256(written_out(spans, rules).encode()).hexdigest() for spans in first],
                    "spans": [written_out(spans, rules) for spans in found],
                }
            )

    counts = ", ".join(f"n_{rules[k].kind} long" for k in range(base))
    plain = docs.select(F.col("doc_id").cast("long"), "text")
    return plain.mapInPandas(search, f"doc_id long, {counts}, base_sha256 string, spans string")
