"""Removes bytes covered by a string of ``SPAN`` bytes that also starts in a document with a smaller doc_id.

Exact copies of a text are one text, owned by its smallest doc_id. Texts are dealt into shards. Each string of ``SPAN`` bytes has
an anchor, the smallest hash of the ``ANCHOR``-byte strings in it, so equal strings have equal anchors, and neighbouring strings
mostly share theirs. An anchor lies at the same place of equal strings, so they also have its context in common: the bytes around
it that are in all strings with the anchor in that part of them. Contexts that occur in one text only can't belong to a repeated
string. The others' fragments (the bytes of neighbouring strings with the same anchor) go to the place of their anchor, equal ones
of a shard once, with the smallest and largest doc_id. There the different fragments are cut to the runs of strings whose hash is in
another one too, and equal runs become one. The suffixes of the runs that still have such a string are put in order by induced
sorting (``induced``), whose common prefixes say which strings are equal; strings that are in one fragment or run only need no
order. The smallest owner of each string goes back to the shards of the texts. Hash values only decide where strings are compared,
never whether they are equal.

Null and empty texts have no bytes and lose nothing. Rows with the same doc_id are documents of their own, neither smaller than
the other; a null doc_id is larger than all others. Other columns change nothing.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidegate.llm.induced import sorted_suffixes

SPAN = 50
ANCHOR = 16
SHARD_BYTES = 8 << 20  # of text
PLACE_BYTES = 16 << 20  # of text for each shard of anchors, whose fragments are at most a few times as much
SLICE = 1 << 17
MOST_STRINGS = 256  # of a fragment, before the anchor moves; a longer one goes on in the next
CONTEXTS = 2  # parts of a string in which its anchor can start
POSITION = np.uint64((1 << 31) - 1)  # bits of a hash that give way to its position
LAST = (1 << 62) - 1  # stands for a null doc_id
ODD = tuple(np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _hashes(data: np.ndarray, width: int, at: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each string of ``width`` bytes, 8 at least, or of those at some positions."""
    words = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    n = len(data) - width + 1
    word = (lambda k: words[k : k + n]) if at is None else (lambda k: words[at + k])
    out = word(0) * ODD[0]
    for k in [*range(8, width - 7, 8), *([width - 8] if width % 8 else [])]:
        out = (out ^ (out >> np.uint64(31))) * ODD[2]
        out += word(k) * ODD[1]
    out ^= out >> np.uint64(29)
    out *= ODD[2]
    return out ^ (out >> np.uint64(32))


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return np.minimum(values[: len(values) - (width - step)], values[width - step :]) if step < width else values


def fragments(texts: list[bytes], span: int, anchor: int, contexts: int = 0) -> tuple[np.ndarray, ...]:
    """Anchor, text number, start and number of strings of every fragment; fragment and hash of every context.

    A context is taken for each of ``contexts`` equal parts of a string in which the anchor of a fragment's string starts: what all
    strings with their anchor there have in common.
    """
    found, first, so_far = [], 0, 0
    borders = [-(-(span - anchor + 1) * k // contexts) for k in range(contexts + 1)] if contexts else []
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (size < SLICE or last == first):
            size += len(texts[last])
            last += 1
        if size >= span:
            ends = np.cumsum([len(t) for t in texts[first:last]])
            starts = np.r_[0, ends[:-1]]
            data = np.frombuffer(b"".join(texts[first:last]), dtype=np.uint8)
            hashes = _hashes(data, anchor)
            # Of equal hashes the first counts, so that the anchors of equal strings are at the same place in them.
            low = _lowest((hashes & ~POSITION) | np.arange(len(hashes), dtype=np.uint64), span - anchor + 1)
            cut = np.r_[True, low[1:] != low[:-1]]
            cut[starts[starts < len(low)]] = True
            at = np.flatnonzero(cut)
            text = np.searchsorted(ends, at, side="right")
            stop = np.minimum(np.r_[at[1:], len(low)], ends[text] - span + 1)
            good = stop > at
            at, stop, text = at[good], stop[good], text[good]
            place = (low[at] & POSITION).astype(np.int64)
            value = hashes[place]
            # Neighbours whose anchors are equal make one fragment.
            new = np.r_[True, (value[1:] != value[:-1]) | (text[1:] != text[:-1])][: len(at)]
            run = np.cumsum(new) - 1
            nth = (at - at[new][run]) // MOST_STRINGS
            new[1:] |= nth[1:] != nth[:-1]
            head = np.flatnonzero(new)
            count = stop[np.r_[head[1:], len(at)] - 1] - at[head] if len(head) else head
            part, keys = [], []
            of = np.cumsum(new) - 1 + so_far
            before, least = place - at, place - stop + 1  # most and fewest bytes before the anchor in a string
            for k in range(contexts):
                use = np.flatnonzero((least < borders[k + 1]) & (before >= borders[k]))
                part.append(of[use])
                keys.append(_hashes(data, anchor + borders[k] + span - anchor - borders[k + 1] + 1, place[use] - borders[k]))
            so_far += len(head)
            none = np.zeros(0, dtype=np.int64)
            found.append((value[head], text[head] + first, at[head] - starts[text[head]], count, np.concatenate([none, *part]), np.concatenate([none.astype(np.uint64), *keys])))
        first = last
    if not found:
        found = [tuple(np.zeros(0, dtype=np.uint64 if k in (0, 5) else np.int64) for k in range(6))]
    return tuple(np.concatenate(column) for column in zip(*found))


def _once(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts that a task has seen before go on without their bytes, and only if they have a smaller owner now."""
    owner: dict[bytes, int] = {}
    for frame in frames:
        new = []
        for digest, doc, data in zip(frame["digest"], frame["doc"], frame["data"]):
            if digest not in owner:
                new.append((digest, doc, data))
                owner[digest] = doc
            elif doc < owner[digest]:
                new.append((digest, doc, None))
                owner[digest] = doc
        yield pd.DataFrame(new, columns=["digest", "doc", "data"])


def _owned(frame: pd.DataFrame) -> tuple[list[bytes], np.ndarray, list[bytes]]:
    """Digests, smallest owners and bytes of the different texts of a shard."""
    owner: dict[bytes, int] = {}
    texts: dict[bytes, bytes] = {}
    for digest, doc, data in zip(frame["digest"], frame["doc"], frame["data"]):
        owner[digest] = min(doc, owner.get(digest, doc))
        if data is not None:
            texts[digest] = data
    names = sorted(owner)
    return names, np.array([owner[n] for n in names], dtype=np.int64), [texts[n] for n in names]


def _groups(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(keys, kind="stable")
    starts = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]]) if len(keys) else []
    for a, b in zip(starts, [*starts[1:], len(keys)]):
        yield int(keys[order[a]]), order[a:b]


def _packed(values: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones: bytes that are much the same compress well."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind)[:, 0]


def _numbered(texts: list[bytes], of: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Numbers of the pieces of texts, equal ones having the same, in the order in which they come first; the different pieces."""
    number: dict[bytes, int] = {}
    each = [number.setdefault(texts[t][a:b], len(number)) for t, a, b in zip(of.tolist(), start.tolist(), (start + size).tolist())]
    return np.array(each, dtype=np.int64), list(number)


def _place(anchors: np.ndarray, places: int) -> np.ndarray:
    return ((anchors >> np.uint64(32)) % np.uint64(places)).astype(np.int64)


def _named(place: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of contexts, and 32 bits that name them there, in one number."""
    return (place.astype(np.uint64) << np.uint64(32)) | (keys & np.uint64(0xFFFFFFFF))


def _in_several(keys: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of the keys, the starts of equal ones in it, and whether those are of more than one ``of``."""
    order = np.argsort(keys)
    ranked, of = keys[order], of[order]
    starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]][: len(keys)])
    return order, starts, np.minimum.reduceat(of, starts) != np.maximum.reduceat(of, starts) if len(starts) else starts > 0


def _shared(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Whether each key is also one of another ``of``."""
    order, starts, several = _in_several(keys, of)
    out = np.empty(len(keys), dtype=bool)
    out[order] = np.repeat(several, np.diff(np.r_[starts, len(keys)]))
    return out


def _listed(which: np.ndarray, of: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """For rows in the order of ``of``: each of ``which`` with every row of its group, as places in ``which`` and rows."""
    first = np.searchsorted(of, np.arange(groups + 1))
    each = np.diff(first)[which]
    at = np.repeat(np.arange(len(which)), each)
    return at, np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each) + first[which[at]]


def smallest_owners(parts: list[bytes], smallest: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Strings of different fragments, cut where the smallest owner may change: fragment, from, to, owner, by fragment."""
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    strings = sizes - span + 1
    of = np.repeat(np.arange(len(parts)), strings)
    offset = np.arange(len(of)) - np.repeat(np.cumsum(strings) - strings, strings)
    hashes = _hashes(np.frombuffer(b"".join(parts), dtype=np.uint8), span, (np.cumsum(sizes) - sizes)[of] + offset)
    shared = _shared(hashes, of)
    new = np.r_[True, (of[1:] != of[:-1]) | (shared[1:] != shared[:-1])][: len(of)]
    head = np.flatnonzero(new)
    run_of, begin, again = of[head], offset[head], shared[head]
    end = offset[np.r_[head[1:], len(of)] - 1] + 1 if len(head) else head
    single = ~again
    cuts = [(run_of[single], begin[single], end[single], smallest[run_of[single]])]
    run_of, begin, end, head = run_of[again], begin[again], end[again], head[again]
    if len(run_of):
        content, runs = _numbered(parts, run_of, begin, end - begin + span - 1)
        least = np.full(len(runs), LAST, dtype=np.int64)
        np.minimum.at(least, content, smallest[run_of])
        one = np.empty(len(runs), dtype=np.int64)  # a run of each content
        one[content] = np.arange(len(content))
        length = (end - begin)[one]
        which = np.repeat(np.arange(len(runs)), length)
        place = np.arange(len(which)) - np.repeat(np.cumsum(length) - length, length) + head[one][which]
        several = np.unique(which[_shared(hashes[place], which)])
        alone = np.ones(len(runs), dtype=bool)
        alone[several] = False
        alone = np.flatnonzero(alone)
        inner = [(alone, np.zeros(len(alone), dtype=np.int64), length[alone], least[alone])]
        if len(several):
            inner.append(_by_suffixes([runs[k] for k in several], several, length[several], least[several], span))
        inner_of, inner_begin, inner_end, owner = (np.concatenate(c) for c in zip(*inner))
        order = np.argsort(inner_of, kind="stable")
        inner_of, inner_begin, inner_end, owner = inner_of[order], inner_begin[order], inner_end[order], owner[order]
        at, cut = _listed(content, inner_of, len(runs))
        cuts.append((run_of[at], begin[at] + inner_begin[cut], begin[at] + inner_end[cut], owner[cut]))
    fragment, begin, end, owner = (np.concatenate(c) for c in zip(*cuts))
    order = np.argsort(fragment, kind="stable")
    return fragment[order], begin[order], end[order], owner[order]


def _by_suffixes(runs: list[bytes], names: np.ndarray, strings: np.ndarray, smallest: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``smallest_owners``, for runs that have strings in common, with the suffixes in order."""
    at, shared, text_of, start_of = sorted_suffixes(runs)
    run, offset = text_of[at], at - start_of[text_of[at]]
    whole = offset < strings[run]
    owner = np.where(whole, smallest[run], LAST)
    starts = np.flatnonzero(np.r_[True, shared[1:] < span])
    least = np.repeat(np.minimum.reduceat(owner, starts), np.diff(np.r_[starts, len(at)]))
    run, offset, least = run[whole], offset[whole], least[whole]
    order = np.lexsort((offset, run))
    run, offset, least = run[order], offset[order], least[order]
    new = np.flatnonzero(np.r_[True, (run[1:] != run[:-1]) | (least[1:] != least[:-1])])
    return names[run[new]], offset[new], offset[np.r_[new[1:], len(order)] - 1] + 1, least[new]


def removed(docs: DataFrame, span: int = SPAN, anchor: int = ANCHOR, shard_bytes: int = SHARD_BYTES, place_bytes: int = PLACE_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards, places = max(1, math.ceil(total / shard_bytes)), max(1, math.ceil(total / place_bytes))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.unhex(F.md5(text)).alias("digest"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.to_binary(text, F.lit("utf-8")).alias("data"))
    once = rows.mapInPandas(_once, "digest binary, doc long, data binary")
    dealt = once.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)))

    def anchors(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        values, owner, _, _, part, keys = fragments(_owned(frame)[2], span, anchor, CONTEXTS)
        names = _named(_place(values, places)[part], keys)
        order, starts, many = _in_several(names, owner[part])
        names = names[order][starts]
        place, name = (names >> np.uint64(32)).astype(np.int64), names.astype(np.uint32)
        found = [(p, key[0], _packed(np.diff(name[i], prepend=name.dtype.type(0))), many[i].tobytes()) for p, i in _groups(place)]  # names are in order
        return pd.DataFrame(found, columns=["place", "shard", "names", "many"])

    def repeated(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        names = [np.cumsum(_unpacked(b, np.uint32), dtype=np.uint32) for b in frame["names"]]
        many = np.concatenate([np.frombuffer(b, dtype=bool) for b in frame["many"]])
        source = np.repeat(np.arange(len(names)), [len(n) for n in names])
        names = np.concatenate(names)
        order = np.argsort(names, kind="stable")
        again = np.r_[names[order][1:] == names[order][:-1], False]
        many[order[again]] = True
        many[order[np.r_[False, again[:-1]]]] = True
        shard = frame["shard"].to_numpy()
        names, source = names[many], source[many]
        return pd.DataFrame([(shard[s], key[0], _packed(np.diff(names[i], prepend=names.dtype.type(0)))) for s, i in _groups(source)], columns=["shard", "place", "names"])

    def candidates(key: tuple, frame: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        columns = ["place", "shard", "fragments", "low", "more", "sizes", "bytes"]
        if not len(frame) or not len(known):
            return pd.DataFrame([], columns=columns)
        _, docs_of, texts = _owned(frame)
        values, owner, start, count, part, keys = fragments(texts, span, anchor, CONTEXTS)
        wanted = np.sort(np.concatenate([(np.uint64(p) << np.uint64(32)) | np.cumsum(_unpacked(b, np.uint32), dtype=np.uint32).astype(np.uint64) for p, b in zip(known["place"], known["names"])]))
        place = _place(values, places)
        asked = _named(place[part], keys)
        hit = np.unique(part[wanted[np.minimum(np.searchsorted(wanted, asked), len(wanted) - 1)] == asked])
        content, parts = _numbered(texts, owner[hit], start[hit], count[hit] + span - 1)
        low, high = np.full(len(parts), np.iinfo(np.int64).max), np.full(len(parts), np.iinfo(np.int64).min)
        np.minimum.at(low, content, docs_of[owner[hit]])
        np.maximum.at(high, content, docs_of[owner[hit]])
        first = np.empty(len(parts), dtype=np.int32)
        first[content[::-1]] = hit[::-1]
        more = high - low
        sizes = np.array([len(p) for p in parts], dtype=np.int32)
        found = [(p, key[0], *(_packed(c[i]) for c in (first, low, more, sizes)), b"".join([parts[k] for k in i.tolist()])) for p, i in _groups(place[first])]
        return pd.DataFrame(found, columns=columns)

    def ordered(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        fragment, low, more = (np.concatenate([_unpacked(b, kind) for b in frame[c]]) for c, kind in (("fragments", np.int32), ("low", np.int64), ("more", np.int64)))
        high = low + more
        sizes = [_unpacked(b, np.int32) for b in frame["sizes"]]
        shard = np.repeat(frame["shard"].to_numpy(), [len(s) for s in sizes])
        ends = [np.cumsum(s) for s in sizes]
        rows = np.repeat(np.arange(len(sizes)), [len(s) for s in sizes])
        sizes, ends = np.concatenate(sizes), np.concatenate(ends)
        content, parts = _numbered(list(frame["bytes"]), rows, ends - sizes, sizes)
        smallest = np.full(len(parts), LAST, dtype=np.int64)
        np.minimum.at(smallest, content, low)
        of, begin, end, owner = smallest_owners(parts, smallest, span)
        which, cut = _listed(content, of, len(parts))  # every occurrence gets the cuts of its fragment
        use = owner[cut] < high[which]
        which, cut = which[use], cut[use]
        found = [
            (s, _packed(fragment[which[i]]), *(_packed(c[cut[i]].astype(np.int32)) for c in (begin, end)), _packed(owner[cut[i]]))
            for s, i in _groups(shard[which])
        ]
        return pd.DataFrame(found, columns=["shard", "fragments", "begins", "ends", "owners"])

    def covered(key: tuple, frame: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        columns = ["digest", "owner", "n_removed", "n_spans", "kept"]
        if not len(frame):
            return pd.DataFrame([], columns=columns)
        names, docs_of, texts = _owned(frame)
        touched: set[int] = set()
        ends = np.cumsum([len(t) for t in texts])
        if len(known):
            values, owner, start, count, _, _ = fragments(texts, span, anchor)
            array = lambda c, kind=np.int32: np.concatenate([_unpacked(b, kind) for b in known[c]])
            begin, end, first = array("begins"), array("ends"), array("owners", np.int64)
            # Fragments with the anchor of one that has cuts get the cuts if they have its bytes.
            those, cut_of = np.unique(array("fragments"), return_inverse=True)
            asked = np.unique(values[those])
            hit = np.flatnonzero(asked[np.minimum(np.searchsorted(asked, values), len(asked) - 1)] == values)
            content, _ = _numbered(texts, *(np.concatenate((c[those], c[hit])) for c in (owner, start, count + span - 1)))
            content = content[len(those) :]
            hit, content = hit[content < len(those)], content[content < len(those)]
            order = np.argsort(cut_of, kind="stable")
            which, cut = _listed(content, cut_of[order], len(those))
            which, cut = hit[which], order[cut]
            use = first[cut] < docs_of[owner[which]]
            which, cut = which[use], cut[use]
            touched = set(owner[which].tolist())
            place = (ends - [len(t) for t in texts])[owner[which]] + start[which]
            change = np.zeros(ends[-1] + 1, dtype=np.int32)
            np.add.at(change, place + begin[cut], 1)
            np.add.at(change, place + end[cut] - 1 + span, -1)
            gone_at = np.cumsum(change[:-1], dtype=np.int32) > 0
        found = []
        for t, (name, data) in enumerate(zip(names, texts)):
            kept, gone, runs = data, 0, 0
            if t in touched:
                out = gone_at[ends[t] - len(data) : ends[t]]
                gone, runs = int(out.sum()), int((out & ~np.r_[False, out[:-1]]).sum())
                kept = np.frombuffer(data, dtype=np.uint8)[~out].tobytes()
            found.append((name, docs_of[t], gone, runs, hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(found, columns=columns)

    by_place = dealt.groupBy("shard").applyInPandas(anchors, "place long, shard long, names binary, many binary")
    known = by_place.groupBy("place").applyInPandas(repeated, "shard long, place long, names binary")
    parts = dealt.groupBy("shard").cogroup(known.groupBy("shard")).applyInPandas(
        candidates, "place long, shard long, fragments binary, low binary, more binary, sizes binary, bytes binary"
    )
    owners = parts.groupBy("place").applyInPandas(ordered, "shard long, fragments binary, begins binary, ends binary, owners binary")
    result = dealt.groupBy("shard").cogroup(owners.groupBy("shard")).applyInPandas(
        covered, "digest binary, owner long, n_removed long, n_spans long, kept string"
    )
    each = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.unhex(F.md5(text)).alias("_digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    out = each.join(result, F.col("_digest") == F.col("digest"))
    copy = (F.col("doc") > F.col("owner")) & (F.col("n_bytes") >= span)
    return out.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.col("kept")).alias("kept_sha256"),
    )
