"""Periodic runs of words, found with longest common extensions over difference-cover samples.

A run of period q and four periods or more keeps ``word[i] == word[i + q]`` over three periods, so
the multiples of 3q hit each run of that period: the grids of all periods together have about
n ln(n) / 3 points. From a point whose word fits, the run is extended to both sides by a longest
common extension (the left side on the reversed words). Most extensions end within the few words
up to the next place where both positions are sampled; only texts in which one does not get their
sampled suffixes sorted, and the rest of the extension is a minimum over their common prefixes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .text import distinct, record, slices, starts, within, words

# Every difference modulo MODULUS is one between two members of COVER.
MODULUS = 13
COVER = (0, 1, 3, 9)
# A run has so many words and so many periods, at least.
LEAST = 6
TIMES = 4
# Grid points tested at once.
POINTS = 1 << 20

_SAMPLED = np.isin(np.arange(MODULUS), COVER)
# Words to go from positions i and j (modulo MODULUS) until both are sampled.
_TO_SAMPLE = np.array(
    [
        [next(d for d in range(MODULUS) if _SAMPLED[(i + d) % MODULUS] and _SAMPLED[(j + d) % MODULUS]) for j in range(MODULUS)]
        for i in range(MODULUS)
    ]
)


def sort_samples(ids: np.ndarray, end: np.ndarray, sample: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Ranks of the suffixes at ``sample``, text by text, and what they share with the one before.

    ``end`` is the end of the text for every position, ``sample`` ascending and closed under steps
    of MODULUS within a text. First the words of one step refine the order, then the ranks one,
    two, four steps ahead; only groups that are still tied are sorted again. Returns the rank of
    each sample, and for each rank the number of words shared with the rank below (0 across texts).
    """
    place = np.full(len(ids), -1, np.int64)
    place[sample] = np.arange(len(sample))
    order = np.lexsort((ids[sample], end[sample]))
    new = np.ones(len(sample), bool)
    a, b = sample[order[1:]], sample[order[:-1]]
    new[1:] = (end[a] != end[b]) | (ids[a] != ids[b])
    rank = np.empty(len(sample), np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(sample)), 0))

    def refine(key) -> bool:
        """Sorts tied samples by ``key(sample numbers)``; whether any stay tied."""
        tied = ~new
        tied[:-1] |= ~new[1:]
        slots = np.flatnonzero(tied)
        if not len(slots):
            return False
        members = order[slots]
        values = key(members)
        by = np.lexsort((values, rank[members]))
        members, values = members[by], values[by]
        order[slots] = members
        new[slots[1:]] |= (values[1:] != values[:-1]) & (slots[1:] == slots[:-1] + 1)
        heads = np.maximum.accumulate(np.where(new[slots], slots, 0))
        rank[members] = heads
        return True

    def word(step):
        def key(members):
            at = sample[members] + step
            inside = at < end[sample[members]]
            return np.where(inside, ids[np.minimum(at, len(ids) - 1)], -1)

        return key

    def ahead(step):
        def key(members):
            at = sample[members] + step
            inside = at < end[sample[members]]
            return np.where(inside, rank[place[np.minimum(at, len(ids) - 1)]], -1)

        return key

    tied = True
    for step in range(1, MODULUS):
        tied = tied and refine(word(step))
    # Equal ranks in the k-th of these mean that MODULUS * 2**k words are equal.
    levels = [rank.copy()]
    while refine(ahead(MODULUS << (len(levels) - 1))):
        levels.append(rank.copy())
    shared = np.zeros(len(sample), np.int64)
    one = np.flatnonzero(end[sample[order[1:]]] == end[sample[order[:-1]]]) + 1
    a, b = sample[order[one]], sample[order[one - 1]]
    stop = end[a]
    for k in range(len(levels) - 1, -1, -1):
        inside = np.maximum(a, b) < stop
        same = np.zeros(len(a), bool)
        same[inside] = levels[k][place[a[inside]]] == levels[k][place[b[inside]]]
        a, b = a + same * (MODULUS << k), b + same * (MODULUS << k)
        shared[one] += same * (MODULUS << k)
    going = np.arange(len(one))
    for _ in range(MODULUS):
        going = going[np.maximum(a[going], b[going]) < stop[going]]
        going = going[ids[a[going]] == ids[b[going]]]
        shared[one[going]] += 1
        a[going] += 1
        b[going] += 1
    return rank, shared


def minima(values: np.ndarray, reach: int) -> list[np.ndarray]:
    """A sparse table: the k-th array has the minima of the 2**k values from each place on."""
    table = [values]
    while 2 << (len(table) - 1) <= reach:
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    return table


def extensions(ids: np.ndarray, end: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The number of equal words from ``i`` and from ``j`` on, i < j in one text."""
    length = np.zeros(len(i), np.int64)
    to_go = _TO_SAMPLE[i % MODULUS, j % MODULUS]
    going, met = np.arange(len(i)), []
    for step in range(MODULUS):
        there = to_go[going] == step
        met.append(going[there])
        going = going[~there]
        going = going[j[going] + step < end[j[going]]]
        going = going[ids[i[going] + step] == ids[j[going] + step]]
        length[going] += 1
    met = np.concatenate(met)
    met = met[j[met] + to_go[met] < end[j[met]]]
    if not len(met):
        return length
    a, b = i[met] + to_go[met], j[met] + to_go[met]
    needed = np.zeros(len(ids) + 1, bool)
    needed[end[a]] = True
    sample = np.flatnonzero(needed[end] & _SAMPLED[np.arange(len(ids)) % MODULUS])
    rank, shared = sort_samples(ids, end, sample)
    a, b = rank[np.searchsorted(sample, a)], rank[np.searchsorted(sample, b)]
    low, high = np.minimum(a, b) + 1, np.maximum(a, b)
    table = minima(shared, int((high - low).max()) + 1)
    level = np.frexp((high - low + 1).astype(float))[1] - 1
    for k in np.unique(level):
        own = np.flatnonzero(level == k)
        left, right = table[k][low[own]], table[k][high[own] - (1 << k) + 1]
        length[met[own]] += np.minimum(left, right)
    return length


def _grid(counts: np.ndarray, times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (in all texts put together) and periods of the grid points, some at a time."""
    most = counts // times
    doc, period = np.repeat(np.arange(len(counts)), most), within(most) + 1
    step = period * (times - 1)
    points = (counts[doc] - 1 - period) // step + 1
    begin, ends, first = 0, np.cumsum(points), starts(counts)[:-1]
    while begin < len(points):
        done = ends[begin - 1] if begin else 0
        to = max(begin + 1, int(np.searchsorted(ends, done + POINTS)))
        n = points[begin:to]
        place = np.repeat(first[doc[begin:to]], n) + np.repeat(step[begin:to], n) * within(n)
        yield place, np.repeat(period[begin:to], n)
        begin = to


def word_runs(ids: np.ndarray, counts: np.ndarray, least: int = LEAST, times: int = TIMES):
    """``doc``, ``start``, ``length`` and ``period`` of all runs, sorted in this order.

    ``ids`` are numbers of the words of all texts, one text after another.
    """
    at = starts(counts)
    found = [(p[same], q[same]) for p, q in _grid(counts, times) for same in [ids[p] == ids[p + q]]]
    if not sum(len(p) for p, _ in found):
        return (np.empty(0, np.int64),) * 4
    place, period = (np.concatenate(c) for c in zip(*found, strict=True))
    end = np.repeat(at[1:], counts)
    right = extensions(ids, end, place, place + period)
    # The same from the right: the words before both positions, in reverse.
    left = np.zeros(len(place), np.int64)
    inner = np.flatnonzero(place > at[np.searchsorted(at, place, "right") - 1])
    back = len(ids) - place[inner]
    mirrored = np.repeat(len(ids) - at[:-1][::-1], counts[::-1])
    left[inner] = extensions(ids[::-1], mirrored, back - period[inner], back)
    whole = left + right + period
    full = np.flatnonzero(whole >= np.maximum(least, times * period))
    start, length, period = place[full] - left[full], whole[full], period[full]
    # A multiple of a run's period gives the same stretch.
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[first], length[first], period[first]
    doc = np.searchsorted(at, start, "right") - 1
    start = start - at[doc]
    order = np.lexsort((period, start, doc))
    return doc[order], start[order], length[order], period[order]


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("kept_text", pa.string())]
)
RUNS_DDL = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, kept_text string"


def _runs(least: int, times: int):
    def run(batches):
        for rows in slices(batches):
            flat, counts = words(rows["text"])
            doc, start, length, period = word_runs(distinct(flat)[0], counts, least, times)
            at = starts(counts)
            edge = np.zeros(len(flat) + 1, np.int32)
            np.add.at(edge, at[doc] + start + period, 1)
            np.add.at(edge, at[doc] + start + length, -1)
            gone = np.cumsum(edge[:-1]) > 0
            kept = at[1:] - at[:-1] - np.diff(np.concatenate([[0], np.cumsum(gone)])[at])
            left = flat.filter(pa.array(~gone)) if gone.any() else flat
            texts = pa.ListArray.from_arrays(pa.array(starts(kept), pa.int32()), left)
            each = pa.StructArray.from_arrays([pa.array(c) for c in (start, length, period)], fields=list(RUN))
            ends = pa.array(starts(np.bincount(doc, minlength=len(counts))), pa.int32())
            out = {"doc_id": rows["doc_id"], "n_words": counts}
            out["runs"] = pa.ListArray.from_arrays(ends, each)
            out["kept_text"] = pc.binary_join(texts, " ")
            yield record(out, RUNS)

    return run


def find_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` and ``kept_text`` of every row.

    A run is a stretch of words with smallest period q that no neighbouring word extends, of
    ``least`` words and ``times`` periods (three or more) at least; ``runs`` lists ``start`` (from
    0), ``length`` and ``period`` by start, then period. ``kept_text`` leaves out the words of each
    run after its first period and joins the others by one space.

    Words are runs without ASCII white space, unchanged. A null, empty or blank text has no words,
    no runs and the empty ``kept_text``. Each row is judged alone, so ids may be null or repeated;
    other columns are not read; an empty table gives no rows. Memory grows with the longest text.
    """
    if times < 3:
        raise ValueError("a run has three periods or more")
    ids = docs.selectExpr("cast(doc_id as long) as doc_id", "text")
    return ids.mapInArrow(_runs(least, times), RUNS_DDL)
