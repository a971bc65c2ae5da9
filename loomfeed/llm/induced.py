"""Suffix arrays by induced sorting, and permuted common prefixes, of arrays of symbols."""

from __future__ import annotations

import numpy as np

# Alphabets up to this size are induced bucket by bucket, larger ones suffix by suffix.
SMALL = 1024


def ascending(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last symbol is the least."""
    n = len(text)
    differ = np.ones(n, bool)
    differ[:-1] = text[:-1] != text[1:]
    rises = np.ones(n, bool)
    rises[:-1] = text[:-1] < text[1:]
    # In a run of one symbol the end of the run decides.
    to = np.minimum.accumulate(np.where(differ, np.arange(n), n - 1)[::-1])[::-1]
    return rises[to]


def _names(text: np.ndarray, up: np.ndarray, least: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the substrings between two leftmost-smaller positions, and their ranks.

    A symbol of a rising suffix is the greater of two equal ones, so no substring is a proper
    prefix of another. As many symbols as fit into a number are compared at once, and then the
    next ones of those that are still equal.
    """
    width = int(2 * symbols + 1).bit_length()
    at_once = 62 // width
    marked = text.astype(np.int64) * 2 + up + 1
    last = np.append(least[1:], len(text) - 1)

    def key(which, shift):
        out = np.zeros(len(which), np.int64)
        for k in range(at_once):
            at = least[which] + shift + k
            inside = at <= last[which]
            out = (out << width) | np.where(inside, marked[np.minimum(at, len(text) - 1)], 0)
        return out

    first = key(np.arange(len(least)), 0)
    order = np.argsort(first)
    ordered = first[order]
    new = np.ones(len(order), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    shift, long = at_once, last - least >= at_once
    while True:
        tied = ~new
        tied[:-1] |= ~new[1:]
        slots = np.flatnonzero(tied & long[order])
        if not len(slots):
            break
        group = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))[slots]
        which = order[slots]
        values = key(which, shift)
        by = np.lexsort((values, group))
        order[slots] = which[by]
        values = values[by]
        new[slots[1:]] |= (values[1:] != values[:-1]) & (group[1:] == group[:-1])
        shift += at_once
        long = last - least >= shift
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new) - 1
    return order, ranks


def _dealt(symbols: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by symbol, the place within its symbol of each, and how many each has."""
    order = np.argsort(symbols, kind="stable")
    counts = np.bincount(symbols, minlength=size)
    place = np.arange(len(symbols)) - (np.cumsum(counts) - counts)[symbols[order]]
    return order, place, counts


def _by_bucket(text: np.ndarray, up: np.ndarray, least: np.ndarray, symbols: int) -> np.ndarray:
    """The suffix array from the sorted leftmost-smaller suffixes; whole buckets at once."""
    n = len(text)
    small = text.astype(np.uint16)
    counts = np.bincount(text, minlength=symbols)
    ends = np.cumsum(counts)
    begins = ends - counts
    out = np.empty(n, np.int32)
    # Falling suffixes, from the smallest bucket up: each puts the one before it into its bucket.
    head = begins.copy()
    cuts = np.searchsorted(small[least], np.arange(symbols + 1))
    for c in np.flatnonzero(counts):
        done = begins[c]
        waiting = [least[cuts[c] : cuts[c + 1]]]
        while done < head[c] or waiting:
            if done < head[c]:
                batch = out[done : head[c]]
                done = head[c]
            else:
                batch = waiting.pop()
            before = batch[batch > 0] - 1
            before = before[~up[before]]
            if not len(before):
                continue
            order, place, number = _dealt(small[before], symbols)
            before = before[order]
            out[head[small[before]] + place] = before
            head += number
    falling = head.copy()
    # Rising suffixes, from the largest bucket down and from the right.
    tail = ends.copy()
    for c in np.flatnonzero(counts)[::-1]:
        done = ends[c]
        waiting = [out[begins[c] : falling[c]]]
        while tail[c] < done or waiting:
            if tail[c] < done:
                batch = out[tail[c] : done]
                done = tail[c]
            else:
                batch = waiting.pop()
            before = batch[batch > 0][::-1] - 1
            before = before[up[before]]
            if not len(before):
                continue
            order, place, number = _dealt(small[before], symbols)
            before = before[order]
            out[tail[small[before]] - 1 - place] = before
            tail -= number
    out[0] = n - 1
    return out


def _by_suffix(text: np.ndarray, up: np.ndarray, least: np.ndarray, symbols: int) -> np.ndarray:
    """The same for large alphabets, one suffix after the other."""
    ends = np.cumsum(np.bincount(text, minlength=symbols))
    begins = np.concatenate([[0], ends[:-1]])
    n, symbol, rising = len(text), text.tolist(), up.tolist()
    out = np.full(n, -1, np.int64)
    order, place, _ = _dealt(text[least[::-1]], symbols)
    backward = least[::-1][order]
    out[ends[text[backward]] - 1 - place] = backward
    out, head, tail = out.tolist(), begins.tolist(), ends.tolist()
    for i in range(n):
        j = out[i] - 1
        if j >= 0 and not rising[j]:
            c = symbol[j]
            out[head[c]] = j
            head[c] += 1
    for i in range(n - 1, -1, -1):
        j = out[i] - 1
        if j >= 0 and rising[j]:
            c = symbol[j]
            tail[c] -= 1
            out[tail[c]] = j
    return np.array(out, np.int32)


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """The order of the suffixes of ``text``, numbers below ``symbols``.

    Its last symbol occurs nowhere else and is the least. Suffixes are told apart by whether the
    next one is greater; of those that are, the leftmost of each stretch are sorted by the ranks
    of the substrings between them (where ranks repeat, as a text of a third or less of the
    length), and all others follow from these in two passes.
    """
    if len(text) == 1:
        return np.zeros(1, np.int32)
    up = ascending(text)
    least = np.flatnonzero(up[1:] & ~up[:-1]) + 1
    order, ranks = _names(text, up, least, symbols)
    most = int(ranks[order[-1]])
    if most + 1 < len(least):
        order = suffix_array(ranks, most + 1)
    induce = _by_bucket if symbols <= SMALL else _by_suffix
    return induce(text, up, least[order], symbols)


def permuted_prefixes(
    text: np.ndarray, array: np.ndarray, left: np.ndarray, apart: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each position the suffix before its own in order, and the length of their common prefix.

    A prefix ends where a part of the text does: ``left`` is what is left of a position's part,
    with its end mark ``apart``. Where the symbols before both suffixes are equal the prefix is
    one shorter than at the position before; only at the others are symbols compared, eight at
    once. The first suffix has itself before it and length 0.
    """
    n = len(text)
    before = np.empty(n, np.int32)
    before[array[1:]] = array[:-1]
    before[array[0]] = array[0]
    follows = np.zeros(n, bool)
    follows[1:] = (text[:-1] == text[before[1:] - 1]) & (text[:-1] != apart) & (before[1:] > 0)
    # A chain goes on only to the same two suffixes, one symbol later.
    follows[1:] &= before[1:] == before[:-1] + 1
    heads = np.flatnonzero(~follows)
    eight = np.zeros(n + 8, np.uint64)
    eight[:n] = text & 0xFF
    for width in (1, 2, 4):
        eight[:-width] |= eight[width:] << np.uint64(8 * width)
    most = np.minimum(left[heads], left[before[heads]])
    most[before[heads] == heads] = 0
    length = np.zeros(len(heads), np.int64)
    going = np.flatnonzero(most > 0)
    a, b = heads[going], before[heads[going]].astype(np.int64)
    while len(going):
        differ = eight[a] ^ eight[b]
        low = differ & (~differ + np.uint64(1))
        same = np.where(differ == 0, 8, np.bitwise_count(low - np.uint64(1)) // 8)
        length[going] += same
        on = (same == 8) & (length[going] < most[going])
        going, a, b = going[on], a[on] + 8, b[on] + 8
    length = np.minimum(length, most)
    sizes = np.diff(np.append(heads, n))
    since = np.arange(n) - np.repeat(heads, sizes)
    return before, np.maximum(np.repeat(length, sizes) - since, 0)
