"""Periodic runs against a scan of every period."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from loomfeed.llm import periodic, queries
from loomfeed.llm.periodic import extensions, find_runs, word_runs

from .conftest import FOLDER, HARD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, least=6, times=4):
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            begin = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i - begin + q
            if i > begin and length >= max(least, times * q):
                found.setdefault((begin, length), q)
            i += i == begin
    return sorted((s, n, q) for (s, n), q in found.items())


def texts(make):
    docs = []
    for _ in range(make.randint(1, 12)):
        n, letters = make.randint(0, 160), make.choice([1, 2, 3, 6])
        w = [make.randrange(letters) for _ in range(n)]
        for _ in range(make.randint(0, 3) if n > 10 else 0):
            p, a = make.randint(1, 12), make.randrange(n)
            for x in range(a + p, min(n, a + p * make.randint(3, 9) + make.randrange(p))):
                w[x] = w[x - p]
        docs.append(w)
    return docs


@pytest.mark.parametrize("least,times", [(6, 4), (4, 3), (9, 5)])
def test_runs(least, times, monkeypatch):
    make = random.Random(times)
    for turn in range(80):
        if turn == 40:
            monkeypatch.setattr(periodic, "POINTS", 7)  # grids in many parts
        docs = texts(make)
        ids = np.array([x for d in docs for x in d], np.int64)
        counts = np.array([len(d) for d in docs], np.int64)
        got = [[] for _ in docs]
        for doc, *run in zip(*(c.tolist() for c in word_runs(ids, counts, least, times)), strict=True):
            got[doc].append(tuple(run))
        assert got == [brute(d, least, times) for d in docs]


def test_extensions():
    make = random.Random(9)
    for _ in range(40):
        docs = [[make.randrange(2) for _ in range(make.randint(2, 9))] * make.randint(1, 25) for _ in range(4)]
        ids = np.array([x for d in docs for x in d], np.int64)
        counts = np.array([len(d) for d in docs])
        end = np.repeat(np.cumsum(counts), counts)
        pairs = [sorted(make.sample(range(e - n, e), 2)) for n, e in zip(counts, np.cumsum(counts)) for _ in range(30) if n > 1]
        i, j = np.array(pairs).T
        for a, b, found in zip(i, j, extensions(ids, end, i, j)):
            n = 0
            while b + n < end[b] and ids[a + n] == ids[b + n]:
                n += 1
            assert n == found


def expected(doc, text):
    w = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc).encode()), len(w)
    if doc is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    return doc, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *sha


def test_query_equals_brute_force(llm, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect() if len(r["text"] or "") < 6000]
    found = {r[0]: tuple(r) for r in queries.QUERIES["op13_difference_cover"](llm, FOLDER).collect()}
    assert len(found) == documents.count() and len(rows) > 800
    for doc, text in rows:
        assert found[doc] == expected(doc, text)
    assert sum(r[1] > 0 for r in found.values()) > 50


def test_query_on_hard_rows(llm, hard, empty, folder):
    for name, docs in (("hard", hard), ("empty", empty)):
        docs.write.parquet(f"{folder}/{name}/documents.parquet")
        rows = queries.QUERIES["op13_difference_cover"](llm, f"{folder}/{name}").collect()
        # The text of one word in many thousands has no run; brute force would take too long on it.
        wanted = [expected(*r[:2]) for r in HARD if r[0] != 9] if name == "hard" else []
        assert sorted((tuple(r) for r in rows if r[0] != 9), key=str) == sorted(wanted, key=str)


def test_find_runs(hard, empty):
    rows = find_runs(hard).collect()
    assert len(rows) == len(HARD) and find_runs(empty).count() == 0
    by = {r["doc_id"]: r for r in rows}
    assert [tuple(x) for x in by[10]["runs"]] == [(0, 96, 1)] and by[10]["kept_text"] == "same"
    for doc in (2, 3, 4):
        assert (by[doc]["n_words"], by[doc]["runs"], by[doc]["kept_text"]) == (0, [], "")
    with pytest.raises(ValueError):
        find_runs(hard, times=2)


def test_long_periodic_text(llm):
    """A text of a hundred thousand words with one period."""
    w = [f"w{i}" for i in range(700)] * 150
    text = " ".join(["x", *w, "y"])
    row = find_runs(llm.createDataFrame([(1, text)], "doc_id long, text string")).head()
    assert [tuple(x) for x in row["runs"]] == [(1, len(w), 700)]
    assert row["kept_text"] == " ".join(["x", *w[:700], "y"])
