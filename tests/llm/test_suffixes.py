"""Repeated byte strings against brute force; suffix arrays against sorting."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from loomfeed.llm import induced, queries
from loomfeed.llm.induced import permuted_prefixes, suffix_array
from loomfeed.llm.suffixes import remove_repeated_strings

from .conftest import FOLDER, HARD


def brute(texts, string=200):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + string] for d in data for i in range(len(d) - string + 1))
    out = []
    for d in data:
        gone, covered = bytearray(len(d)), 0
        for i in range(len(d) - string + 1):
            if count[d[i : i + string]] > 1:
                begin = max(i, covered)
                covered = i + string
                gone[begin:covered] = b"\1" * (covered - begin)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), spans, kept))
    return out


@pytest.mark.parametrize("small", [0, 1024])
def test_suffix_arrays(small, monkeypatch):
    monkeypatch.setattr(induced, "SMALL", small)
    make = random.Random(small)
    for _ in range(250):
        k = make.choice([2, 3, 5, 250])
        parts = {tuple(make.randrange(k) for _ in range(make.randint(1, 30))) for _ in range(make.randint(1, 8))}
        if make.random() < 0.5:
            one = next(iter(parts))
            parts = {one[:1] * make.randint(1, 40) + p + one for p in parts}
        text, left = [], []
        for p in parts:
            text += [x + 2 for x in p] + [1]
            left += range(len(p), -1, -1)
        text.append(0)
        left.append(0)
        array = suffix_array(np.array(text), 258)
        wanted = sorted(range(len(text)), key=lambda i: text[i:])
        assert array.tolist() == wanted
        before, shared = permuted_prefixes(np.array(text), array, np.array(left), 1)
        for a, b in zip(wanted[1:], wanted[:-1]):
            n = 0
            while n < min(left[a], left[b]) and text[a + n] == text[b + n]:
                n += 1
            assert (before[a], shared[a]) == (b, n)


def check(llm, texts, string, piece, **options):
    rows = list(enumerate(texts))
    frame = llm.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: r for r in remove_repeated_strings(frame, string, piece, **options).collect()}
    wanted = brute(texts, string)
    for doc, (n, removed, spans, kept) in enumerate(wanted):
        r = found[doc]
        assert (r["n_bytes"], r["n_removed"], len(r["spans"]) // 2, bytes(r["kept"])) == (n, removed, spans, kept)
        assert r["spans"] == sorted(r["spans"])
    return sum(w[1] for w in wanted)


@pytest.mark.parametrize("string,piece", [(12, 4), (9, 9), (20, 3), (5, 1)])
def test_small_texts(llm, string, piece):
    make = random.Random(string)
    texts = ["".join(make.choices("abé", k=make.randint(0, 60))) for _ in range(60)]
    texts += [t[make.randint(0, 9) :] + make.choice(["", "x"]) for t in texts[:20]]
    texts += [None, "", "a" * 300, "ab" * 90, "b" + "ab" * 50]
    assert check(llm, texts, string, piece) > 500


@pytest.mark.parametrize("crowd", [1, 5, 40])
def test_crowded_anchors(llm, crowd):
    """One passage in many surroundings, and near copies, cut again and again."""
    make = random.Random(crowd)
    word = lambda: "".join(make.choices("abcdefgh", k=make.randint(2, 7)))
    passage = " ".join(word() for _ in range(40))
    texts = [f"{word()} {word()} {passage[i % 3 : 150 + i % 5]} {word()} {word()}" for i in range(120)]
    text = [word() for _ in range(90)]
    for _ in range(100):
        near = list(text)
        near[make.randrange(90)] = word()
        texts.append(" ".join(near))
    assert check(llm, texts, 100, 20, crowd=crowd) > 10_000


def test_documents(llm, documents):
    rows = sorted((r["doc_id"], r["text"]) for r in documents.collect())
    found = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op11_induced_suffixes"](llm, FOLDER).collect()}
    wanted = brute([t for _, t in rows])
    assert len(found) == len(rows)
    for (doc, _), (n, removed, spans, kept) in zip(rows, wanted):
        assert found[doc] == (n, removed, spans, hashlib.sha256(kept).hexdigest())
    assert sum(w[1] for w in wanted) > 50_000


def test_hard_rows(hard, empty):
    rows = remove_repeated_strings(hard, 20, 8).collect()
    assert len(rows) == len(HARD) and remove_repeated_strings(empty).count() == 0
    by = {}
    for r in rows:
        by.setdefault((r["doc_id"], r["n_bytes"]), []).append((r["n_removed"], bytes(r["kept"])))
    texts = [t for _, t, _, _ in HARD]
    for (doc, text, _, _), (n, removed, _, kept) in zip(HARD, brute(texts, 20)):
        assert (removed, kept) in by[(doc, n)]
    # Three rows of one text, two of them with one id: all go.
    assert by[(5, 46)] == [(46, b"")] * 2 and by[(1, 46)] == [(46, b"")]
    with pytest.raises(ValueError):
        remove_repeated_strings(hard, 10, 11)
