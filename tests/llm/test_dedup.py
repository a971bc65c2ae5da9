"""Copies, near copies and repeated passages against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash

from loomfeed.llm import queries, simhash
from loomfeed.llm.components import components
from loomfeed.llm.exact_dedup import exact_groups, without_copies
from loomfeed.llm.substring import remove_repeats, without_repeats

from .conftest import FOLDER, HARD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fingerprint(text):
    words = WORD.findall(lower(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_exact_equals_sql(llm):
    frame = queries.QUERIES["op6_exact_dedup"](llm, FOLDER).toPandas().sort_values("doc_id")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    other = connection.execute(queries.SQL["op6_exact_dedup"]).df().sort_values("doc_id")
    assert frame.reset_index(drop=True)[list(other.columns)].equals(other.reset_index(drop=True))


def test_exact_hard_rows(hard, empty):
    rows = exact_groups(hard).collect()
    assert len(rows) == len(HARD)
    assert exact_groups(empty).count() == 0
    by = defaultdict(list)
    for r in rows:
        by[r["text_sha256"]].append(r)
    blank = by[hashlib.sha256(b"").hexdigest()]
    # The blank text of three white spaces and more has the most code points.
    assert {r["keep_id"] for r in blank} == {4} and {r["group_size"] for r in blank} == {4}
    cats = by[hashlib.sha256(b"thecatsatonthematandthedogatethehat").hexdigest()]
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in cats} == {(1, 1, True), (5, 1, False)}
    kept = without_copies(hard)
    assert kept.columns == hard.columns
    assert len(kept.collect()) == len(by)
    assert without_copies(empty).count() == 0


def test_exact_is_native(hard):
    for frame in (exact_groups(hard), without_copies(hard)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("seed", [1, 2])
def test_components(llm, seed):
    make = random.Random(seed)
    links = [(make.randrange(60), make.randrange(60)) for _ in range(45)]
    links += [(100 + i, 101 + i) for i in range(40)] + [(200, 200 + i) for i in range(1, 30)]
    links += [(7, 7)]
    found = {r["id"]: r["component"] for r in components(llm.createDataFrame(links, "a long, b long")).collect()}
    expected = roots(400, links)
    assert found == {x: expected[x] for a, b in links if a != b for x in (a, b)}


def test_fingerprints_and_links(llm, documents, hard, empty):
    rows = [(r["doc_id"], r["text"]) for r in documents.limit(150).collect()]
    base = rows[0][1].split()
    # Chains of small changes, and repeated shingles.
    rows += [(10_000 + i, " ".join(base[: len(base) - i])) for i in range(1, 40)]
    frame = llm.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in simhash.simhash_groups(frame).collect()}
    prints = [fingerprint(t) for _, t in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if (prints[i] ^ prints[j]).bit_count() <= 3
    ]
    assert len(links) > 30
    group = roots(len(rows), links)
    least = {}
    for (doc, _), root in zip(rows, group):
        least[root] = min(doc, least.get(root, doc))
    for (doc, _), print_, root in zip(rows, prints, group):
        assert found[doc]["fp"] % (1 << 64) == print_
        assert found[doc]["component_id"] == least[root]
    rows = simhash.simhash_groups(hard).collect()
    assert len(rows) == len(HARD)
    assert {r["component_id"] for r in rows if r["fp"] == 0} == {2}
    assert simhash.simhash_groups(empty).count() == 0
    kept = simhash.without_near_copies(hard)
    assert kept.columns == hard.columns
    assert {r["doc_id"] for r in kept.collect()} >= {1, 2, 7, 9, None}


def test_chains_lose_no_pair():
    """Every pair within three bits shares a key whose chain holds."""
    make = np.random.default_rng(3)
    for _ in range(3000):
        a = int(make.integers(0, 1 << 63)) * 2 + int(make.integers(0, 2))
        b = a
        for bit in make.choice(64, make.integers(0, 4), replace=False):
            b ^= 1 << int(bit)
        x = np.array([a ^ b], np.uint64)
        assert any(
            a & mask == b & mask and simhash.chain_holds(x, start)[0]
            for start, mask in simhash.chains()
        )


def test_large_groups_are_split(llm, monkeypatch):
    """The same components when groups are dealt into many cells."""
    import loomfeed.llm.cells as cells

    make = random.Random(5)
    text = [f"w{make.randrange(5000)}" for _ in range(300)]
    rows = []
    for i in range(120):
        words = list(text)
        words[make.randrange(300)] = f"x{i}"
        rows.append((i, " ".join(words)))
    frame = llm.createDataFrame(rows, "doc_id long, text string")
    whole = {tuple(r) for r in simhash.simhash_groups(frame).collect()}
    monkeypatch.setattr(
        simhash, "cells", lambda df, keys, member: cells.cells(df, keys, member, block=8)
    )
    assert {tuple(r) for r in simhash.simhash_groups(frame).collect()} == whole


def brute(rows, window=20):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out[doc] = len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()
    return out


@pytest.mark.parametrize("window", [2, 4, 5, 7])
def test_repeats_small(llm, window):
    make = random.Random(window)
    rows = [
        (i, make.choice([" ", "\n", "\t "]).join(make.choices("ab", k=make.randint(0, 50))))
        for i in range(120)
    ]
    frame = llm.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r[0]: tuple(r)[1:] for r in remove_repeats(frame, window, digest=True).collect()}
    assert found == brute(rows, window)


def test_repeats_documents(llm, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    found = queries.QUERIES["op9_substring"](llm, FOLDER).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == brute(rows)
    assert sum(r["n_removed"] for r in found) > 1000


def test_repeats_hard_rows(hard, empty):
    rows = remove_repeats(hard).collect()
    assert len(rows) == len(HARD)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    # Rows with the same id and text count as one document.
    assert [r["n_removed"] for r in by[5]] == [0, 0] and by[1][0]["n_removed"] == 0
    # Eight words that go round: all windows but the first eight starts are repeats.
    assert by[10][0]["n_words"] == 96 and by[10][0]["n_removed"] == 95
    assert by[10][0]["kept_text"] == "same"
    left = without_repeats(hard)
    assert left.columns == hard.columns
    texts = {(r["doc_id"], r["text"]) for r in left.collect()}
    assert (10, "same") in texts and (2, None) in texts and (4, " \t\n ") in texts
    assert remove_repeats(empty).count() == 0 and without_repeats(empty).count() == 0


def thue_morse(n):
    """A word of 2**n letters and the one with both letters swapped."""
    one = "".join("ab"[i.bit_count() & 1] for i in range(1 << n))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_words_that_clash_under_sums_of_powers(llm):
    x, y = thue_morse(10)
    rest = " ".join(f"w{i}" for i in range(19))
    frame = llm.createDataFrame([(1, f"{x} {rest}"), (2, f"{y} {rest}")], "doc_id long, text string")
    assert {r["n_removed"] for r in remove_repeats(frame).collect()} == {0}


def test_null_ids_link(llm):
    """A fingerprint that only a null id holds lies in the component of a close one."""
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words)]
    near = (" ".join([*words[:-k], *["v"] * k]) for k in range(1, 50))
    texts.append(next(t for t in near if 0 < (fingerprint(texts[0]) ^ fingerprint(t)).bit_count() <= 3))
    frame = llm.createDataFrame([(5, texts[0]), (None, texts[1]), (None, "quite another text")], "doc_id long, text string")
    found = {(r["doc_id"], r["component_id"]) for r in simhash.simhash_groups(frame).collect()}
    assert found == {(5, 5), (None, 5), (None, None)}
