"""Phrase collocations against brute force and SQL."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from loomfeed.llm import phrases, queries
from loomfeed.llm.phrases import phrase_collocations

from .conftest import FOLDER

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least=30, top=2000, subsumes=80, scale=2_000_000, longest=4):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[(lang, *w[i : i + k])] += 1
    found = {k: a for k, a in f.items() if a >= least and len(k) > 2}
    gone = set()
    for k, a in found.items():
        w = k[1:]
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                inner = (k[0], *w[i : i + m])
                if 100 * a >= subsumes * f[inner]:
                    gone.add(inner)
    out = []
    for k, a in found.items():
        if k in gone:
            continue
        cuts = []
        for i in range(2, len(k)):
            x, y = f[k[:i]], f[(k[0], *k[i:])]
            cuts.append((scale * a // (x + y), i, x, y))
        score, _, x, y = min(cuts)
        out.append((k[0], -score, -a, " ".join(k[1:]).encode(), x, y))
    out.sort()
    ranks, result = Counter(), set()
    for lang, score, a, phrase, x, y in out:
        ranks[lang] += 1
        if ranks[lang] <= top:
            result.add((lang, ranks[lang], phrase.decode(), -a, x, y, n[lang], -score))
    return result


def test_equals_sql(llm):
    frame = queries.QUERIES["op12_stripes"](llm, FOLDER).toPandas()
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    other = connection.execute(queries.SQL["op12_stripes"]).df()
    order = lambda df: df[COLUMNS].sort_values(COLUMNS).reset_index(drop=True)
    assert order(frame).equals(order(other)) and len(frame) > 100


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(llm, seed, monkeypatch):
    make = random.Random(seed)
    if seed == 3:
        monkeypatch.setattr(phrases, "BITMAP", (6, 6))  # a full bitmap lets everything pass
    marks = [" ", " ", "  ", "\t", " ", ". ", "\n", ",", "; ", "\x0b", "!? "]
    vocabulary = ["The", "the", "a", "cat", "Éa", "éa", "x-y", "日本", "\x00", "ß"]
    rows = []
    for _ in range(60):
        words = [make.choice(vocabulary) + make.choice(marks) for _ in range(make.randint(0, 60))]
        words += ["new ", "york ", "city "] * make.randint(0, 4)
        rows.append((make.choice(["en", "de", None]), "".join(words)))
    frame = llm.createDataFrame(rows, "lang string, text string").repartition(4)
    for options in ({"least": 5}, {"least": 3, "top": 25, "subsumes": 60, "longest": 3}, {"least": 2, "longest": 2}):
        found = [tuple(r) for r in phrase_collocations(frame, **options).select(COLUMNS).collect()]
        assert len(found) == len(set(found)) and set(found) == brute(rows, **options)


def test_hard_rows(llm, hard, empty):
    rows = [(r["lang"], r["text"]) for r in hard.select("lang", "text").collect()]
    found = {tuple(r) for r in phrase_collocations(hard, least=2).select(COLUMNS).collect()}
    assert found == brute(rows, least=2) and ("de" not in {r[0] for r in found})
    assert phrase_collocations(empty).count() == 0


def test_products_beyond_64_bits(llm):
    """Counts as they would be on a corpus of 10**14 words."""
    big = 10**14
    rows = [("en", 1, "a", 3 * big), ("en", 1, "b", 2 * big), ("en", 2, "a b", 2 * big - 1)]
    stripes = llm.createDataFrame(rows, "lang string, size int, phrase string, f long")
    n = llm.createDataFrame([("en", 9 * big)], "lang string, n long")
    row = phrases._best(stripes, n, 10, 80, 2_000_000).head()
    assert row["score"] == 2_000_000 * (2 * big - 1) // (5 * big)


def test_bitmap_loses_nothing(llm):
    rows = [("en", f"w{i} v{i % 7}") for i in range(3000)]
    bits = phrases.bitmap(llm.createDataFrame(rows, "lang string, phrase string"), 2)
    import pyarrow as pa

    flat = pa.array([w for _, p in rows for w in p.split(" ")])
    spoken = phrases.word_hashes(pa.array(["en"]), phrases.BASES[0])
    hashes = phrases._hashes(np.repeat(spoken, len(flat)), phrases.word_hashes(flat, phrases.BASES[0]), 2)
    assert phrases._passes(bits, hashes[::2]).all()
    assert phrases._passes(bits, phrases.mixed(hashes)).mean() < 0.2
