"""The pipeline's language stage on mixed texts and on texts of no learned language."""

import random

import corpus_pipeline

from .test_models import WORD


def test_mixed_documents_stay(llm, documents):
    make = random.Random(1)
    by = {}
    for r in documents.where("length(text) between 600 and 3000").collect():
        by.setdefault(r["lang"], []).append(WORD.findall(r["text"]))
    letters = "abcdefghijklmnopqrstuvwxyz"
    noise = lambda n: ["".join(make.choices(letters, k=make.randint(3, 9))) for _ in range(n)]
    pieces = lambda *langs: [w for x in langs for w in make.choice(by[x])[:40]]
    mixed = [make.sample(["en", "fr", "de", "es"], n) for n in (2, 3, 4) for _ in range(10)]
    rows = [(10_000_000 + i, " ".join(pieces(*m)), m[0] if i % 2 else None) for i, m in enumerate(mixed)]
    rows += [(20_000_000 + i, " ".join(pieces("en") + noise(10)), None) for i in range(5)]
    clean = {r[0] for r in rows}
    rows += [(30_000_000 + i, " ".join(noise(60)), None) for i in range(5)]
    rows += [(40_000_000, "12 34 -- !!", "en"), (40_000_001, None, "en")]
    docs = documents.unionByName(llm.createDataFrame(rows, documents.schema))
    found = {r["doc_id"]: r for r in corpus_pipeline.language(llm, docs, "").collect()}
    assert clean <= set(found)
    assert not ({r[0] for r in rows} - clean) & set(found)
    # All texts of the table have a language.
    assert len(found) == documents.count() + len(clean)
    for doc, _, lang in rows:
        assert doc not in clean or found[doc]["lang"] == lang or lang is None
        assert doc not in clean or found[doc]["lang"] in by
