"""The pipeline's stages, each against what its operator finds."""

import corpus_pipeline
import __spark_entry__ as entry
from loomfeed.llm.exact_dedup import exact_groups
from loomfeed.llm.simhash import simhash_groups
from loomfeed.llm.substring import remove_repeats

from .conftest import FOLDER


def test_stages(llm):
    docs = llm.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    results = {}
    for name, step in corpus_pipeline.STAGES:
        results[name] = docs = step(llm, docs, FOLDER).cache()
        if name != "pack":
            assert docs.columns == columns
    count = {k: v.count() for k, v in results.items()}
    # All texts have a language here.
    assert count["language"] == 1000
    kept = {r["doc_id"] for r in exact_groups(results["language"]).where("kept").collect()}
    assert {r["doc_id"] for r in results["exact"].collect()} == kept
    groups = simhash_groups(results["exact"]).collect()
    assert {r["doc_id"] for r in results["near"].collect()} == {r["component_id"] for r in groups}
    left = {r["doc_id"]: r for r in remove_repeats(results["near"]).collect()}
    before = {r["doc_id"]: r for r in results["near"].collect()}
    after = {r["doc_id"]: r for r in results["passages"].collect()}
    assert set(after) == {d for d, r in left.items() if r["n_removed"] < r["n_words"] or not r["n_words"]}
    for doc, row in after.items():
        same = left[doc]["n_removed"] == 0
        assert row["text"] == (before[doc]["text"] if same else left[doc]["kept_text"])
        assert row["n_chars"] == len(row["text"])
        assert [row[c] for c in ("lang", "source")] == [before[doc][c] for c in ("lang", "source")]
    assert {r["doc_id"] for r in results["pack"].collect()} == set(after)
    whole = sorted((r["doc_id"], r["start"], r["length"]) for r in results["pack"].collect())
    run = corpus_pipeline.run(llm, FOLDER).groupBy("doc_id").sum("length").collect()
    assert sum(r[1] for r in run) == sum(w[2] for w in whole)


def test_stages_take_hard_rows(hard, empty, llm):
    for docs in (hard, empty):
        columns = docs.columns
        for name, step in corpus_pipeline.STAGES:
            docs = step(llm, docs, FOLDER)
            assert name == "pack" or docs.columns == columns
        docs.collect()


def test_registered():
    names = entry.queries()
    assert names["pipeline"] is corpus_pipeline.run
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact", "near", "passages", "pack"]
