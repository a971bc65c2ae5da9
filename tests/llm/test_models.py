"""Language, toxicity, language-model scores and vectors: brute force and held-out accuracy."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from loomfeed.llm import language, queries, spherical
from loomfeed.llm.language import identify, label_words, learn_languages, with_known_language
from loomfeed.llm import mixing
from loomfeed.llm.mixing import Code, SYMBOLS, huffman, learn_mixing, score_mixing
from loomfeed.llm.spherical import vector_groups
from loomfeed.llm.substring import packed, unpacked
from loomfeed.llm.toxicity import GAP, Decoder, learn_toxicity, restored, score_toxicity

from .conftest import FOLDER, HARD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def remainder(doc, n):
    return zlib.crc32(str(doc).encode()) % n


@pytest.fixture(scope="module")
def languages(documents):
    return learn_languages(documents.select("text", "lang"))


def test_language_held_out(llm, documents):
    found = queries.QUERIES["op1_language_id"](llm, FOLDER).collect()
    known = {r["doc_id"]: r["lang"] for r in documents.collect()}
    assert len(found) == len(known)
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (remainder(r["doc_id"], 4) == 2) for r in found)
    assert sum(r["lang_pred"] == known[r["doc_id"]] for r in held) > 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_viterbi_equals_brute_force():
    make = np.random.default_rng(2)
    for _ in range(20):
        emission = make.normal(0, 3, (6, 3))
        counts = make.integers(0, 7, 5)
        code = make.integers(0, 6, counts.sum())
        found = label_words(emission, code, counts, 2.0)
        at = 0
        for n in counts:
            own, path = code[at : at + n], found[at : at + n]

            def value(p):
                change = sum(a != b for a, b in zip(p, p[1:]))
                return sum(emission[c, s] for c, s in zip(own, p)) - 2.0 * change

            best = max((value(p) for p in np.ndindex(*[3] * n)), default=0)
            assert value(path) == pytest.approx(best)
            at += n


def test_mixed_text_has_spans(llm, documents, languages):
    by = {}
    for r in documents.where("length(text) between 300 and 900").collect():
        by.setdefault(r["lang"], " ".join(WORD.findall(r["text"])[:40]))
    text = f"{by['en']} {by['fr']} {by['en']}"
    row = identify(llm.createDataFrame([(1, text)], "doc_id long, text string"), languages).first()
    assert row["span_langs"] == ["en", "fr", "en"]
    assert all(abs(n - 40) <= 3 for n in row["span_words"])
    assert row["lang_pred"] == "en"


def test_scripts_narrow_candidates(llm):
    rows = [("один два три четыре", "ru"), ("one two three four", "en"), ("eins zwei drei", "de")] * 5
    model = learn_languages(llm.createDataFrame(rows, "text string, lang string"))
    docs = llm.createDataFrame([(1, "шесть"), (2, "three"), (3, "漢字")], "doc_id long, text string")
    found = {r["doc_id"]: r["lang_pred"] for r in identify(docs, model).collect()}
    assert found[1] == "ru" and found[2] == "en" and found[3] in model.langs


def test_language_hard_rows(llm, hard, empty, languages):
    rows = identify(hard, languages).collect()
    assert len(rows) == len(HARD)
    by = {r["doc_id"]: r for r in rows}
    for doc in (2, 3, 4, 7):
        assert (by[doc]["lang_pred"], by[doc]["score"]) == ("und", 0.0)
    for r in rows:
        assert (r["lang_pred"] == "und") == (r["score"] == 0)
    kept = with_known_language(hard, languages, 0.0)
    assert kept.columns == hard.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 5, 6, 8, 9, 10, None}
    assert identify(empty, languages).count() == 0
    nothing = learn_languages(empty.select("text", "lang"))
    assert {r["lang_pred"] for r in identify(hard, nothing).collect()} == {"und"}


def test_toxicity_held_out(llm):
    found = {r["doc_id"]: r for r in queries.QUERIES["op4_toxicity"](llm, FOLDER).collect()}
    labels = llm.read.parquet(f"{FOLDER}/labels.parquet").collect()
    held = [r for r in labels if remainder(r["doc_id"], 3) == 1]
    assert all(found[r["doc_id"]]["held_out"] for r in held)
    right = sum(found[r["doc_id"]]["predicted"] == r["toxic"] for r in held)
    assert right > 0.95 * len(held)
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in found.values())


@pytest.fixture(scope="module")
def toxic(llm, documents):
    labels = llm.read.parquet(f"{FOLDER}/labels.parquet")
    return learn_toxicity(documents, labels)


@pytest.mark.parametrize(
    "word, plain",
    [
        ("1d10t", "idiot"),
        ("i.d.i.o.t", "idiot"),
        ("idiooooot", "idiot"),
        ("tr@sh", "trash"),
        ("m0r0n", "moron"),
        ("l0$er", "loser"),
        ("st*pid", "stupid"),
        ("idiot", "idiot"),
        ("st-upid", "stupid"),
        ("stu.pid", "stupid"),
        ("i/d/i/o/t", "idiot"),
        ("i:d:i:o:t", "idiot"),
        ("stuupid", "stupid"),
        ("iidiioott", "idiot"),
        ("+rash", "trash"),
        ("!d10t", "idiot"),
        ("idiot!", "idiot"),
        ("idiot!!!", "idiot"),
        ("(idiot", "idiot"),
        (GAP.join("idiotloser"), "idiot loser"),
        (GAP.join("1d10t"), "idiot"),
    ],
)
def test_restored_words(toxic, word, plain):
    assert toxic.decoder().restore(word) == plain


def test_lattice_equals_brute_force(toxic):
    """The decoder's path is the cheapest of all readings."""
    decoder = Decoder(toxic.letters)

    def cheapest(word):
        runs = [(m[1], len(m[0]), m.start() == 0, m.end() == len(word)) for m in re.finditer(r"(.)\1*", word)]
        paths = [(0.0, "")]
        for run in runs:
            paths = [(c + d, t + x) for c, t in paths for x, d in decoder.readings(*run)]
        best = []
        for cost, text in paths:
            if text.startswith(" ") or "  " in text:
                continue
            for part in text.split(" "):
                marked = "\1\0" + part + "\0"
                cost -= sum(decoder.log(*marked[i : i + 3]) for i in range(len(part) + 1))
            best.append((cost, text.strip()))
        return min(best)[1]

    for word in ("1d10t", "b00k", "a--b", "xxx1yy", "$0$0", "we11***", "!we-11", "i:d10!!", GAP.join("thatman")):
        assert decoder.restore(word) == cheapest(word)


def test_disguised_texts_score_like_plain(llm, toxic):
    texts = [
        "you idiot and loser , what trash",
        "you 1d10t and l0$er , what tr@sh",
        "you i d i o t and looooser , what t r a s h",
        "the thing and that of the 3rd a b test in 2024",
        None,
        "",
    ]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in score_toxicity(docs, toxic).collect()}
    assert rows[0]["score"] > 0.9
    for i in (1, 2):
        assert set(rows[i]["signs"]) == set(rows[0]["signs"]) == {"idiot", "loser", "trash"}
        assert rows[i]["score"] == pytest.approx(rows[0]["score"])
    assert rows[3]["score"] == rows[4]["score"] == rows[5]["score"] < 0.3


@pytest.mark.parametrize(
    "word",
    ["st-upid", "stu.pid", "i/d/i/o/t", "i:d:i:o:t", "stuupid", "iidiioott", "+rash", "!d10t", "TR@$H!"],
)
def test_disguised_words_reach_the_lattice(llm, toxic, word):
    docs = llm.createDataFrame([(0, f"so {word} that"), (1, "so plain that")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in score_toxicity(docs, toxic).collect()}
    assert set(rows[0]["signs"]) & {"stupid", "idiot", "trash"}
    assert rows[0]["score"] > rows[1]["score"]


def test_spaced_sentence_has_word_ends(llm, toxic):
    docs = llm.createDataFrame([(0, "i d i o t l o s e r"), (1, "idiot loser")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in score_toxicity(docs, toxic).collect()}
    assert set(rows[0]["signs"]) == {"idiot", "loser"}
    assert rows[0]["score"] == pytest.approx(rows[1]["score"])


def test_words_of_each_text(toxic):
    """Words that become several, or none, stay with their text; numbers and marks are left."""
    texts = ["", "i d i o t l o s e r", "! ( 2024 1 2 3 4", "", "the thing", "x" * 3000 + "!-" * 3000]
    names, code, counts = restored(pa.array(texts), toxic.decoder())
    own = [[w for w in names.take(pa.array(part)).to_pylist() if w] for part in np.split(code, np.cumsum(counts)[:-1])]
    assert own[:5] == [[], ["idiot", "loser"], ["2024", "1234"], [], ["the", "thing"]]
    assert own[5]


def test_unpacked_values_can_be_changed():
    for n in (0, 1, 2, 300):
        first, second = np.arange(n, dtype=np.float64), np.arange(n, dtype=np.uint32)
        out = unpacked(packed(first, second), np.float64, np.uint32)
        assert all(np.array_equal(a, b) for a, b in zip(out, (first, second)))
        for values in out:
            values += 1


def test_mixing_scores_a_text_alone_in_its_unit(llm):
    """A document that is scored by itself has the scores it has among others."""
    texts = ["the thing and that", "one other thing", "unheard words here", ""]
    rows = list(enumerate(texts))
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    model, vocabulary = learn_mixing(docs.where("doc_id < 2"))
    among = {r["doc_id"]: r for r in score_mixing(docs.coalesce(1), model, vocabulary).collect()}
    for row in rows:
        alone = llm.createDataFrame([row], "doc_id long, text string").coalesce(1)
        found = score_mixing(alone, model, vocabulary).first()
        assert (found["n_tokens"], found["n_known"]) == (among[row[0]]["n_tokens"], among[row[0]]["n_known"])
        assert found["base_score"] == pytest.approx(among[row[0]]["base_score"])
        assert found["score"] == pytest.approx(among[row[0]]["score"], rel=1e-5)


def test_copied_passages_are_no_signs(llm):
    """Words that only copies of one toxic text share do not make other texts toxic."""
    make = random.Random(1)
    plain = [f"{a}o{b}em" for a in "bcdfghjklmnprst" for b in "bcdfghjklmnprst"]
    passage = " ".join(f"qu{a}rare" for a in "bcdfghjklmnp")
    rows, labels = [], []
    for i in range(300):
        words = make.choices(plain, k=30)
        if i % 5 == 0:
            words.insert(make.randrange(30), "villain")
        rows.append((i, " ".join(words) + (" " + passage if i % 15 == 0 else "")))
        labels.append((i, int(i % 5 == 0)))
    rows.append((1000, "bobem codem " + passage))
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    model = learn_toxicity(docs.where("doc_id < 1000"), llm.createDataFrame(labels, "doc_id long, toxic int"))
    assert "villain" in model.signs["w"] and not any("qu" in s for s in model.signs["w"])
    found = {r["doc_id"]: r["score"] for r in score_toxicity(docs, model).collect()}
    assert found[1000] < 0.5 < found[0]


def test_toxicity_hard_rows(llm, hard, empty, toxic):
    assert len(score_toxicity(hard, toxic).collect()) == len(HARD)
    assert score_toxicity(empty, toxic).count() == 0
    labels = llm.createDataFrame([(1, None), (None, 1), (2, 0)], "doc_id long, toxic int")
    model = learn_toxicity(hard.select("doc_id", "text"), labels)
    scores = {r["score"] for r in score_toxicity(hard, model).collect()}
    assert len(scores) == 1 and 0 < scores.pop() < 0.5


def test_huffman_is_a_prefix_code():
    counts = np.random.default_rng(1).integers(1, 1000, SYMBOLS)
    codes = huffman(counts)
    assert sum(2.0 ** -len(c) for c in codes) == 1
    assert len({tuple(c) for c in codes}) == SYMBOLS
    assert Code(counts).size.tolist() == [len(c) for c in codes]


def test_base_scores(llm, documents):
    rows = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    low = {d: WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t)) for d, t in rows.items()}
    count, docs = Counter(), 0
    for doc, words in low.items():
        if remainder(doc, 5) != 1:
            count.update(words)
            docs += 1
    total, types = sum(count.values()) + docs, len(count) + 1
    floor = math.log10(total + 0.5 * (types + 1))
    found = queries.QUERIES["op3_context_mixing"](llm, FOLDER).collect()
    assert len(found) == len(rows)
    ours = base = 0.0
    for r in found:
        words = low[r["doc_id"]]
        expected = sum(math.log10(count[w] + 0.5) for w in words) + math.log10(docs + 0.5)
        expected -= (len(words) + 1) * floor
        assert r["base_score"] == pytest.approx(expected, rel=1e-9)
        assert r["n_tokens"] == len(words) + 1 and r["train_tokens"] == total
        assert r["n_known"] == sum(count[w] > 0 for w in words) + 1
        assert r["held_out"] == (remainder(r["doc_id"], 5) == 1)
        if r["held_out"]:
            ours, base = ours + r["score"], base + r["base_score"]
    # On texts it was not learned from, the model is better than the unigram one.
    assert ours > base


def test_mixing_is_a_probability(llm):
    """The chances of all words that go on after a beginning, and its end, sum to at most one."""
    docs = llm.createDataFrame([(1, "ab ab aa b"), (2, "ab ba")], "doc_id long, text string")
    model, _ = learn_mixing(docs)
    texts = ["".join(chr(97 + int(c)) for c in np.base_repr(i, 3)) for i in range(1, 243)] + [""]
    flat = pa.array([t for t in texts if t])
    code = np.arange(len(flat))
    counts = np.array([1] * len(flat) + [0])
    logs = model.scores(code, flat, counts, np.full(len(flat), -1))
    assert (10**logs).sum() < 1
    order = sorted(zip(logs, texts), reverse=True)
    assert {t for _, t in order[:4]} & {"ab", "b"}


def test_mixing_hard_rows(llm, hard, empty):
    model, words = learn_mixing(hard, kind="lang")
    rows = score_mixing(hard, model, words).collect()
    assert len(rows) == len(HARD)
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["n_tokens"] == by[3]["n_tokens"] == by[4]["n_tokens"] == 1
    assert by[2]["score"] == by[3]["score"] and by[9]["n_tokens"] == 30001
    assert all(r["score"] < 0 and r["base_score"] < 0 for r in rows)
    # The score does not depend on how rows are dealt to tasks.
    again = score_mixing(hard.repartition(7), model, words).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    # Without common words every word is looked up.
    rare, words = learn_mixing(hard, kind="lang", common=1)
    base = sorted(r["base_score"] for r in score_mixing(hard, rare, words).collect())
    assert base == pytest.approx(sorted(r["base_score"] for r in rows))
    assert score_mixing(empty, model, words).count() == 0
    model, words = learn_mixing(empty, kind="lang")
    rows = score_mixing(hard, model, words).collect()
    assert len(rows) == len(HARD) and {r["n_known"] for r in rows} == {0}


def brute_vectors(rows, cosine):
    good = [
        (i, np.array(v, float) / np.linalg.norm(v))
        for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links = {i: 0 for i, _ in good}
    label = {i: i for i, _ in good}
    pairs = []
    for a, (i, v) in enumerate(good):
        for j, w in good[:a]:
            if len(v) == len(w) and v @ w >= cosine:
                links[i] += 1
                links[j] += 1
                pairs.append((i, j))
    for _ in range(len(good)):
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    return links, label


def vectors(seed, groups=12, size=14, dims=32):
    make = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        centre = make.normal(size=dims)
        for _ in range(size):
            rows.append((len(rows), (centre + make.normal(size=dims) * 0.17).astype(np.float32).tolist()))
    rows += [(len(rows) + i, make.normal(size=dims).astype(np.float32).tolist()) for i in range(100)]
    rows += [(len(rows) + i, rows[i][1]) for i in range(5)]  # equal vectors
    rows.append((len(rows), [2 * x for x in rows[0][1]]))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_vectors_equal_brute_force(llm, seed):
    rows = vectors(seed)
    links, label = brute_vectors(rows, 0.95)
    frame = llm.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {r["vec_id"]: r for r in vector_groups(frame).collect()}
    assert sum(links.values()) > 500
    assert sum(r["n_links"] for r in found.values()) >= 0.98 * sum(links.values())
    assert all(r["n_links"] <= links[i] for i, r in found.items())
    assert sum(found[i]["component_id"] == label[i] for i in label) >= 0.98 * len(label)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())


def test_vectors_in_small_cells(llm, monkeypatch):
    """Links counted once however a cap is cut into cells."""
    import loomfeed.llm.cells as cells

    frame = llm.createDataFrame(vectors(3, groups=3, size=60), "vec_id long, embedding array<float>")
    whole = {tuple(r) for r in vector_groups(frame).collect()}
    monkeypatch.setattr(spherical, "cells", lambda df, keys, member: cells.cells(df, keys, member, 8))
    assert {tuple(r) for r in vector_groups(frame).collect()} == whole


def test_vectors_hard_rows(llm):
    rows = [
        (1, [1.0, 0.0, 0.0]),
        (2, [1.0, 0.01, 0.0]),
        (2, [1.0, 0.01, 0.0]),
        (3, [0.0, 0.0, 0.0]),
        (4, None),
        (5, [1.0, None, 0.0]),
        (6, [float("nan"), 0.0, 1.0]),
        (7, [float("inf"), 0.0, 1.0]),
        (8, []),
        (9, [1.0]),
        (10, [3.0]),
        (11, [1.0, 0.0]),
        (None, [1.0, 0.0, 0.0]),
        (12, [3e38, 0.0, 0.0]),
        (13, [1e-40, 0.0, 0.0]),
    ]
    frame = llm.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, caps int, node string")
    found = vector_groups(frame).collect()
    assert len(found) == len(rows)
    by = {r["vec_id"]: r for r in found}
    group = {1, 2, 12, 13}
    assert {by[i]["component_id"] for i in group} == {1}
    # Two rows with the id 2 are one vector.
    assert by[1]["n_links"] == 3 and by[9]["n_links"] == by[10]["n_links"] == 1
    for i in (3, 4, 5, 6, 7, 8, 11, None):
        assert by[i]["n_links"] == 0 and by[i]["component_id"] == i
    assert vector_groups(frame.where("1 = 0")).count() == 0


def test_language_counts_ignore_dealing(llm, documents, languages):
    again = learn_languages(documents.repartition(11).select("text", "lang"))
    assert again.langs == languages.langs
    for a, b in zip(again.grams, languages.grams):
        assert (a == b).all()
    assert language.script_of(np.array([0x61, 0x416, 0x3B1, 0x4E2D, 0x20])).tolist() == [1, 3, 2, 14, 0]


def test_rows_of_one_id_count_as_one_vector(llm):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [2.0, -1.0])]
    found = vector_groups(llm.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(tuple(r) for r in found) == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_mixing_learns_through_a_whole_text(llm):
    """Factors and map of a text of many thousand bits, one bit after another."""
    docs = llm.createDataFrame([(0, "the cat sat on the mat"), (1, "a dog and a cat")], "doc_id long, text string")
    model, _ = learn_mixing(docs)
    values, code = pa.array(["zebra", "cat"]), np.array([0, 1] * 400)
    found = model.scores(code, values, np.array([len(code)]), np.array([-1, -1]))
    rows, sizes = model.rows(values, np.full(2, mixing.CLASSES))
    ends = np.cumsum(sizes)
    factors = np.ones(mixing.ORDERS)
    centre = (np.arange(mixing.BUCKETS) + 0.5) / mixing.BUCKETS * 2 * mixing.REACH - mixing.REACH
    table = np.tile(1 / (1 + np.exp(-centre)), mixing.GATES)
    total, n = 0.0, 0
    for word in [*code, 2]:
        for row in rows[ends[word] - sizes[word] : ends[word]].astype(float):
            x, one, n = row[: mixing.ORDERS], int(row[mixing.ORDERS]) & 1, n + 1
            z = x @ factors
            p = 1 / (1 + np.exp(-np.clip(z, -12, 12)))
            at = int(np.clip(z * mixing.BUCKETS / 2 / mixing.REACH + mixing.BUCKETS / 2, 0, mixing.BUCKETS - 1))
            at += int(row[mixing.ORDERS]) >> 1
            total += np.log10(abs(1 - one - (p + table[at]) / 2))
            factors += x * mixing.RATE * (one - p)
            table[at] += mixing.MAP_RATE * (one - table[at])
    assert n > 4 * 2048
    assert found[0] == pytest.approx(total, rel=2e-3)


class CountedRows(np.ndarray):
    """Rows that count how often some are taken."""

    taken = 0

    def take(self, *args, **kwargs):
        CountedRows.taken += 1
        return np.asarray(self).take(*args, **kwargs)


def test_mixing_scores_long_texts_in_blocks():
    """A long text beside short ones takes a step for a block, not for a bit, and all have the scores
    they have alone."""
    make = np.random.default_rng(3)
    rows = np.zeros((5000, mixing.ROW), np.float32)
    rows[:, : mixing.ORDERS] = make.normal(0, 0.5, (5000, mixing.ORDERS))
    gate = make.integers(0, mixing.GATES, 5000)
    rows[:, mixing.ORDERS] = gate * mixing.BUCKETS * 2 + make.integers(0, 2, 5000)
    size = np.array([3, 40000, 1, 32, 700, 33])
    begin = np.cumsum(size) - size
    index = make.integers(0, 5000, size.sum()).astype(np.int32)
    CountedRows.taken = 0
    found = mixing.mixed_logs(rows.view(CountedRows), index, begin, size)
    assert CountedRows.taken <= 40000 / 16
    for text, (first, n) in enumerate(zip(begin, size)):
        alone = mixing.mixed_logs(rows, index[first : first + n], np.array([0]), np.array([n]))
        assert alone[0] == found[text] < 0


def test_mixing_takes_hundreds_of_texts_in_a_step():
    """A step takes one block of all texts side by side, and their number does not change a score."""
    make = np.random.default_rng(4)
    rows = np.zeros((3000, mixing.ROW), np.float32)
    rows[:, : mixing.ORDERS] = make.normal(0, 0.5, (3000, mixing.ORDERS))
    rows[:, mixing.ORDERS] = make.integers(0, mixing.GATES, 3000) * mixing.BUCKETS * 2 + make.integers(0, 2, 3000)
    size = make.integers(300, 400, 500)
    begin = np.cumsum(size) - size
    index = make.integers(0, 3000, size.sum()).astype(np.int32)
    CountedRows.taken = 0
    found = mixing.mixed_logs(rows.view(CountedRows), index, begin, size)
    assert CountedRows.taken <= -(-400 // mixing.BLOCK)
    for n in (1, 9, 100):
        some = make.permutation(500)[:n]
        assert np.array_equal(mixing.mixed_logs(rows, index, begin[some], size[some]), found[some])


def test_mixing_scores_of_long_and_other_texts_agree(monkeypatch):
    """Texts over ``LONG`` bits are scored in another way, with the same scores."""
    make = np.random.default_rng(5)
    rows = np.zeros((3000, mixing.ROW), np.float32)
    rows[:, : mixing.ORDERS] = make.normal(0, 0.5, (3000, mixing.ORDERS))
    rows[:, mixing.ORDERS] = make.integers(0, mixing.GATES, 3000) * mixing.BUCKETS * 2 + make.integers(0, 2, 3000)
    size = np.array([20, 9000, 4001, 4000, 1])
    begin = np.cumsum(size) - size
    index = make.integers(0, 3000, size.sum()).astype(np.int32)
    found = mixing.mixed_logs(rows, index, begin, size)
    monkeypatch.setattr(mixing, "LONG", 4000)
    mixed = mixing.mixed_logs(rows, index, begin, size)
    assert np.array_equal(mixed[[0, 3, 4]], found[[0, 3, 4]])
    assert mixed == pytest.approx(found, rel=1e-5)
    for text in (1, 2):
        alone = mixing.mixed_logs(rows, index, begin[[text]], size[[text]])
        assert alone[0] == mixed[text]
