"""Signs do not depend on how often a toxic text was copied, nor on how many documents there are."""

import random

import pytest

from loomfeed.llm.toxicity import learn_toxicity


def texts(n):
    make = random.Random(1)
    plain = [f"{a}o{b}em" for a in "bcdfg" for b in "hjklm"]
    out = []
    for i in range(n):
        words = make.choices(plain, k=30)
        if i % 5 == 0:
            words.insert(make.randrange(1, 29), "villain")
        out.append((i, " ".join(words), int(i % 5 == 0)))
    return out


@pytest.mark.parametrize("edited", [False, True])
def test_copies_take_no_sign_away(llm, edited):
    rows = texts(300)
    first = rows[0][1]
    # Copies of one toxic text, also with another word at the end, three times as many as the others.
    rows += [(1000 + i, first + (f" x{i}" if edited else ""), 1) for i in range(180)]
    docs = llm.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = llm.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    assert "villain" in learn_toxicity(docs, labels).signs["w"]


def test_signs_do_not_go_with_size(llm):
    """25 other words make 625 pairs of neighbours, far fewer than half of the documents."""
    rows = texts(8000)
    docs = llm.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = llm.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    assert "villain" in learn_toxicity(docs, labels).signs["w"]
