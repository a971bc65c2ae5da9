"""Token ids, their files and packing against the tokenizers library; SentencePiece by Viterbi."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from loomfeed.llm import encoders, sentencepiece as pieces, token_planes
from loomfeed.llm.packing import Packer, pack_documents
from loomfeed.llm.text import starts

from .conftest import HARD

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")


def library(path, texts, end):
    tokenizer = Tokenizer.from_file(path)
    return [e.ids + [end] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def odd_texts(n):
    make = random.Random(n)
    some = list("aAbB .,\n\t\r\x0b\x0c\x1c\x85\xa0 '12éÉß日本́ \x00ªµÿſ")
    some += ["'s", "'LL", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "  ", "İ", "Σ", "ŉ", "words ", "Words", "and.\nThe", "▁"]
    return ["".join(make.choices(some, k=make.randint(0, 25))) for _ in range(n)]


@pytest.mark.parametrize("make, path", [(encoders.ByteLevel, BYTE), (encoders.WordLevel, WORD)])
def test_encoders_equal_library(make, path, documents, monkeypatch):
    monkeypatch.setattr(encoders, "REMEMBERED", 500)
    monkeypatch.setattr(encoders, "PARTS", 100)
    encoder = make(path)
    texts = odd_texts(3000) + [r["text"] for r in documents.limit(60).collect()]
    expected = library(path, texts, 0)
    for begin in range(0, len(texts), 300):
        part = texts[begin : begin + 300]
        ids, sizes = encoders.ended(*encoder.encode(pa.array(part)), 0)
        at = starts(sizes)
        for i in range(len(part)):
            assert ids[at[i] : at[i + 1]].tolist() == expected[begin + i], part[i]


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    ids = np.random.default_rng(1).integers(0, 1 << 32, 1003, dtype=np.uint32)
    planes = token_planes.to_planes(ids, bits)
    assert len(planes) == (32 if bits else 4)
    assert (token_planes.from_planes(planes, len(ids)) == ids).all()


def test_joined_checksums():
    data = bytes(range(256)) * 9
    cuts = [0, 4, 400, 404, 2304]
    parts = [(j - i, zlib.crc32(data[i:j])) for i, j in zip(cuts, cuts[1:])]
    assert token_planes.joined_crc(parts) == zlib.crc32(data)


@pytest.mark.parametrize("bits, block", [(False, 1 << 16), (True, 64)])
def test_token_files(llm, documents, folder, bits, block):
    docs = documents.where("doc_id < 200")
    path = token_planes.write_tokens(docs, BYTE, block=block, bits=bits, folder=f"{folder}/t")
    found = sorted(token_planes.read_documents(llm, path).collect())
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    ids = library(BYTE, [t for _, t in rows], 2)
    at = starts(np.array([len(i) for i in ids])).tolist()
    assert [tuple(r) for r in found] == [
        (doc, at[i], len(ids[i]), crc(ids[i])) for i, (doc, _) in enumerate(rows)
    ]
    index = llm.read.parquet(f"{path}/index").collect()
    assert all(r["n_ids"] <= block for r in index) and sum(r["n_ids"] for r in index) == at[-1]
    whole = defaultdict(bytes)
    for r in sorted(token_planes.read_pieces(llm, path, ids=True).collect(), key=lambda r: r["before"]):
        whole[r["doc_id"]] += bytes(r["ids"])
    assert {d: zlib.crc32(b) for d, b in whole.items()} == {r[0]: r[3] for r in found}


def test_token_files_hard_rows(llm, hard, empty, folder):
    path = token_planes.write_tokens(hard, BYTE, block=1000, folder=f"{folder}/h")
    rows = token_planes.read_documents(llm, path).collect()
    texts = [(d, t or "") for d, t, _, _ in HARD]
    expected = sorted(crc(i) for i in library(BYTE, [t for _, t in texts], 2))
    assert sorted(r["ids_crc32"] for r in rows) == expected
    rows.sort(key=lambda r: r["start"])
    assert [r["start"] for r in rows] == starts(np.array([r["n_tokens"] for r in rows]))[:-1].tolist()
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    path = token_planes.write_tokens(empty, BYTE, folder=f"{folder}/e")
    assert token_planes.read_documents(llm, path).count() == 0


def packed(rows, texts):
    """Checks the pieces of all documents and returns the sequences' lengths."""
    ids = {k: i for k, i in zip(texts, library(WORD, list(texts.values()), 1))}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for doc, own in by_doc.items():
        own.sort(key=lambda r: r["start"])
        data = b"".join(bytes(r["ids"]) for r in own)
        assert zlib.crc32(data) == crc(ids[doc])
        assert [r["start"] for r in own] == starts(np.array([r["length"] for r in own]))[:-1].tolist()
        assert {r["doc_tokens"] for r in own} == {len(ids[doc])}
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == starts(np.array([r["length"] for r in own]))[:-1].tolist()
        assert sum(r["length"] for r in own) == own[0]["window"]
    return [own[0]["window"] for own in by_sequence.values()]


def test_packing(documents):
    docs = documents.repartition(3)
    rows = pack_documents(docs, WORD).collect()
    sizes = packed(rows, {r["doc_id"]: r["text"] for r in docs.collect()})
    assert all(n <= 2048 and n & (n - 1) == 0 for n in sizes)
    # Short rests stay rare: at most one of each size below the tiers for each task.
    assert sum(n < 256 for n in sizes) <= 3 * 8
    groups = defaultdict(int)
    for r in rows:
        groups[r["step_group"]] += r["length"]
    assert max(groups.values()) <= 64 * 2048
    whole = defaultdict(int)
    for r in rows:
        whole[r["doc_id"]] += 1
    short = [d for d in whole if next(r["doc_tokens"] for r in rows if r["doc_id"] == d) <= 2048]
    assert sum(whole[d] == 1 for d in short) > 0.7 * len(short)


def test_step_groups_are_full(documents):
    """Over many small tasks too, all groups of one length of window but one are full."""
    groups = defaultdict(lambda: defaultdict(set))
    for r in pack_documents(documents.repartition(16), WORD, step_tokens=8 * 2048).collect():
        groups[r["window"]][r["step_group"]].add(r["sequence_id"])
    for size, own in groups.items():
        assert all(g % 64 == size.bit_length() for g in own)
        full = 8 * 2048 // size
        assert sorted(map(len, own.values()))[1:] == [full] * (len(own) - 1)
        assert max(map(len, own.values())) <= full
    assert len(groups[2048]) > 5


def test_packing_hard_rows(hard, empty):
    rows = pack_documents(hard, WORD).collect()
    texts = {i: t or "" for i, (_, t, _, _) in enumerate(HARD)}
    total = sum(map(len, library(WORD, list(texts.values()), 1)))
    assert sum(r["length"] for r in rows) == total
    assert pack_documents(empty, WORD).count() == 0


def test_packer_sizes():
    make = random.Random(4)
    for n in (1, 2, 5, 40, 300):
        packer = Packer()
        sizes = [make.choice([1, 3, 255, 256, 257, 700, 1024, 1500, 2047, 2048, 2049, 9000]) for _ in range(n)]
        for i, size in enumerate(sizes):
            packer.add(i, np.arange(size))
            if i % 7 == 0:
                packer.fill()
        packer.finish()
        batch = packer.drain().to_pylist()
        assert sum(r["length"] for r in batch) == sum(sizes)
        cover = defaultdict(list)
        for r in batch:
            cover[r["doc_id"]].append((r["start"], r["length"], r["ids"]))
        for i, size in enumerate(sizes):
            data = b"".join(x[2] for x in sorted(cover[i]))
            assert data == np.arange(size).astype("<u4").tobytes()


def brute(text, v):
    """Viterbi over the whole text."""
    if not text:
        return []
    text = pieces.SPACE + text.replace(" ", pieces.SPACE)
    best = [(0.0, [])] + [None] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(max(0, j - v.longest), j):
            part = text[i:j]
            if best[i] is None:
                continue
            if part in v.pieces:
                score, ids = v.pieces[part][0], [v.pieces[part][1]]
            elif j - i == 1:
                score, ids = v.byte_score * len(part.encode()), v.spelled(part)
            else:
                continue
            if best[j] is None or best[i][0] + score > best[j][0]:
                best[j] = best[i][0] + score, best[i][1] + ids
    return best[-1][1]


def test_sentencepiece_equals_brute_force(documents):
    encoder = pieces.encoder(PIECE)
    texts = odd_texts(800) + [r["text"][:700] for r in documents.limit(20).collect()]
    ids, sizes = encoder.encode(pa.array(texts))
    at = starts(sizes)
    for i, text in enumerate(texts):
        own = ids[at[i] : at[i + 1]].tolist()
        assert own == brute(text, encoder.vocabulary)
        assert pieces.decoded(own, encoder.vocabulary) == text.replace(pieces.SPACE, " ")


def test_cuts_are_where_no_piece_spans(documents):
    """Parts put together are the texts, and parts encoded alone give the ids of the whole."""
    encoder = pieces.encoder(PIECE)
    v = encoder.vocabulary
    texts = ["", "a", "word,", "x\U0001f600y", "é!!日本語.a\nb", "▁▁", "a" * 500, "don't..."] + odd_texts(200)
    parts, counts = v.cut(pa.array(texts, pa.string()))
    parts, at = parts.to_pylist(), starts(counts)
    for i, text in enumerate(texts):
        own = parts[at[i] : at[i + 1]]
        assert "".join(own) == text
        assert [x for p in own if p for x in encoder.ids(p)] == (encoder.ids(text) if text else [])
        for a, b in zip(own, own[1:]):
            assert not any(a[-1] + b[0] in p for p in v.pieces)
    assert counts[2] > 1
    for none in ([], [""], ["", ""]):
        parts, counts = v.cut(pa.array(none, pa.string()))
        assert "".join(parts.to_pylist()) == "" and counts.sum() == len(parts)


def test_stream_is_bounded(documents):
    """A text fed in parts gives the ids of the whole, and keeps a short window only."""
    v = pieces.encoder(PIECE).vocabulary
    text = pieces.SPACE + " ".join(r["text"] for r in documents.limit(40).collect()).replace(" ", pieces.SPACE)
    whole = pieces.Stream(v)
    expected = whole.feed(text) + whole.finish()
    make, stream, out, at, window = random.Random(1), pieces.Stream(v), [], 0, 0
    while at < len(text):
        n = make.randint(1, 50)
        out += stream.feed(text[at : at + n])
        window, at = max(window, len(stream.text)), at + n
    assert out + stream.finish() == expected
    assert window < 50 + 10 * v.longest


def test_sentencepiece_hard_rows(llm, hard, empty):
    encoded = pieces.encode_pieces(hard, PIECE)
    rows = pieces.decode_pieces(encoded, PIECE).collect()
    key = lambda r: (str(r[0]), r[1] or "")
    expected = sorted(((d, (t or "").replace(pieces.SPACE, " ")) for d, t, _, _ in HARD), key=key)
    assert sorted(((r["doc_id"], r["text"]) for r in rows), key=key) == expected
    assert all(r["n_ids"] == len(r["ids"]) // 4 for r in rows)
    none = llm.createDataFrame([(1, None, None)], "doc_id long, n_ids long, ids binary")
    assert pieces.decode_pieces(none, PIECE).first()["text"] is None
    assert pieces.encode_pieces(empty, PIECE).count() == 0
