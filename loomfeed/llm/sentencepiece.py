"""Encoding and decoding with a SentencePiece vocabulary by streaming Viterbi."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from .encoders import Pool, REMEMBERED
from .text import distinct, gather, record, slices, starts

# Fixed value: what stands for a space.
SPACE = "▁"
# How much worse than the worst piece a byte is that no piece covers.
BYTE_PENALTY = 10.0
# The score of a place that no path reaches.
NEVER = float("-inf")
# Bytes of text encoded at once.
TEXT_AT_ONCE = 2 << 20


class Vocabulary:
    """Pieces with their scores as the model file has them, and byte pieces for all else."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces: dict[str, tuple[float, int]] = {}
        self.bytes: dict[int, int] = {}
        content = [b""] * size
        for i in range(size):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(name[3:5], 16)] = i
                content[i] = bytes([int(name[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.pieces[name] = (model.get_score(i), i)
                content[i] = name.replace(SPACE, " ").encode()
        self.unknown = model.unk_id()
        self.longest = max(map(len, self.pieces), default=1)
        self.byte_score = min((s for s, _ in self.pieces.values()), default=0.0) - BYTE_PENALTY
        self.tree = self._tree()
        # Neighbouring characters that some piece holds; between any others all paths meet.
        joined = {(ord(a), ord(b)) for p in self.pieces for a, b in zip(p, p[1:])}
        self.joined = pa.array([a << 21 | b for a, b in joined], pa.int64())
        # Whether a piece may begin before a space and go on after it.
        self.spans_words = any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        self.size = np.array([len(c) for c in content], np.int64)
        self.begin, self.content = starts(self.size)[:-1], np.frombuffer(b"".join(content), np.uint8)

    def _tree(self) -> dict:
        """Pieces by their characters: what may follow, the score and the id (or -1) up to here."""
        nodes: dict[str, tuple[dict, float, int]] = {}
        tree: dict = {}
        for name in self.pieces:
            below = tree
            for n in range(1, len(name) + 1):
                part = name[:n]
                node = nodes.get(part)
                if node is None:
                    score, i = self.pieces.get(part, (0.0, -1))
                    node = nodes[part] = below[part[-1]] = ({}, score, i)
                below = node[0]
        return tree

    def cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Texts cut between characters that no piece holds side by side, and the parts of each."""
        whole = "".join(texts.to_pylist())
        if not whole:
            return texts, np.ones(len(texts), np.int64)
        char = np.frombuffer(whole.encode("utf-32-le"), np.uint32).astype(np.int64)
        begin = starts(pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        first = np.ones(len(char), bool)
        together = pc.is_in(pa.array(char[:-1] << 21 | char[1:]), value_set=self.joined)
        first[1:] = ~together.to_numpy(zero_copy_only=False)
        first[begin[:-1][np.diff(begin) > 0]] = True
        size = 1 + (char > 0x7F) + (char > 0x7FF) + (char > 0xFFFF)
        offsets = np.append(starts(size)[:-1][first], size.sum()).astype(np.int32)
        buffers = pa.py_buffer(offsets), pa.py_buffer(whole.encode())
        parts = pa.StringArray.from_buffers(len(offsets) - 1, *buffers)
        return parts, np.diff(starts(first.astype(np.int64))[begin])

    def spelled(self, char: str) -> list[int]:
        """A character that no piece covers, as byte pieces."""
        return [self.bytes.get(b, self.unknown) for b in char.encode("utf-8", "replace")]


class Stream:
    """The best segmentation of a text that arrives in parts.

    Kept are the text since the last committed boundary and, for each place in it, the best score
    and the piece that ends there. Pieces that begin at places not yet extended are the surviving
    paths; where their backpointers meet, everything before is certain and its ids are returned.
    Places are extended only once the longest piece after them is known, so the window beyond the
    last certain boundary is bounded by where paths meet. Of equal scores the longer last piece
    wins.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.text = ""
        self.score: list[float] = [0.0]
        self.back: list[tuple[int, int] | None] = [None]  # begin, id or -1 for bytes
        self.done = 0  # places extended

    def feed(self, text: str) -> list[int]:
        self.text += text
        self._room()
        v = self.vocabulary
        out: list[int] = []
        last = len(self.text) - v.longest
        while self.done <= last:
            self._extend(min(last + 1, self.done + 2 * v.longest))
            out += self._commit(self._meeting())
            last = len(self.text) - v.longest
        return out

    def finish(self) -> list[int]:
        self._extend(len(self.text))
        return self._commit(len(self.text))

    def _room(self) -> None:
        more = len(self.text) + 1 - len(self.score)
        self.score += [NEVER] * more
        self.back += [None] * more

    def _extend(self, end: int) -> None:
        v, text, score, back = self.vocabulary, self.text, self.score, self.back
        tree, length = v.tree, len(text)
        for i in range(self.done, end):
            base = score[i]
            if base == NEVER:
                continue
            below, alone = tree, False
            for j in range(i, length):
                node = below.get(text[j])
                if node is None:
                    break
                below, own, piece = node
                if piece >= 0:
                    alone = alone or j == i
                    total = base + own
                    if total > score[j + 1]:
                        score[j + 1], back[j + 1] = total, (i, piece)
            if not alone:
                total = base + v.byte_score * len(text[i].encode("utf-8", "replace"))
                if total > score[i + 1]:
                    score[i + 1], back[i + 1] = total, (i, -1)
        self.done = end

    def _meeting(self) -> int:
        """The last boundary that all surviving paths have in common."""
        ahead = range(self.done, min(self.done + self.vocabulary.longest, len(self.text)) + 1)
        live = {i for i in ahead if self.score[i] != NEVER}
        while len(live) > 1:
            last = max(live)
            live.remove(last)
            live.add(self.back[last][0])
        return live.pop()

    def _commit(self, end: int) -> list[int]:
        parts, at = [], end
        while at:
            begin, piece = self.back[at]
            parts.append([piece] if piece >= 0 else self.vocabulary.spelled(self.text[begin]))
            at = begin
        if end:
            base = self.score[end]
            self.text = self.text[end:]
            self.score = [s - base for s in self.score[end:]]
            self.back = [b and (b[0] - end, b[1]) for b in self.back[end:]]
            self.back[0] = None
            self.done = max(0, self.done - end)
        return [i for part in reversed(parts) for i in part]


class Encoder:
    """Ids of texts; parts between certain boundaries are encoded once and remembered.

    All paths meet where no piece spans: before the spaces of most vocabularies, and between
    characters that no piece holds side by side.
    """

    # A stretch: spaces and what follows them up to the next space.
    _STRETCH = regex.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary(path)
        self.pool = Pool()

    def ids(self, text: str) -> list[int]:
        """The ids of one part or text, from a stream fed in pieces of it."""
        stream, out = Stream(self.vocabulary), []
        for begin in range(0, len(text), 1 << 16):
            out += stream.feed(text[begin : begin + (1 << 16)])
        return out + stream.finish()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and the number for each text."""
        if self.vocabulary.spans_words:
            lists = [self.ids(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts.to_pylist()]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            return np.array([i for ids in lists for i in ids], np.int32), sizes
        stretches = self._stretches(texts)
        counts = stretches.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        code, values = distinct(stretches.flatten())
        parts, cuts = self.vocabulary.cut(values)
        part, values = distinct(parts)
        place = self._known(values.to_pylist())[part]
        size = self.pool.size[place]
        ids = self.pool.ids[gather(self.pool.begin[place], size)]
        at = starts(size)[starts(cuts)]
        begin, size = at[code], np.diff(at)[code]
        return ids[gather(begin, size)], np.diff(starts(size)[starts(counts)])

    def _stretches(self, texts: pa.Array) -> pa.ListArray:
        # Where single spaces stand between words, a split by them will do.
        odd = pc.match_substring_regex(texts, f"  |^ | $|^$|{SPACE}").to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts, " ")
        flat = pc.binary_join_element_wise(pa.scalar(SPACE), lists.flatten(), "")
        lists = pa.ListArray.from_arrays(lists.offsets, flat)
        if not odd.any():
            return lists
        out, values = [], lists.take(pa.array(np.flatnonzero(~odd)))
        marked = (SPACE + t.replace(" ", SPACE) if t else "" for t in texts.filter(pa.array(odd)).to_pylist())
        out = pa.array([self._STRETCH.findall(t) for t in marked], pa.list_(pa.string()))
        order = np.empty(len(texts), np.int64)
        order[~odd] = np.arange(len(values))
        order[odd] = len(values) + np.arange(len(out))
        return pa.concat_arrays([values.cast(pa.list_(pa.string())), out]).take(pa.array(order))

    def _known(self, parts: list[str]) -> np.ndarray:
        pool = self.pool
        if len(pool.place) > REMEMBERED:
            pool.halve()
        find = pool.place.get
        place = np.array([find(p, -1) for p in parts], np.int64)
        absent = np.flatnonzero(place < 0)
        if len(absent):
            n, missing = len(pool.place), [parts[i] for i in absent.tolist()]
            lists = [self.ids(p) for p in missing]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            pool.add(missing, np.array([i for ids in lists for i in ids], np.int32), sizes)
            place[absent] = np.arange(n, n + len(absent))
        pool.hits[place] += 1
        return place


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def decoded(ids: np.ndarray, vocabulary: Vocabulary) -> str:
    """The text of ids: pieces put together, without the space in front."""
    ids = np.asarray(ids, np.int64)
    data = vocabulary.content[gather(vocabulary.begin[ids], vocabulary.size[ids])].tobytes()
    text = data.decode("utf-8", "replace")
    return text[1:] if text[:1] == " " else text


ENCODED = pa.schema([("doc_id", pa.int64()), ("n_ids", pa.int64()), ("ids", pa.binary())])
ENCODED_DDL = "doc_id long, n_ids long, ids binary"


def encode_pieces(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id``, ``n_ids`` and ``ids`` (little-endian unsigned 32-bit integers) of every text.

    A space is put in front and spaces become the vocabulary's space mark, as the model file asks
    for; of all segmentations into pieces the one with the largest sum of scores is taken, of equal
    ones that with the longer last piece. Characters without a piece become byte pieces. A null or
    empty text has no ids. Rows are taken as they come, repeated and null ids included; columns
    other than ``doc_id`` and ``text`` are not read. An empty table gives no rows.
    """

    def encode(batches):
        known = encoder(model)
        for rows in slices(batches, limit=TEXT_AT_ONCE):
            ids, sizes = known.encode(rows["text"])
            at = starts(sizes).tolist()
            data = [ids[i:j].astype("<u4").tobytes() for i, j in zip(at, at[1:])]
            yield record({"doc_id": rows["doc_id"], "n_ids": sizes, "ids": data}, ENCODED)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, ENCODED_DDL)


DECODED = pa.schema([*ENCODED, pa.field("text", pa.string())])


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """The rows of ``encode_pieces`` with their ``text``; null ids give a null text."""

    def decode(batches):
        vocabulary = encoder(model).vocabulary
        for batch in batches:
            texts = [
                None if b is None else decoded(np.frombuffer(b, "<u4"), vocabulary)
                for b in batch["ids"].to_pylist()
            ]
            columns = {n: batch[n] for n in ENCODED.names}
            yield record(columns | {"text": texts}, DECODED)

    rows = encoded.select("doc_id", "n_ids", "ids")
    return rows.mapInArrow(decode, ENCODED_DDL + ", text string")
