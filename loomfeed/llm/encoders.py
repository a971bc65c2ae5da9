"""Token ids of whole texts by the tokenizers library, each distinct piece encoded once.

Both encoders cut a text only where the tokenizer itself cuts it in any context, so the ids of the
pieces put together are the ids of the text. Texts for which that is not certain are encoded whole.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from .text import distinct, gather, starts, words

# Pieces a worker remembers from one batch to the next; beyond that it keeps the more frequent half.
REMEMBERED = 800_000
# Pre-tokens a worker remembers; the memory is emptied beyond that.
PARTS = 60_000
# Any white space, and the separators that some libraries count as such.
_WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_UNSURE = rf"{_WS}{_WS}|[\t\x0b\f\r\x1c-\x1f\x{{85}}\x{{a0}}]|[^\x20\P{{Z}}]|^{_WS}|{_WS}$"


def _byte_form() -> dict[int, str]:
    """The character that stands for each byte: itself if it can be seen, else one from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in seen]
    return {b: chr(256 + i) for i, b in enumerate(rest)}


BYTE_FORM = _byte_form()
# The byte-level form of each character that needs no care.
LATIN = {chr(i): chr(i).encode().decode("latin-1").translate(BYTE_FORM) for i in range(0x250)}


class Pool:
    """Ids of pieces in one array, found by the piece."""

    def __init__(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.empty(0, np.int32)
        self.begin = self.size = self.hits = np.empty(0, np.int64)

    def add(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n = len(self.place)
        self.begin = np.concatenate([self.begin, len(self.ids) + starts(sizes)[:-1]])
        self.size = np.concatenate([self.size, sizes])
        self.hits = np.concatenate([self.hits, np.zeros(len(pieces), np.int64)])
        self.ids = np.concatenate([self.ids, ids])
        self.place.update(zip(pieces, range(n, n + len(pieces)), strict=True))

    def halve(self) -> None:
        keep = np.sort(np.argsort(-self.hits, kind="stable")[: len(self.hits) // 2])
        names = list(self.place)
        self.place = {names[k]: i for i, k in enumerate(keep.tolist())}
        self.ids = self.ids[gather(self.begin[keep], self.size[keep])]
        self.size, self.hits = self.size[keep], self.hits[keep] // 2
        self.begin = starts(self.size)[:-1]


def woven(parts: list[tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and sizes of all texts, from those of some (told by a mask) and of others."""
    sizes = np.zeros(len(parts[0][0]), np.int64)
    for mask, (_, own) in parts:
        sizes[mask] = own
    flat = np.empty(int(sizes.sum()), np.int32)
    at = starts(sizes)[:-1]
    for mask, (ids, own) in parts:
        flat[gather(at[mask], own)] = ids
    return flat, sizes


class Encoder:
    """``encode`` gives the ids of all texts in one array, and the number for each text."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        # A special token's string inside a text is that token, as the library has it.
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Pieces of other texts hold none, though lower case may make them look like one.
        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.pool = Pool()
        self.parts: dict[str, list[int]] = {}

    def whole(self, texts: list[str], special: bool = False) -> list[list[int]]:
        tokenizer = self.tokenizer if special else self.plain
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        whole = np.zeros(len(texts), bool)
        for name in self.special:
            whole |= pc.match_substring(texts, name).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self.usual(texts)
        lists = self.whole(texts.filter(pa.array(whole)).to_pylist(), special=True)
        rest = self.usual(texts.filter(pa.array(~whole)))
        return woven([(whole, self._listed(lists)), (~whole, rest)])

    def known(self, pieces: list[str]) -> np.ndarray:
        """The place in the pool of every (distinct) piece; missing ones are encoded first."""
        pool = self.pool
        if len(pool.place) > REMEMBERED:
            pool.halve()
        find = pool.place.get
        place = np.array([find(p, -1) for p in pieces], np.int64)
        absent = np.flatnonzero(place < 0)
        if len(absent):
            n, missing = len(pool.place), [pieces[i] for i in absent.tolist()]
            pool.add(missing, *self.missing(missing))
            place[absent] = np.arange(n, n + len(absent))
        pool.hits[place] += 1
        return place

    def part(self, part: str) -> list[int]:
        """The ids of one pre-token in byte-level form."""
        ids = self.parts.get(part)
        if ids is None:
            if len(self.parts) > PARTS:
                self.parts.clear()
            ids = self.parts[part] = [t.id for t in self.model.tokenize(part)]
        return ids

    def missing(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces. Those of a word and at most one stop or comma are one or two pre-tokens;
        others are cut by the pattern, or encoded whole where characters are not Latin."""
        lists: list[list[int] | None] = []
        tokenize, fronts, form = self.model.tokenize, self.fronts, LATIN.__getitem__
        stops = {c: self.part(c) for c in ".,"}
        for piece in pieces:
            stop = stops.get(piece[-1])
            word = piece if stop is None else piece[:-1]
            head, lead = fronts.get(word[:1], ([], ""))
            if head or lead:
                word = word[1:]
            if not word.isalpha():
                lists.append(self.split(piece) if self.sure(piece) else None)
                continue
            if not word.isascii():
                if not self.sure(word):
                    lists.append(None)
                    continue
                word = "".join(map(form, self.lower(word)))
            ids = [t.id for t in tokenize(lead + word)]
            if stop is not None:
                ids += stop
            lists.append(head + ids if head else ids)
        rest = [i for i, ids in enumerate(lists) if ids is None]
        for i, ids in zip(rest, self.whole([pieces[i] for i in rest]), strict=True):
            lists[i] = ids
        return self._listed(lists)

    def _listed(self, lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = [i for ids in lists for i in ids]
        return np.array(flat, np.int32), sizes


class ByteLevel(Encoder):
    """Byte-level BPE whose pre-tokenizer attaches one space to the front of a word.

    A text is cut before every space and line feed that stands between other characters.
    """

    # Fixed value: the pattern of the pre-tokenizer.
    _PRE = regex.compile(
        r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    )

    def __init__(self, path: str) -> None:
        super().__init__(path)
        # Ids and byte-level form of what may stand before a word.
        self.fronts = {" ": ([], BYTE_FORM[32]), "\n": (self.part(BYTE_FORM[10]), "")}

    @staticmethod
    def lower(word):
        return word

    @staticmethod
    def sure(piece):
        # Beyond Latin the classes of characters may differ between libraries.
        return piece.isascii() or max(piece) < "\u0250"

    def split(self, piece):
        out = []
        for part in self._PRE.findall(piece):
            out += self.part("".join(map(LATIN.__getitem__, part)))
        return out

    def usual(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        unsure = pc.match_substring_regex(texts, _UNSURE).to_numpy(zero_copy_only=False)
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        usual = ~(unsure | empty)
        parts = [(empty, (np.empty(0, np.int32), np.zeros(int(empty.sum()), np.int64)))]
        if usual.any():
            parts.append((usual, self._pieces(texts.filter(pa.array(usual)))))
        if unsure.any():
            lists = self.whole(texts.filter(pa.array(unsure)).to_pylist())
            parts.append((unsure, self._listed(lists)))
        return woven(parts)

    def _pieces(self, texts):
        # A line feed before each text and each line marks words that have no space before them.
        marked = pc.replace_substring(pc.binary_join_element_wise("\n", texts, ""), "\n", " \n")
        lists = pc.split_pattern(marked, " ")
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False) - 1
        flat = lists.flatten()
        # The first part of every text is empty and falls away.
        keep = np.ones(len(flat), bool)
        keep[starts(counts + 1)[:-1]] = False
        code, values = distinct(flat.filter(pa.array(keep)))
        names = [v if v[0] == "\n" else " " + v for v in values.to_pylist()]
        place = self.known(names)[code]
        begin, size = self.pool.begin[place], self.pool.size[place]
        heads = starts(counts)[:-1]
        begin[heads] += 1  # the first line feed is not in the text
        size[heads] -= 1
        return self.pool.ids[gather(begin, size)], np.add.reduceat(size, heads)


class WordLevel(Encoder):
    """BPE with word ends whose pre-tokenizer drops white space and lower-cases."""

    # Fixed value: the pattern of the pre-tokenizer, for lower-cased words without white space.
    _PRE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
    # Printable ASCII and Latin letters are their own normal form once they are lower-cased.
    _SURE = regex.compile(r"[\x21-\x7e\xc0-\u012f\u0131-\u024f]+")

    fronts: dict = {}

    @staticmethod
    def lower(word):
        return word.lower()

    def sure(self, piece):
        return self._SURE.fullmatch(piece) is not None

    def split(self, piece):
        out = []
        for part in self._PRE.findall(piece.lower()):
            out += self.part("".join(map(LATIN.__getitem__, part)))
        return out

    def usual(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        flat, counts = words(pc.ascii_lower(texts))
        if not len(flat):
            return np.empty(0, np.int32), counts
        code, values = distinct(flat)
        place = self.known(values.to_pylist())[code]
        begin, size = self.pool.begin[place], self.pool.size[place]
        total = starts(size)[starts(counts)]
        return self.pool.ids[gather(begin, size)], np.diff(total)


@lru_cache(maxsize=4)
def byte_level(path: str) -> ByteLevel:
    return ByteLevel(path)


@lru_cache(maxsize=4)
def word_level(path: str) -> WordLevel:
    return WordLevel(path)


def ended(ids: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """``end`` appended to every text's ids."""
    out = np.full(len(ids) + len(sizes), end, np.int32)
    out[gather(starts(sizes + 1)[:-1], sizes)] = ids
    return out, sizes + 1
