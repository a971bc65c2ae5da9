"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text is its words, lower-cased in ASCII and spelled in bytes, each with an end mark, and one end
of text. Every symbol has a Huffman code made from the corpus, and each bit of it is predicted.
Predictors are counts of ones and zeros under a hash of the node in the code tree and a context:
the last two, three or four symbols before it in the word, and the last two or all of them
together with the class of the words before. Classes are those of the texts that the corpus
was learned from (their language, say); which one the words before belong to is found from the
words alone. The log-odds are mixed by weights that a gate chooses (the longest context that the
corpus has shown, and how often), each times a factor that is learned while the text is scored,
and the result is refined by an adaptive map from predicted to observed odds. Factors and map
are carried through the whole text and start afresh with the next, so a score depends on the
corpus and the text alone.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..sources.staging import stage
from .cells import runs
from .substring import DOCS, ENTRIES, PLACES, SENT, SENT_DDL, packed, unpacked
from .text import BASES, STEP, distinct, gather, mixed, record, slices, starts, within, word_hashes, words

END_OF_WORD, END_OF_TEXT, SYMBOLS = 256, 257, 258
# Slots of each predictor's table: contexts of 2, 3 and 4 symbols, and of a class with 2 symbols
# and with the whole word so far.
TABLES = (1 << 18, 1 << 20, 1 << 20, 1 << 18, 1 << 21)
# Classes told apart, at most; the rarer ones count as one. Words before that show the class.
CLASSES, MEMORY = 16, 24
ORDERS = len(TABLES)
OFFSETS = starts(np.array(TABLES))
# Numbers kept for each bit: the predictors', the gate's, and room to fill 32 bytes.
ROW = 8
# Pages that the tables are exchanged in; page p has every slot that leaves the remainder p.
PAGES = 256
# Bits of a text that are scored at once, the rounds this takes, and how fast factors and map are.
BLOCK, ROUNDS = 32, 2
RATE, MAP_RATE = 0.006, 0.02
# How often the longest context must have been seen for the next gate.
OFTEN = (4, 32)
GATES = ORDERS + 1 + len(OFTEN)
# Weights for each gate, from no context seen to the last one seen often; fitted by logistic
# regression on texts that were not counted.
START = np.array(
    [
        [0.4, 0.2, 0.1, 0.1, 0.1],
        [0.9, 0.1, 0.1, 0.1, 0.1],
        [0.3, 0.8, 0.1, 0.1, 0.1],
        [0.3, 0.1, 0.6, 0.1, 0.1],
        [0.25, 0.3, 0.4, 0.3, 0.0],
        [0.3, 0.35, 0.5, 0.2, 0.15],
        [0.05, 0.35, 0.5, 0.3, 0.4],
        [-0.15, 0.15, 0.25, 0.35, 0.5],
    ],
    np.float32,
)
WEIGHTS = np.pad(START, ((0, 0), (0, ROW - ORDERS)))
BUCKETS, REACH = 24, 6.0
# Words whose counts every task holds; others are looked up where their hash lies.
COMMON = 1 << 16
TEXT_AT_ONCE = 3 << 20
# Texts scored side by side, their number a multiple of ABREAST so that products of matrices add in
# the same order for each; what is kept of their blocks stays near the processor. Bits whose rows
# are listed at once.
TEXTS_AT_ONCE, ABREAST, BITS_AT_ONCE = 1 << 9, 1 << 4, 1 << 24
# Bits of a text that is scored with few others, as a slice holds a dozen at most.
LONG = 1 << 20
# Words spelled at once.
WORDS_AT_ONCE = 1 << 12
VOCABULARY = 3  # kind of row, beside those of the exchange


def huffman(counts: np.ndarray) -> list[list[tuple[int, int]]]:
    """For each symbol its code as (node, bit) pairs from the root on."""
    heap = [(float(n), i, i) for i, n in enumerate(counts)]
    heapq.heapify(heap)
    children, number = {}, len(counts)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        children[number] = (a[2], b[2])
        heapq.heappush(heap, (a[0] + b[0], number, number))
        number += 1
    codes: list[list[tuple[int, int]]] = [[] for _ in counts]
    todo = [(heap[0][2], [])]
    while todo:
        node, path = todo.pop()
        if node in children:
            for bit, child in enumerate(children[node]):
                todo.append((child, [*path, (node, bit)]))
        else:
            codes[node] = path
    return codes


def _joined(values: pa.Array):
    """The bytes of all words, one after another."""
    if not len(values):
        return b""
    lists = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    return pc.binary_join(lists, "")[0].as_buffer()


def _slots(context: np.ndarray, node: np.ndarray, k: int) -> np.ndarray:
    """Places in table ``k`` for contexts, whose array is used up, at nodes."""
    context += node
    context *= STEP
    context >>= np.uint64(64 - TABLES[k].bit_length() + 1)
    context = context.view(np.int64)
    context += OFFSETS[k]
    return context


class Code:
    """Huffman codes of all symbols in flat arrays."""

    def __init__(self, counts: np.ndarray) -> None:
        codes = huffman(counts)
        self.size = np.array([len(c) for c in codes], np.int64)
        self.begin = starts(self.size)[:-1]
        flat = np.array([pair for c in codes for pair in c], np.int64).reshape(-1, 2)
        self.hashed = mixed(flat[:, 0].astype(np.uint64) + np.uint64(77))
        self.bit = flat[:, 1].astype(np.int8)

    def length(self, values: pa.Array) -> int:
        """The bits of all words, and of the end of text."""
        letters = np.bincount(np.frombuffer(_joined(values), np.uint8), minlength=256)
        return int(letters @ self.size[:256] + len(values) * self.size[END_OF_WORD] + self.size[END_OF_TEXT])

    def bits(self, values: pa.Array, classes: np.ndarray):
        """Of words after words of some class: for each bit its slot in every table and its value;
        and the number of bits of each word.

        After the words comes one more entry, the end of text.
        """
        sizes = pc.binary_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
        data = _joined(values)
        symbols = np.full(int(sizes.sum()) + len(values) + 1, END_OF_WORD, np.int64)
        at = starts(sizes + 1)
        symbols[gather(at[:-1], sizes)] = np.frombuffer(data, np.uint8)
        symbols[-1] = END_OF_TEXT
        counts = np.append(sizes + 1, 1)
        place = within(counts)
        # What stands before a symbol in its word; -1 before the first one.
        context, hashes = np.zeros(len(symbols), np.uint64), []
        for back in range(1, 5):
            before = np.roll(symbols, back)
            before[place < back] = 300 + back
            context = mixed(context + before.astype(np.uint64) + np.uint64(1000 * back))
            hashes.append(context)
        own = mixed((symbols + 512 * place).astype(np.uint64))
        sums = np.cumsum(own) - own
        whole = mixed(sums - np.repeat(sums[starts(counts)[:-1]], counts))
        kind = np.repeat(np.append(classes, CLASSES), counts).astype(np.uint64) * np.uint64(0x9E3779B1)
        # The shortest context alone says little more than the code itself.
        hashes = [*hashes[1:], mixed(hashes[1] + kind), mixed(whole + kind)]
        lengths = self.size[symbols]
        flat = gather(self.begin[symbols], lengths)
        # Both are well mixed, so that a sum and a product will do for their pair.
        node = self.hashed[flat]
        slots = (_slots(np.repeat(h, lengths), node, k) for k, h in enumerate(hashes))
        total = starts(lengths)[starts(counts)]
        return slots, self.bit[flat], np.diff(total)


@dataclass
class MixingModel:
    code: Code
    # For every slot the log-odds of a one, and whether it was seen and how often on the scale of
    # OFTEN; side by side, as both are looked up at once.
    seen: np.ndarray
    common: dict[str, int]  # counts of the commonest words
    kinds: np.ndarray  # for each of them the log-odds of every class
    docs: int
    tokens: int  # N
    types: int  # V

    @property
    def floor(self) -> float:
        return math.log10(self.tokens + 0.5 * (self.types + 1))

    def before(self, code: np.ndarray, place: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The class of the words before each word, ``CLASSES`` if they do not show one.

        ``place`` is a distinct word's place among the common ones, or -1.
        """
        kinds = np.vstack([self.kinds, np.zeros((1, self.kinds.shape[1]))])[place]
        here = np.arange(len(code))
        first = np.maximum(np.repeat(starts(counts)[:-1], counts), here - MEMORY)
        best, most = np.full(len(code), CLASSES), np.zeros(len(code))
        for k in range(self.kinds.shape[1]):
            sums = np.concatenate([[0], np.cumsum(kinds[code, k])])
            total = sums[here] - sums[first]
            better = total > most + 1e-6
            best[better], most[better] = k, total[better]
        return best

    def rows(self, values: pa.Array, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What ``mixed_logs`` needs of every bit of words and the end of text, and words' bits.

        Few words are spelled at once, so that what is kept of them stays small.
        """
        rows = np.zeros((self.code.length(values), ROW), np.float32)
        per_word, at = np.empty(len(values) + 1, np.int64), 0
        both = self.seen.view(np.int64).ravel()
        for begin in range(0, max(1, len(values)), WORDS_AT_ONCE):
            some = values.slice(begin, WORDS_AT_ONCE)
            slots, bit, sizes = self.code.bits(some, classes[begin : begin + WORDS_AT_ONCE])
            part = rows[at : at + len(bit)]
            gate = np.zeros(len(bit), np.int8)
            for k, slot in enumerate(slots):
                pair = both.take(slot)
                part[:, k], often = pair.view(np.float32)[::2], pair.view(np.float32)[1::2]
                # The higher half holds how often, and all its bits are zero for never.
                np.maximum(gate, (pair > 0xFFFFFFFF).view(np.int8) * np.int8(k + 1), out=gate)
            gate += np.where(gate == ORDERS, np.maximum(often.astype(np.int8) - 1, 0), 0).astype(np.int8)
            part *= WEIGHTS.take(gate, axis=0)
            # A bit's gate as a place in the map, and its value.
            part[:, ORDERS] = gate.astype(np.int32) * BUCKETS * 2 + bit
            per_word[begin : begin + len(sizes)] = sizes
            # The end of text counts once, after the last words.
            at += len(bit) - int(sizes[-1])
        return rows, per_word

    def scores(self, code: np.ndarray, values: pa.Array, counts: np.ndarray, place) -> np.ndarray:
        """Logarithm (base 10) of the probability of each text, given its distinct words."""
        after = code.astype(np.int64) * (CLASSES + 1) + self.before(code, place, counts)
        # In the order of their first places, so that rare words lie as they are read.
        code, pairs = distinct(pa.array(after))
        pairs = pairs.to_numpy()
        values = values.take(pa.array(pairs // (CLASSES + 1)))
        rows, per_word = self.rows(values, pairs % (CLASSES + 1))
        first, begin = starts(per_word)[:-1].astype(np.int32), starts(counts)
        sums = starts(per_word[code])
        bits_of = sums[begin[1:]] - sums[begin[:-1]] + per_word[-1]
        order, out = np.argsort(-bits_of, kind="stable"), np.empty(len(counts))
        begin = begin[:-1]
        while len(order):
            some = order[: max(1, int(np.searchsorted(np.cumsum(bits_of[order]), BITS_AT_ONCE, "right")))]
            order = order[len(some) :]
            # The words of each text and its end, then the bits of each.
            n = counts[some]
            entry = np.full(int(n.sum()) + len(n), len(values), np.int32)
            entry[gather(starts(n + 1)[:-1], n)] = code[gather(begin[some], n)]
            length = per_word[entry]
            # Within a word a bit's row is the one after the last.
            index, row = np.ones(int(length.sum()), np.int32), first[entry]
            index[starts(length)[:-1]] = np.diff(row, prepend=0) - np.append(0, length[:-1] - 1)
            np.cumsum(index, out=index)
            out[some] = mixed_logs(rows, index, starts(bits_of[some])[:-1], bits_of[some])
        return out / math.log(10)


def mixed_logs(rows, index, begin, size) -> np.ndarray:
    """Natural logarithm of the probability of each text, texts of like length side by side."""
    order, out = np.argsort(-size, kind="stable"), np.empty(len(size))
    # A text's own length decides, so that its score does not depend on the others.
    long = int((size > LONG).sum())
    for texts, score in ((order[:long], _few), (order[long:], _side_by_side)):
        for at in range(0, len(texts), TEXTS_AT_ONCE):
            some = texts[at : at + TEXTS_AT_ONCE]
            out[some] = score(rows, index, begin[some], size[some])
    return out


def _side_by_side(rows, index, begin, size) -> np.ndarray:
    """Natural logarithm of the probability of each text, the longest text first.

    What a text's bits teach counts up to its end, however long it is. A text is taken in blocks,
    the same ones whatever stands beside it. What the bits of a block teach the later ones through
    the factors is the sum of their rows times their errors; as that changes the errors by little,
    ``ROUNDS`` rounds find it. Then it is known which cell of the map each bit meets, and the map
    learns from one bit of every text after another. Arrays have the texts side by side in their
    last axis, so that the work for a bit does not grow with the block.

    ``rows`` has for each bit the predictors' log-odds times their weights under the bit's gate, and
    twice the gate's place in the map plus the bit; a row of 32 bytes is gathered at once.
    """
    texts = len(size)
    n = -(-texts // ABREAST) * ABREAST
    begin, size = (np.concatenate([a, np.zeros(n - len(a), np.int64)]) for a in (begin, size))
    blocks = -(-size // BLOCK)
    running = n - np.cumsum(np.bincount(blocks, minlength=1))
    factors = np.ones((ORDERS, n), np.float32)
    centre = (np.arange(BUCKETS) + 0.5) / BUCKETS * 2 * REACH - REACH
    table = np.tile(1 / (1 + np.exp(-centre)), n * GATES).astype(np.float32)
    own, here = np.arange(n) * (GATES * BUCKETS), begin + np.arange(BLOCK)[:, None]
    earlier, width, total = np.tri(BLOCK, k=-1, dtype=np.float32), 0, np.zeros(n)
    # Small arrays of no dimension, as scalars are converted in each step.
    unit, zero, half, scale, rate, map_rate, left, last, least, most = (
        np.array(v, np.float32)
        for v in (1, 0, 0.5, BUCKETS / 2 / REACH, RATE, MAP_RATE, 1 - MAP_RATE, BUCKETS - 1, -12, 12)
    )
    middle = np.array(BUCKETS / 2, np.float32)
    for block, k in enumerate(running[:-1].tolist()):
        k = -(-k // ABREAST) * ABREAST
        if k != width:
            width, own = k, own[:k]
            here, factors = here[:, :k].copy(), factors[:, :k].copy()
            x, products, taught = np.empty((3, ORDERS, BLOCK, k), np.float32)
            alone, z, p, one, wrong, known, adds = np.empty((7, BLOCK, k), np.float32)
            place, after = np.empty((BLOCK, k), np.int64), np.empty(k, np.float32)
            steps = list(zip(place, known, adds))
        got = rows.take(index.take(here, mode="clip"), axis=0)
        here += BLOCK
        np.copyto(x, got[:, :, :ORDERS].transpose(2, 0, 1))
        cell = got[:, :, ORDERS].astype(np.int32)
        np.copyto(one, cell & 1)
        np.einsum("abc,ac->bc", x, factors, out=alone)
        np.copyto(z, alone)
        for _ in range(ROUNDS):
            # The errors only teach here, so that a chance need not be exact near its ends.
            np.multiply(z, half, p)
            np.tanh(p, p)
            np.multiply(p, half, p)
            np.add(p, half, p)
            np.subtract(one, p, wrong)
            np.multiply(wrong, rate, wrong)
            np.multiply(x, wrong, products)
            np.matmul(earlier, products, taught)
            np.einsum("abc,abc->bc", x, taught, out=z)
            np.add(z, alone, z)
        np.minimum(z, most, p)
        np.maximum(p, least, p)
        np.negative(p, p)
        np.exp(p, p)
        np.add(p, unit, p)
        np.reciprocal(p, p)
        np.subtract(one, p, wrong)
        np.multiply(wrong, rate, wrong)
        factors += np.einsum("abc,bc->ac", x, wrong)
        np.multiply(z, scale, z)
        np.add(z, middle, z)
        np.maximum(z, zero, z)
        np.minimum(z, last, z)
        cell >>= 1
        cell += z.astype(np.int32)
        np.add(cell, own, place)
        np.multiply(one, map_rate, adds)
        # The next bit may read the cell that this one changes.
        for at, value, more in steps:
            table.take(at, None, value, "clip")
            np.multiply(value, left, after)
            np.add(after, more, after)
            table[at] = after
        np.add(p, known, p)
        np.multiply(p, half, p)
        np.subtract(unit, one, z)
        np.subtract(z, p, p)
        np.abs(p, p)
        # After a text's end nothing counts; what is learned there is not used again.
        ended = running[block + 1]
        if ended < k:
            p[:, ended:][np.arange(BLOCK)[:, None] >= size[ended:k] - block * BLOCK] = 1
        # A chance is no less than 3e-6, so that the product of a block can be written.
        total[:k] += np.log(np.multiply.reduce(p, axis=0, dtype=np.float64))
    return total[:texts]


def _few(rows, index, begin, size) -> np.ndarray:
    """As ``_side_by_side`` for texts that have few others of like length beside them.

    Arrays have a text's bits in their last axis: the products of every two rows of a block show what
    its bits teach each other, and which bits meet in a cell, how much of it each leaves. That is more
    work, in a third of the calls.
    """
    n = len(size)
    factors = np.zeros((n, ROW, 1), np.float32)
    factors[:, :ORDERS] = 1
    centre = (np.arange(BUCKETS) + 0.5) / BUCKETS * 2 * REACH - REACH
    table = np.tile(1 / (1 + np.exp(-centre)), n * GATES).astype(np.float32)
    own = (np.arange(n) * (GATES * BUCKETS))[:, None]
    # The share of a cell that is left after so many bits, and what a one adds to it.
    left = ((1 - MAP_RATE) ** np.arange(BLOCK)).astype(np.float32)
    added = np.float32(MAP_RATE / (1 - MAP_RATE))
    earlier, ones = np.tri(BLOCK, k=-1, dtype=bool), np.ones((BLOCK, 1), np.float32)
    blocks = -(-size // BLOCK)
    running = n - np.cumsum(np.bincount(blocks, minlength=1))
    total = np.zeros(n)
    half, scale = np.float32(BUCKETS / 2), np.float32(BUCKETS / 2 / REACH)
    rate, map_rate, last = np.float32(RATE), np.float32(MAP_RATE), np.float32(BUCKETS - 1)
    here = begin[:, None] + np.arange(BLOCK)
    for block, k in enumerate(running[:-1]):
        ended = k - running[block + 1]
        got = rows.take(index.take(here[:k], mode="clip"), axis=0)
        here[:k] += BLOCK
        cell = got[:, :, ORDERS].astype(np.int32)
        got[:, :, ORDERS] = 0
        one = (cell & 1).astype(np.float32)
        alone = np.matmul(got, factors[:k])[:, :, 0]
        taught = np.matmul(got * rate, got.transpose(0, 2, 1))
        taught *= earlier
        z = alone.copy()
        for again in range(ROUNDS + 1):
            if again:
                np.add(np.matmul(taught, wrong[:, :, None])[:, :, 0], alone, out=z)
            p = np.clip(z, -12, 12)
            np.negative(p, out=p)
            np.exp(p, out=p)
            p += 1
            np.reciprocal(p, out=p)
            wrong = one - p
        wrong *= rate
        factors[:k] += np.matmul(got.transpose(0, 2, 1), wrong[:, :, None])
        z *= scale
        z += half
        np.clip(z, 0, last, out=z)
        cell >>= 1
        cell += z.astype(np.int32)
        place = cell + own[:k]
        cell = cell.astype(np.uint8)
        same = cell[:, :, None] == cell[:, None, :]
        same &= earlier
        same = same.astype(np.float32)
        share = left.take(np.matmul(same, ones)[:, :, 0].astype(np.intp))
        known = np.matmul(same, (one / share)[:, :, None])[:, :, 0]
        known *= added
        known += table.take(place)
        known *= share
        chance = p + known
        chance *= 0.5
        np.subtract(1 - one, chance, out=chance)
        np.abs(chance, out=chance)
        # After a text's end nothing counts; what is learned there is not used again.
        rest = size[k - ended : k] - block * BLOCK
        chance[k - ended :][np.arange(BLOCK) >= rest[:, None]] = 1
        # A chance is no less than 3e-6, so that the product of a block can be written.
        total[:k] += np.log(np.multiply.reduce(chance, axis=1, dtype=np.float64))
        one -= known
        one *= map_rate
        np.add.at(table, place.ravel(), one.ravel())
    return total


WORDS = pa.schema([("word", pa.string()), ("n", pa.int64())])
KINDS = pa.schema([("word", pa.string()), ("kind", pa.int32()), ("n", pa.int64())])
KINDS_DDL = "word string, kind int, n long"


def _word_counts(batches):
    for rows in slices(batches):
        flat, counts = words(pc.ascii_lower(rows["text"]))
        code, values = distinct(flat)
        kind = np.repeat(rows["kind"].to_numpy(), counts)
        pairs, n = np.unique(code.astype(np.int64) * (CLASSES + 1) + kind, return_counts=True)
        word = values.take(pa.array(pairs // (CLASSES + 1)))
        yield record({"word": word, "kind": pairs % (CLASSES + 1), "n": n}, KINDS)


def _symbol_counts(batches):
    total = np.zeros(SYMBOLS, np.int64)
    for batch in batches:
        n = batch["n"].to_numpy()
        sizes = pc.binary_length(batch["word"]).to_numpy(zero_copy_only=False)
        data = b"".join(w.as_buffer().to_pybytes() for w in batch["word"])
        weight = np.repeat(n, sizes)
        total[:256] += np.bincount(np.frombuffer(data, np.uint8), weight, 256).astype(np.int64)
        total[END_OF_WORD] += n.sum()
    yield record({"word": list(map(str, range(SYMBOLS))), "n": total}, WORDS)


PAGE = pa.schema([("page", pa.int32()), ("salt", pa.int32()), ("data", pa.binary())])
PAGE_DDL = "page int, salt int, data binary"


def _bit_counts(shared):
    def count(batches):
        code = shared.value
        counts = np.zeros((2, int(OFFSETS[-1])), np.int64)
        flat = counts.reshape(-1)
        for batch in batches:
            # The end of text, which follows the words, is counted by the caller.
            slots, bit, per_word = code.bits(batch["word"], batch["kind"].to_numpy())
            n = np.repeat(np.append(batch["n"].to_numpy(), 0), per_word)
            side = bit * OFFSETS[-1]
            for slot in slots:
                slot += side
                np.add.at(flat, slot, n)
        task = TaskContext.get().partitionId()
        for page in range(PAGES):
            data = packed(counts[0, page::PAGES], counts[1, page::PAGES])
            yield record({"page": [page], "salt": [task], "data": [data]}, PAGE)

    return count


def _add_pages(batches):
    held, key = None, None
    for batch in batches:
        for row in batch.to_pylist():
            now = np.stack(unpacked(row["data"], np.int64, np.int64))
            if key == (row["page"], row["salt"]):
                held += now
            else:
                if key is not None:
                    yield record({"page": [key[0]], "salt": [key[1]], "data": [packed(*held)]}, PAGE)
                held, key = now, (row["page"], row["salt"])
    if key is not None:
        yield record({"page": [key[0]], "salt": [key[1]], "data": [packed(*held)]}, PAGE)


def learn_mixing(
    rows: DataFrame, kind: str | None = None, common: int = COMMON
) -> tuple[MixingModel, DataFrame]:
    """A model of all texts in ``rows``, and the table (word, n) of all their words.

    ``kind`` names a column with the texts' class, if there is one. The word table grows with the
    corpus and stays on the executors; every predictor is counted from it. The driver gets the
    tables of counts, whose size is fixed by ``TABLES``, the code's symbol counts, the ``CLASSES``
    most frequent classes and the ``common`` commonest words.
    """
    spark = rows.sparkSession
    rows = rows.select("text", (F.col(kind) if kind else F.lit(None)).cast("string").alias("kind"))
    sizes = rows.groupBy("kind").agg(F.count("*").alias("n"))
    docs = sizes.agg(F.sum("n")).first()[0] or 0
    top = sizes.where("kind IS NOT NULL").orderBy(F.desc("n"), "kind").limit(CLASSES).collect()
    names = [r["kind"] for r in top]
    number = F.lit(CLASSES)
    for i, name in enumerate(names):
        number = F.when(F.col("kind") == name, i).otherwise(number)
    texts = rows.select("text", number.cast("int").alias("kind"))
    kinds = texts.mapInArrow(_word_counts, KINDS_DDL).groupBy("word", "kind")
    kinds = stage(kinds.agg(F.sum("n").alias("n")), "words-by-class")
    vocabulary = stage(kinds.groupBy("word").agg(F.sum("n").alias("n")), "words")
    sums = vocabulary.agg(F.count("*").alias("v"), F.sum("n").alias("n")).first()
    symbols = vocabulary.mapInArrow(_symbol_counts, "word string, n long")
    symbols = symbols.groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = np.ones(SYMBOLS)
    for row in symbols:
        counts[int(row["word"])] += row["n"]
    counts[END_OF_TEXT] += docs
    code = Code(counts)
    shared = spark.sparkContext.broadcast(code)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pages = kinds.mapInArrow(_bit_counts(shared), PAGE_DDL)
    # Added in two steps, so that no task meets a page of every other task.
    pages = pages.withColumn("salt", F.pmod("salt", F.lit(16)))
    for keys in (["page", "salt"], ["page"]):
        pages = pages.repartition(parts, *keys).sortWithinPartitions(*keys)
        pages = pages.mapInArrow(_add_pages, PAGE_DDL).withColumn("salt", F.lit(0))
    seen = np.zeros((2, int(OFFSETS[-1])), np.int64)
    for row in pages.toLocalIterator():
        seen[:, row["page"] :: PAGES] = unpacked(bytes(row["data"]), np.int64, np.int64)
    # The ends of all texts, one pseudo-word.
    slots, bit, _ = code.bits(pa.array([], pa.string()), np.zeros(0, np.int64))
    for slot in slots:
        np.add.at(seen, (bit, slot), docs)
    odds = np.log((seen[1] + 0.4) / (seen[0] + 0.4)).astype(np.float32)
    total = seen.sum(axis=0)
    often = (total > 0).astype(np.uint8)
    for n in OFTEN:
        often += total >= n
    best = vocabulary.orderBy(F.desc("n"), "word").limit(common)
    # The words' classes; both sides of the join hold at most ``common`` words and their classes.
    best = stage(best, "common-words")
    by_kind = kinds.where(F.col("kind") < CLASSES).join(best.select("word"), "word").toPandas()
    best = best.orderBy(F.desc("n"), "word").collect()
    place = {r["word"]: i for i, r in enumerate(best)}
    table = np.zeros((len(place), len(names)))
    table[by_kind["word"].map(place), by_kind["kind"]] = by_kind["n"]
    share = (table + 0.5) / (table.sum(axis=0) + 0.5 * max(1, len(place)))
    odds_of = np.log(share) - np.log(share.mean(axis=1, keepdims=True)) if names else table
    tokens = int(sums["n"] or 0) + docs
    model = MixingModel(
        code, np.stack([odds, often], axis=1, dtype=np.float32), {r["word"]: r["n"] for r in best}, odds_of, docs, tokens, int(sums["v"]) + (docs > 0)
    )
    return model, vocabulary


def by_length(batches):
    """The rows of each batch by the length of their texts, as texts of one length are scored in
    the same number of steps."""
    for batch in batches:
        # Only the sorted rows are kept.
        batch = batch.take(pc.array_sort_indices(pc.fill_null(pc.binary_length(batch["text"]), 0)))
        yield batch


def _base_sender(shared, bits: int):
    """Scores of the mixing model and of common words; other words go to their buckets."""

    def send(batches):
        model = shared.value
        common = pa.array(list(model.common), pa.string())
        logs = np.log10(np.array([*model.common.values(), 0], float) + 0.5)
        task = TaskContext.get().partitionId() << 32
        for sequence, rows in enumerate(slices(by_length(batches), limit=TEXT_AT_ONCE)):
            flat, counts = words(pc.ascii_lower(rows["text"]))
            code, values = distinct(flat)
            place = pc.fill_null(pc.index_in(values, value_set=common), -1).to_numpy(zero_copy_only=False)
            score = model.scores(code, values, counts, place)
            doc, n = np.repeat(np.arange(len(counts)), counts), len(counts)
            there = (place >= 0)[code]
            base = np.bincount(doc[there], logs[place[code[there]]], n).astype(float)
            known = np.bincount(doc[there], minlength=n)
            # The end of the text.
            base += math.log10(model.docs + 0.5)
            known += model.docs > 0
            rare = np.flatnonzero(~there)
            pair, times = np.unique(code[rare].astype(np.int64) * n + doc[rare], return_counts=True)
            lone = values.take(pa.array(np.flatnonzero(place < 0)))
            number = np.cumsum(place < 0) - 1
            high, low = (word_hashes(lone, b) for b in BASES)
            word = number[pair // max(1, n)]
            columns = [high[word], low[word].astype(np.uint32), (pair % max(1, n)).astype(np.uint32), times.astype(np.uint32)]
            order = np.argsort(columns[0], kind="stable")
            docs = (rows["doc_id"].fill_null(0).to_numpy(), rows["doc_id"].is_null().to_numpy(zero_copy_only=False), counts.astype(np.int64), base, known.astype(np.int64), score)
            yield _bucket_rows(task + sequence, bits, [c[order] for c in columns], ENTRIES, docs)

    return send


def _bucket_rows(unit: int, bits: int, columns, kind: int, docs=None) -> pa.RecordBatch:
    """Rows for the buckets of the first column (ascending), and one with ``docs``."""
    heads = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    cuts = np.concatenate([[0], np.searchsorted(columns[0], heads), [len(columns[0])]])
    full = np.flatnonzero(np.diff(cuts))
    out = {
        "bucket": full.tolist(),
        "unit": [unit] * len(full),
        "kind": [kind] * len(full),
        "data": [packed(*(c[cuts[b] : cuts[b + 1]] for c in columns)) for b in full],
    }
    if docs is not None:
        for name, value in zip(out, (unit % (1 << bits), unit, DOCS, packed(*docs)), strict=True):
            out[name].append(value)
    return record(out, SENT)


def _vocabulary_sender(bits: int):
    def send(batches):
        for sequence, batch in enumerate(batches):
            if batch.num_rows:
                high, low = (word_hashes(batch["word"], b) for b in BASES)
                order = np.argsort(high, kind="stable")
                columns = [high[order], low[order].astype(np.uint32), batch["n"].to_numpy()[order]]
                yield _bucket_rows(-1 - sequence, bits, columns, VOCABULARY)

    return send


ANSWER = pa.schema([("unit", pa.int64()), ("kind", pa.int32()), ("data", pa.binary())])
ANSWER_DDL = "unit long, kind int, data binary"


def _look_up(batches):
    """Counts of the words in a bucket, summed for every document that sent some."""
    for table, begins in runs(batches, ["bucket"]):
        for begin, end in zip(begins[:-1], begins[1:], strict=True):
            part = table.slice(begin, end - begin)
            kinds, units = part["kind"].to_pylist(), part["unit"].to_pylist()
            data = part["data"].to_pylist()
            own = [unpacked(d, np.uint64, np.uint32, np.int64) for k, d in zip(kinds, data) if k == VOCABULARY]
            key = np.zeros(0, KEY)
            if own:
                high, low, n = map(np.concatenate, zip(*own, strict=True))
                key = np.empty(len(n), KEY)
                key["high"], key["low"] = high, low
                order = np.lexsort((low, high))
                key, n = key[order], n[order]
            for kind, unit, d in zip(kinds, units, data, strict=True):
                if kind == DOCS:
                    yield record({"unit": [unit], "kind": [DOCS], "data": [d]}, ANSWER)
                elif kind == ENTRIES:
                    high, low, doc, times = unpacked(d, np.uint64, np.uint32, np.uint32, np.uint32)
                    count = np.zeros(len(high))
                    at = np.searchsorted(key["high"], high)
                    # Words whose first hash is the same differ in the second.
                    while len(key):
                        here = np.minimum(at, len(key) - 1)
                        same = key["high"][here] == high
                        found = same & (key["low"][here] == low) & (at < len(key))
                        count[found] = n[here[found]]
                        more = same & ~found & (at < len(key))
                        if not more.any():
                            break
                        at = at + more
                    sums = np.bincount(doc, times * np.log10(count + 0.5))
                    known = np.bincount(doc, times * (count > 0)).astype(np.int64)
                    some = np.unique(doc)
                    answer = packed(some.astype(np.uint32), sums[some], known[some])
                    yield record({"unit": [unit], "kind": [PLACES], "data": [answer]}, ANSWER)


KEY = np.dtype([("high", np.uint64), ("low", np.uint32)])
SCORED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("train_tokens", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)
SCORED_DDL = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _put_together(tokens: int, floor: float):
    def run(batches):
        for table, begins in runs(batches, ["unit"]):
            for begin, end in zip(begins[:-1], begins[1:], strict=True):
                part = table.slice(begin, end - begin)
                kinds, data = part["kind"].to_pylist(), part["data"].to_pylist()
                ids, null, counts, base, known, score = unpacked(
                    data[kinds.index(DOCS)], np.int64, np.bool_, np.int64, np.float64, np.int64, np.float64
                )
                # In a fixed order, as sums of floating-point numbers depend on it.
                for d in sorted(d for k, d in zip(kinds, data, strict=True) if k == PLACES):
                    doc, sums, more = unpacked(d, np.uint32, np.float64, np.int64)
                    base[doc] += sums
                    known[doc] += more
                out = {"doc_id": pa.array(ids, mask=null), "n_tokens": counts + 1, "n_known": known}
                out |= {"train_tokens": [tokens] * len(ids), "score": score}
                yield record(out | {"base_score": base - (counts + 1) * floor}, SCORED)

    return run


def score_mixing(docs: DataFrame, model: MixingModel, vocabulary: DataFrame) -> DataFrame:
    """For every row the mixing model's log10 probability of its text and a unigram one.

    ``base_score`` sums log10((c + 0.5) / (N + 0.5 (V + 1))) over words and the end of the text;
    words that are not common meet their counts by a 96-bit hash. A null text counts as empty and
    is one token. Rows are taken as they come, repeated and null ids included; columns other than
    ``doc_id`` and ``text`` are not read. An empty table gives no rows, and a model of no rows
    scores every text.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(1, (4 * parts - 1).bit_length())
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    sent = rows.mapInArrow(_base_sender(shared, bits), SENT_DDL)
    counts = vocabulary.mapInArrow(_vocabulary_sender(bits), SENT_DDL)
    met = sent.unionByName(counts).repartition(parts, "bucket").sortWithinPartitions("bucket")
    answers = met.mapInArrow(_look_up, ANSWER_DDL)
    answers = answers.repartition(parts, "unit").sortWithinPartitions("unit")
    return answers.mapInArrow(_put_together(model.tokens, model.floor), SCORED_DDL)
