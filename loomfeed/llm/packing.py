"""Token ids of documents packed into windows of several lengths."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.staging import stage
from .encoders import ended, word_level
from .text import record, slices, starts

# Window lengths; a document of up to one tier's length and over the tier below goes to it.
TIERS = (256, 512, 1024, 2048)
# Tokens of one training step; a step group holds windows of one tier.
STEP_TOKENS = 64 * 2048
# Bytes of text encoded at once.
TEXT_AT_ONCE = 4 << 20

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("window", pa.int32()),
        ("part", pa.int32()),
        ("nth", pa.int64()),
        ("ids", pa.binary()),
    ]
)
PIECES_DDL = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
    "window int, part int, nth long, ids binary"
)


class Packer:
    """Pieces waiting for a window, by length, and the windows that are full.

    A piece is (document's id, place in it, ids, the document's tokens). ``drain`` returns the
    pieces of all windows that could be filled; at the end the rest, less than one long window, is
    laid into windows whose lengths are powers of two, so that nothing is padded. Windows of each
    length are numbered from 0.
    """

    def __init__(self, tiers=TIERS, part: int = 0) -> None:
        self.tiers, self.part, self.base = sorted(tiers), part, part << 40
        self.waiting: list[list[tuple]] = [[] for _ in range(self.tiers[-1] + 1)]
        self.lengths = 0  # bit n is set if a piece of n ids waits
        self.total = 0
        self.windows = 0
        self.sizes: dict[int, int] = {}
        self.out: dict[str, list] = {f.name: [] for f in PIECES}

    def add(self, doc, ids: np.ndarray) -> None:
        longest, n = self.tiers[-1], len(ids)
        whole = n - n % longest
        for begin in range(0, whole, longest):
            self._window(longest, [(doc, begin, ids[begin : begin + longest], n)])
        if n > whole:
            self._wait((doc, whole, ids[whole:], n))

    def _wait(self, piece) -> None:
        n = len(piece[2])
        self.waiting[n].append(piece)
        self.lengths |= 1 << n
        self.total += n

    def _take(self, most: int):
        """The longest waiting piece of at most ``most`` ids."""
        n = (self.lengths & ((2 << most) - 1)).bit_length() - 1
        if n < 1:
            return None
        piece = self.waiting[n].pop()
        if not self.waiting[n]:
            self.lengths ^= 1 << n
        self.total -= n
        return piece

    def _cut(self, gap: int):
        """The first ``gap`` ids of the shortest piece that is longer; the rest waits again."""
        longer = self.lengths >> (gap + 1)
        n = gap + 1 + (longer & -longer).bit_length() - 1
        doc, start, ids, tokens = self._take(n)
        self._wait((doc, start + gap, ids[gap:], tokens))
        return doc, start, ids[:gap], tokens

    def fill(self) -> None:
        """All windows that can be filled, longest tier first, gaps from the shorter ones."""
        floors = [0, *self.tiers[:-1]]
        for size, floor in reversed(list(zip(self.tiers, floors, strict=True))):
            tier = (1 << (size + 1)) - (1 << (floor + 1))
            while self.total >= size and self.lengths & tier:
                pieces = [self._take(size)]
                gap = size - len(pieces[0][2])
                while gap:
                    piece = self._take(gap) or self._cut(gap)
                    pieces.append(piece)
                    gap -= len(piece[2])
                self._window(size, pieces)

    def finish(self) -> None:
        self.fill()
        while self.total:
            size = 1 << (self.total.bit_length() - 1)
            pieces, gap = [], size
            while gap:
                piece = self._take(gap) or self._cut(gap)
                pieces.append(piece)
                gap -= len(piece[2])
            self._window(size, pieces)

    def _window(self, size: int, pieces: list[tuple]) -> None:
        nth = self.sizes.get(size, 0)
        self.sizes[size] = nth + 1
        offset, out = 0, self.out
        for doc, start, ids, doc_tokens in pieces:
            values = (doc, start, len(ids), doc_tokens, self.base + self.windows, offset, size, self.part, nth)
            for name, value in zip(PIECES.names, values, strict=False):
                out[name].append(value)
            out["ids"].append(ids.astype("<u4").tobytes())
            offset += len(ids)
        self.windows += 1

    def drain(self) -> pa.RecordBatch:
        batch = record(self.out, PIECES)
        self.out = {name: [] for name in self.out}
        return batch


def pack_documents(
    docs: DataFrame, tokenizer: str, end: int = 1, tiers=TIERS, step_tokens: int = STEP_TOKENS
) -> DataFrame:
    """Pieces of documents in windows of ``max(tiers)`` ids or fewer.

    A document is its ids and ``end``. Stretches of a whole long window are windows of their own;
    what is left goes to the smallest tier that holds it. Each tier is packed from its longest
    piece on, and the gap of a window is filled with the longest pieces of shorter tiers that fit,
    the last of them cut to the gap. Each input task packs its own documents and carries open pieces
    from batch to batch; its last ids go to windows of 1024, 512, ... as far as needed. The pieces
    are staged, then the windows of one length are numbered over all tasks by the tasks' counts and
    form step groups of ``step_tokens`` tokens, all but the last group of each length full.

    ``sequence_id`` and ``step_group`` are unique over all tasks, and ``offset`` is the place in
    the sequence. ``ids`` holds little-endian unsigned 32-bit integers. A null text counts as empty
    and yields ``end`` alone; null and repeated ids are packed like others; other columns are not
    read. An empty table gives no rows.
    """

    def pack(batches):
        encoder = word_level(tokenizer)
        packer = Packer(tiers, TaskContext.get().partitionId())
        for rows in slices(batches, limit=TEXT_AT_ONCE):
            ids, sizes = ended(*encoder.encode(rows["text"]), end)
            at = starts(sizes).tolist()
            for i, doc in enumerate(rows["doc_id"].to_pylist()):
                # A copy, as a view would hold the ids of the whole slice while a piece waits.
                packer.add(doc, ids[at[i] : at[i + 1]].copy())
            packer.fill()
            yield packer.drain()
        packer.finish()
        yield packer.drain()

    packed = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pack, PIECES_DDL)
    return step_groups(stage(packed, "packed"), step_tokens)


def step_groups(packed: DataFrame, step_tokens: int) -> DataFrame:
    """``packed`` with the step group of every piece's window.

    A task has a count for each length of window, so the running sums are over few rows. The
    remainder modulo 64 of a group's number tells the length.
    """
    counts = packed.groupBy("part", "window").agg((F.max("nth") + 1).alias("windows"))
    earlier = Window.partitionBy("window").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("part", "window", F.coalesce(F.sum("windows").over(earlier), F.lit(0)).alias("earlier"))
    group = F.expr(f"(earlier + nth) div greatest(1, {step_tokens} div window)")
    length = F.length(F.bin("window"))
    names = [f.name for f in PIECES if f.name not in ("part", "nth", "ids")]
    numbered = packed.join(counts, ["part", "window"])
    return numbered.select(*names, (group * 64 + length).alias("step_group"), "ids")
