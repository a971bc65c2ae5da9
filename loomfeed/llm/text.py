"""Words of whole Arrow columns of text, and gathering of rows of different lengths."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at once inside a task; a longer single text is a slice of its own.
SLICE = 4 << 20


def slices(batches, column: str = "text", limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that the texts of one slice stay near ``limit`` bytes.

    Nulls become empty strings.
    """
    for batch in batches:
        place = batch.schema.get_field_index(column)
        texts = pc.fill_null(batch.column(place).cast(pa.string()), "")
        batch = batch.set_column(place, column, texts)
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


def words(texts: pa.Array) -> tuple[pa.StringArray, np.ndarray]:
    """All words (runs without ASCII white space) in order, and the number in each text."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.greater(pc.binary_length(flat), 0)
    keep = full.to_numpy(zero_copy_only=False)
    if not keep.all():
        flat = flat.filter(full)
        sums = np.concatenate([[0], np.cumsum(keep)])
        ends = np.cumsum(counts)
        counts = sums[ends] - sums[ends - counts]
    return flat, counts


def starts(counts: np.ndarray) -> np.ndarray:
    """Where each run of ``counts`` begins, and at the end their sum."""
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... within each run."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(starts(counts)[:-1], counts)


def gather(begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of the concatenated runs ``begin[i] .. begin[i] + counts[i]``."""
    shift = begin - starts(counts)[:-1]
    return np.arange(int(counts.sum())) + np.repeat(shift, counts)


def distinct(flat: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """For each value the place of its distinct value, and the distinct values."""
    coded = pc.dictionary_encode(flat)
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def record(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema
    )


# Fixed odd multipliers for hashing; any others would do as well.
_MIX = np.uint64(0xBF58476D1CE4E5B9)
STEP = np.uint64(0x9E3779B97F4A7C15)
BASES = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
# Words hashed at once.
_AT_ONCE = 1 << 19


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * STEP
    return x ^ (x >> np.uint64(32))


# Letters of a word whose share in its hash is looked up.
_LOOKED_UP = 64


@lru_cache(maxsize=4)
def _shares(base: int) -> np.ndarray:
    return mixed(np.arange(_LOOKED_UP * 256, dtype=np.uint64) * np.uint64(base))


def word_hashes(flat: pa.StringArray, base: np.uint64) -> np.ndarray:
    """A 64-bit hash of every word (none of them empty): the sum of a hash of each letter and its
    place, mixed again."""
    out = np.empty(len(flat), np.uint64)
    for begin in range(0, len(flat), _AT_ONCE):
        part = flat.slice(begin, _AT_ONCE)
        ends = np.frombuffer(part.buffers()[1], np.int32)[part.offset : part.offset + len(part) + 1]
        data = np.frombuffer(part.buffers()[2], np.uint8)[ends[0] : ends[-1]]
        sizes = np.diff(ends).astype(np.int64)
        place = within(sizes) * 256 + data
        if len(sizes) and sizes.max() > _LOOKED_UP:
            value = mixed(place.astype(np.uint64) * base)
        else:
            value = _shares(int(base))[place]
        total = np.add.reduceat(value, (ends[:-1] - ends[0]).astype(np.int64))
        out[begin : begin + len(part)] = mixed(total + sizes.astype(np.uint64) * STEP)
    return out


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """For each place the hash of the ``size`` values from there on, by doubling."""
    done, width, double, reach = None, 0, hashes, 1
    while size:
        if size & 1:
            if done is None:
                done, width = double, reach
            else:
                n = max(0, len(double) - width)
                done, width = mixed(done[:n] * STEP + double[width : width + n]), width + reach
        size >>= 1
        if size:
            n = max(0, len(double) - reach)
            double, reach = mixed(double[:n] * STEP + double[reach : reach + n]), 2 * reach
    return done
