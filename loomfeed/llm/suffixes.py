"""Repeated byte strings removed by suffix arrays of shards, wherever both copies stand.

Shards are cut by content, so that equal strings meet in one: of the short pieces inside a string
the one with the least hash, its anchor, is the same in every copy. Consecutive strings with one
anchor form a stretch. Stretches whose anchor occurs once are left; the others go to the shard of
their anchor, equal stretches as one. There a suffix array is built by induced sorting, and the
permuted common prefixes tell which strings also start elsewhere.

An anchor with very many different stretches is cut again: strings share a stretch if they also
share what is common to some consecutive ones, in the end the string itself. So no shard grows
with the number of documents around a frequent passage, and nothing is left out.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..sources.staging import release, stage
from .cells import runs
from .induced import permuted_prefixes, suffix_array
from .substring import _joined, _spans
from .text import BASES, STEP, distinct, gather, mixed, record, slices, starts

STRING = 200
# Bytes of a piece that may be an anchor.
PIECE = 64
# Different stretches of an anchor beyond which they are cut again, and into how many strings each.
CROWD = 4096
FINER = (16, 1)
# Bytes whose suffixes are sorted at once; a shard is never cut.
SORTED = 1 << 20
# Bytes of text cut into stretches at once.
SLICE = 2 << 20

# End marks of the whole text and of a stretch; bytes follow.
_END, _APART, _BYTE = 0, 1, 2
_PLACE = np.uint64((1 << 32) - 1)


@functools.lru_cache(2)
def _powers(millions: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    inverse = pow(int(BASES[0]), -1, 1 << 64)
    return tuple(np.cumprod(np.full(millions << 20, b, np.uint64)) for b in (int(BASES[0]), inverse))


def _piece_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each place on."""
    up, down = _powers(1 + (len(data) >> 20))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mixed((sums[size:] - sums[:-size]) * down[: len(data) - size + 1])


def _stretches(data: np.ndarray, ends: np.ndarray, string: int, piece: int):
    """First string, number of strings, hash and place of the anchor of all stretches in ``data``."""
    n = len(data) - string + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return none, none, none.view(np.uint64), none
    hashes = _piece_hashes(data, piece)
    # The least hash, and of equal ones the leftmost; the place makes the rest of the number.
    # How many bits it has must not depend on the other texts at hand.
    least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    wide, reach = string - piece + 1, 1
    while 2 * reach <= wide:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < wide:
        least = np.minimum(least[: len(least) - (wide - reach)], least[wide - reach :])
    anchor = (least & _PLACE).astype(np.int64)
    # Where strings begin that lie in one text.
    inside = np.zeros(n + 1, np.int32)
    begins = starts(np.diff(ends, prepend=0))[:-1]
    lasts = np.maximum(ends - string + 1, begins)
    np.add.at(inside, np.minimum(begins, n), 1)
    np.add.at(inside, np.minimum(lasts, n), -1)
    inside = np.cumsum(inside[:-1]) > 0
    head = inside.copy()
    head[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1])
    head[begins[begins < n]] = inside[begins[begins < n]]
    first = np.flatnonzero(head)
    counts = np.add.reduceat(inside, first, dtype=np.int64) if len(first) else np.empty(0, np.int64)
    anchor = anchor[first]
    return first, counts, hashes[anchor], anchor


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    begin, end = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(texts.buffers()[2], np.uint8)[begin:end] if end > begin else np.empty(0, np.uint8)
    return data, offsets[1:].astype(np.int64) - begin


ANCHORS = pa.schema([("okey", pa.int64()), ("h", pa.int64()), ("n", pa.int64())])
ANCHORS_DDL = "okey long, h long, n long"


def _anchors(string: int, piece: int):
    def run(batches):
        for rows in slices(batches, limit=SLICE):
            data, ends = _bytes(rows["text"])
            first, _, hashes, _ = _stretches(data, ends, string, piece)
            doc = np.searchsorted(ends, first, "right")
            order = np.lexsort((hashes, doc))
            doc, hashes = doc[order], hashes[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
            heads = np.flatnonzero(new)
            out = {"okey": rows["okey"].to_numpy()[doc[heads]], "h": hashes[heads].view(np.int64)}
            out["n"] = np.diff(np.append(heads, len(doc)))
            yield record(out, ANCHORS)

    return run


# A stretch, the place of its anchor in it, and where it stands (document key, text hash, first byte).
PLACED = pa.schema(
    [
        ("h", pa.int64()),
        ("s", pa.binary()),
        ("bytes", pa.binary()),
        ("anchor", pa.int64()),
        ("n", pa.int64()),
        ("places", pa.binary()),
    ]
)
PLACED_DDL = "h long, s binary, bytes binary, anchor long, n long, places binary"


def _gathered(data: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = pa.py_buffer(starts(sizes).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(first), [None, offsets, pa.py_buffer(data[gather(first, sizes)])])


def _shared(string: int, piece: int):
    """Stretches of each text whose anchors are in its ``hits``, equal ones of a slice as one."""

    def run(batches):
        for rows in slices(batches, limit=SLICE):
            data, ends = _bytes(rows["text"])
            first, counts, hashes, anchor = _stretches(data, ends, string, piece)
            doc = np.searchsorted(ends, first, "right")
            hits = rows["hits"]
            owner = np.repeat(np.arange(len(hits)), pc.list_value_length(hits).to_numpy(zero_copy_only=False))
            wanted = hits.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            # By text and anchor in one number; should two be the same, a stretch more is compared.
            own = mixed(hashes + doc.astype(np.uint64) * STEP)
            kept = np.flatnonzero(np.isin(own, mixed(wanted + owner.astype(np.uint64) * STEP)))
            if not len(kept):
                continue
            first, counts, doc = first[kept], counts[kept], doc[kept]
            h, anchor = hashes[kept].view(np.int64), anchor[kept] - first
            begins = starts(np.diff(ends, prepend=0))[:-1]
            places = np.stack([rows["okey"].to_numpy()[doc], rows["th"].to_numpy()[doc], first - begins[doc]], axis=1)
            code, values = distinct(_gathered(data, first, counts + string - 1))
            order = np.lexsort((code, h))
            h, code, places, anchor = h[order], code[order], places[order], anchor[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (code[1:] != code[:-1])
            cuts = np.append(np.flatnonzero(new), len(h))
            heads = cuts[:-1]
            values = values.take(pa.array(code[heads]))
            out = {"h": h[heads], "bytes": values, "anchor": anchor[heads], "n": np.diff(cuts)}
            out["s"] = [xxhash.xxh3_128_digest(v) for v in values.to_pylist()]
            out["places"] = [places[i:j].tobytes() for i, j in zip(heads, cuts[1:], strict=True)]
            yield record(out, PLACED)

    return run


def _finer(string: int, width: int):
    """Stretches cut into parts of up to ``width`` strings, by what all strings of a part share.

    Strings are numbered back from the anchor, so that equal ones fall into equal parts.
    """

    def run(batches):
        for rows in batches:
            out = []
            for row in rows.to_pylist():
                value, anchor = row["bytes"], row["anchor"]
                places = np.frombuffer(row["places"], np.int64).reshape(-1, 3)
                strings = len(value) - string + 1
                for part in range((anchor - strings + 1) // width, anchor // width + 1):
                    begin = max(anchor - (part + 1) * width + 1, 0)
                    end = min(anchor - part * width + 1, strings)
                    common = value[anchor - part * width : anchor - (part + 1) * width + 1 + string]
                    h = xxhash.xxh3_64_intdigest(common, part) ^ (row["h"] & ((1 << 64) - 1))
                    cut = value[begin : end - 1 + string]
                    moved = (places + np.array([0, 0, begin])).tobytes()
                    h -= (h >> 63) << 64
                    out.append((h, xxhash.xxh3_128_digest(cut), cut, anchor - begin, row["n"], moved))
            if out:
                yield record(dict(zip(PLACED.names, zip(*out, strict=True), strict=True)), PLACED)

    return run


REPEATS = pa.schema([("h", pa.int64()), ("s", pa.binary()), ("spans", pa.binary())])
REPEATS_DDL = "h long, s binary, spans binary"


def repeated(stretches: pa.Array, string: int) -> np.ndarray:
    """For every byte of ``stretches`` whether a string begins there that also begins elsewhere."""
    sizes = pc.binary_length(stretches).to_numpy(zero_copy_only=False).astype(np.int64)
    data, ends = _bytes(stretches)
    marked = ends + np.arange(len(ends))
    text = np.empty(len(data) + len(ends) + 1, np.int64)
    left = np.repeat(marked, sizes + 1) - np.arange(len(text) - 1)
    text[:-1][left > 0] = data
    text[:-1][left > 0] += _BYTE
    text[marked] = _APART
    text[-1] = _END
    left = np.append(left, 0)
    before, shared = permuted_prefixes(text, suffix_array(text, 256 + _BYTE), left, _APART)
    twice = shared >= string
    twice[before[twice]] = True
    return twice[left > 0]


def _repeats(string: int):
    """Strings of the stretches of each anchor that begin more than once, as spans of the stretch."""

    def shards(batches):
        held, size = [], 0
        for table, begins in runs(batches, ["h"]):
            sizes = np.add.reduceat(pc.binary_length(table["bytes"]).to_numpy(zero_copy_only=False), begins[:-1])
            for begin, end, more in zip(begins[:-1], begins[1:], sizes.tolist(), strict=True):
                if held and size + more > SORTED:
                    yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    held, size = [], 0
                held.append(table.slice(begin, end - begin))
                size += more
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    def run(batches):
        for rows in shards(batches):
            # Equal stretches of an anchor follow each other; one stands for all.
            h, digests = rows["h"].to_numpy(), rows["s"]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | pc.not_equal(digests[1:], digests[:-1]).to_numpy(zero_copy_only=False)
            n = np.add.reduceat(rows["n"].to_numpy(), np.flatnonzero(new))
            rows = rows.filter(pa.array(new))
            h = rows["h"].to_numpy()
            sizes = pc.binary_length(rows["bytes"]).to_numpy(zero_copy_only=False).astype(np.int64)
            # An anchor with one stretch has nothing to be compared with.
            several = np.zeros(len(h), bool)
            several[1:] = h[1:] == h[:-1]
            several[:-1] |= several[1:]
            flags = np.repeat(n > 1, sizes)
            if several.any():
                own = np.repeat(several, sizes)
                flags[own] |= repeated(rows["bytes"].filter(pa.array(several)), string)
            at = starts(sizes)
            # Only places where a whole string begins count.
            flags &= np.arange(len(flags)) <= np.repeat(at[1:] - string, sizes)
            place = np.flatnonzero(flags)
            row = np.searchsorted(at, place, "right") - 1
            first, last, row = _joined(place - at[row], place - at[row] + string, row)
            cuts = np.flatnonzero(np.concatenate([row[:1] >= 0, row[1:] != row[:-1]]))
            spans = np.stack([first, last], axis=1)
            out = {"h": h[row[cuts]], "s": rows["s"].take(pa.array(row[cuts]))}
            out["spans"] = [x.tobytes() for x in np.split(spans, cuts[1:])] if len(cuts) else []
            yield record(out, REPEATS)

    return run


CUTS = pa.schema([("okey", pa.int64()), ("th", pa.int64()), ("spans", pa.binary())])
CUTS_DDL = "okey long, th long, spans binary"


def _cuts(batches):
    """Spans of stretches at all their places, put together by text."""
    for rows in batches:
        if not rows.num_rows:
            continue
        spans = [np.frombuffer(x, np.int64).reshape(-1, 2) for x in rows["spans"].to_pylist()]
        places = [np.frombuffer(x, np.int64).reshape(-1, 3) for x in rows["places"].to_pylist()]
        each = np.concatenate([np.repeat(p, len(s), axis=0) for p, s in zip(places, spans, strict=True)])
        both = np.concatenate([np.tile(s, (len(p), 1)) for p, s in zip(places, spans, strict=True)])
        both = both + each[:, 2:]
        order = np.lexsort((both[:, 0], each[:, 1], each[:, 0]))
        each, both = each[order], both[order]
        new = np.ones(len(each), bool)
        new[1:] = (each[1:, :2] != each[:-1, :2]).any(axis=1)
        cuts = np.flatnonzero(new)
        first, last, doc = _joined(both[:, 0], both[:, 1], np.cumsum(new) - 1)
        ends = np.searchsorted(doc, np.arange(1, len(cuts)))
        out = {"okey": each[cuts, 0], "th": each[cuts, 1]}
        out["spans"] = [x.tobytes() for x in np.split(np.stack([first, last], axis=1), ends)]
        yield record(out, CUTS)


RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.int64())),
        ("kept", pa.binary()),
    ]
)
RESULT_DDL = "doc_id long, n_bytes long, n_removed long, spans array<long>, kept binary"


def _kept(batches):
    for rows in slices(batches):
        data, ends = _bytes(rows["text"])
        sizes = np.diff(ends, prepend=0)
        begins = ends - sizes
        first, last, doc = _spans(rows["spans"])
        order = np.lexsort((first, doc))
        first, last, doc = _joined(first[order], last[order], doc[order])
        edge = np.zeros(len(data) + 1, np.int8)
        np.add.at(edge, begins[doc] + first, 1)
        np.add.at(edge, begins[doc] + last, -1)
        gone = np.cumsum(edge[:-1], dtype=np.int8) > 0
        removed = np.bincount(doc, last - first, minlength=len(sizes)).astype(np.int64)
        offsets = pa.py_buffer(starts(sizes - removed).astype(np.int32))
        out = {"doc_id": rows["doc_id"], "n_bytes": sizes, "n_removed": removed}
        left = pa.py_buffer(data[~gone] if len(first) else np.ascontiguousarray(data))
        out["kept"] = pa.Array.from_buffers(pa.binary(), len(sizes), [None, offsets, left])
        both = pa.array(np.stack([first, last], axis=1).ravel())
        cuts = pa.array(2 * starts(np.bincount(doc, minlength=len(sizes))), pa.int32())
        out["spans"] = pa.ListArray.from_arrays(cuts, both)
        yield record(out, RESULT)


def remove_repeated_strings(docs: DataFrame, string: int = STRING, piece: int = PIECE, crowd: int = CROWD) -> DataFrame:
    """Texts as UTF-8 bytes, without those that a repeated string of ``string`` bytes covers.

    A string is repeated if it also starts at any other place, in the same row or another;
    occurrences may overlap, do not cross rows, and all go. Returns for every row ``doc_id``,
    ``n_bytes``, ``n_removed``, ``spans`` (begin and end of each maximal removed run, flattened)
    and ``kept``, the other bytes put together (binary, as a cut may part a character).

    ``piece`` is the size of an anchor, ``crowd`` the number of different stretches of an anchor
    beyond which they are cut again; neither changes the result. A null text is empty. Repeated
    rows are repeats of each other; ids may be null or repeated. Other columns are not read; an
    empty table gives no rows.
    """
    if not 0 < piece <= string:
        raise ValueError("a piece is a part of a string")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    doc_id, th = F.col("doc_id").cast("long"), F.xxhash64("text")
    keyed = docs.select(doc_id.alias("doc_id"), "text", F.coalesce(doc_id, th).alias("okey"), th.alias("th"))
    found = stage(keyed.select("okey", "text").mapInArrow(_anchors(string, piece), ANCHORS_DDL), "anchors")
    often = found.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    # Rows that share an id share their hits, which is more than each needs.
    hits = found.join(often, "h", "left_semi").groupBy("okey").agg(F.collect_set("h").alias("hits"))
    hits = stage(hits.withColumnRenamed("okey", "zkey"), "shared-anchors")
    release(found)
    # The texts are shuffled once for both joins, by the id alone.
    placed = keyed.repartition(parts, "okey")
    same = (F.col("okey") == F.col("zkey")) & (F.col("th").bitwiseXOR(F.col("zth")) == 0)
    near = placed.hint("merge").join(hits.repartition(parts, "zkey"), F.col("okey") == F.col("zkey"))
    stretches = near.select("okey", "th", "text", "hits").mapInArrow(_shared(string, piece), PLACED_DDL)
    cuts = _all_cuts(stage(stretches, "stretches"), string, crowd, parts)
    cuts = cuts.groupBy("okey", "th").agg(F.collect_list("spans").alias("spans"))
    cuts = cuts.select(F.col("okey").alias("zkey"), F.col("th").alias("zth"), "spans")
    kept = placed.hint("merge").join(cuts.repartition(parts, "zkey"), same, "left")
    return kept.select("doc_id", "text", "spans").mapInArrow(_kept, RESULT_DDL)


def _all_cuts(stretches: DataFrame, string: int, crowd: int, parts: int) -> DataFrame:
    """``okey``, ``th`` and ``spans`` of all repeated strings in ``stretches``."""
    answers = []
    for width in (*FINER, 0):
        different = stretches.select("h", "s").distinct()
        crowded = different.groupBy("h").count().where(F.col("count") > crowd).select("h")
        crowded = stage(crowded, "crowded-anchors") if width else None
        if crowded is None or crowded.isEmpty():
            width = 0
        # Where a stretch stands is not moved.
        each = stretches.select("h", "s", "bytes", "n")
        if width:
            each = each.join(crowded, "h", "left_anti")
        sorted_ = each.repartition(parts, "h").sortWithinPartitions("h", "s")
        spans = stage(sorted_.mapInArrow(_repeats(string), REPEATS_DDL), "repeats")
        met = stretches.select("h", "s", "places").join(spans, ["h", "s"])
        answers.append(met.select("spans", "places").mapInArrow(_cuts, CUTS_DDL))
        if not width:
            break
        again = stretches.join(crowded, "h", "left_semi")
        stretches = stage(again.mapInArrow(_finer(string, width), PLACED_DDL), "finer-stretches")
    return functools.reduce(DataFrame.unionByName, answers)
