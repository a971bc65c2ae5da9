"""Repeated passages found with fixed-block anchors.

Every document is cut into blocks of half a window, one after the other, which are the index;
each rolling stretch of that length probes it. A window that occurs twice covers a whole block of
either occurrence, so each occurrence has a probe that hits. Only around hits are windows
compared, by a hash of all their words; runs of repeated windows are the maximal repeats.

Work is exchanged in batches: a unit is what one task reads at once, a bucket a range of hash
values. A unit sends each bucket one binary value with its distinct hashes, so a passage that a
large share of all documents holds counts once for each unit; a bucket answers each unit with the
places that are repeated.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..sources.staging import stage
from .cells import runs
from .text import BASES, gather, record, slices, starts, window_hashes, within, word_hashes, words

WINDOW = 20
# Buckets for each shuffle partition, at least.
BUCKETS = 4

SENT = pa.schema(
    [("bucket", pa.int32()), ("unit", pa.int64()), ("kind", pa.int32()), ("data", pa.binary())]
)
SENT_DDL = "bucket int, unit long, kind int, data binary"
ANSWER = pa.schema([("unit", pa.int64()), ("kind", pa.int32()), ("data", pa.binary())])
ANSWER_DDL = "unit long, kind int, data binary"
FOUND = pa.schema([("okey", pa.int64()), ("th", pa.int64()), ("spans", pa.binary())])
FOUND_DDL = "okey long, th long, spans binary"
ENTRIES, PLACES, DOCS = 0, 1, 2


def packed(*arrays: np.ndarray) -> bytes:
    """Byte planes of arrays of one length; equal high bytes then compress well."""
    planes = [a.view(np.uint8).reshape(len(a), a.itemsize).T for a in map(np.ascontiguousarray, arrays)]
    return b"".join(np.ascontiguousarray(p).tobytes() for p in planes)


def unpacked(data: bytes, *types) -> list[np.ndarray]:
    widths = [np.dtype(t).itemsize for t in types]
    n, at, out = len(data) // sum(widths), 0, []
    for t, width in zip(types, widths, strict=True):
        planes = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
        # A copy even of a single value, so that it can be written to.
        out.append(planes.T.copy(order="C").view(t).ravel())
        at += n * width
    return out


def _unit(sequence: int) -> int:
    return (TaskContext.get().partitionId() << 32) + sequence


def _send(unit: int, bits: int, hashes: np.ndarray, columns, docs, places: np.ndarray):
    """Rows for the buckets (``hashes`` ascending), and one with the unit's documents."""
    heads = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    cuts = np.concatenate([[0], np.searchsorted(hashes, heads), [len(hashes)]])
    full = np.flatnonzero(np.diff(cuts))
    data = [packed(*(c[cuts[b] : cuts[b + 1]] for c in columns)) for b in full]
    n = len(full)
    out = {
        "bucket": [*full.tolist(), unit % (1 << bits), unit % (1 << bits)],
        "unit": [unit] * (n + 2),
        "kind": [ENTRIES] * n + [DOCS, PLACES],
        "data": [*data, packed(*docs), packed(places.astype(np.uint32))],
    }
    return record(out, SENT)


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Whether each of the sorted entries begins a group of equal ones."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return new


def _probes(window: int, bits: int):
    block = window // 2

    def probe(batches):
        for sequence, rows in enumerate(slices(batches)):
            flat, counts = words(rows["text"])
            hashes = window_hashes(word_hashes(flat, BASES[0]), block)
            doc = np.repeat(np.arange(len(counts)), counts)
            place = within(counts)
            ref = np.flatnonzero(doc[: len(hashes)] == doc[block - 1 : block - 1 + len(hashes)])
            # Texts shorter than a window can neither hold nor lose one.
            ref = ref[counts[doc[ref]] >= window]
            order = np.argsort(hashes[ref], kind="stable")
            ref = ref[order]
            hashes = hashes[ref]
            head = _heads(hashes) if len(hashes) else np.zeros(0, bool)
            group = np.cumsum(head) - 1
            size = np.bincount(group, minlength=0)
            anchor = place[ref] % block == 0
            anchors = np.bincount(group, anchor, minlength=len(size)) > 0
            repeated = ref[size[group] > 1] if len(ref) else ref
            low = (hashes[head] >> np.uint64(32 - bits)).astype(np.uint32)
            mark = (ref[head] * 2 + anchors).astype(np.uint64)
            docs = (rows["okey"].to_numpy(), rows["th"].to_numpy(), counts.astype(np.int64))
            yield _send(_unit(sequence), bits, hashes[head], (low, mark), docs, repeated)

    return probe


def _match_anchors(table):
    unit, ref, anchor, hashed = [], [], [], []
    for u, data in zip(table["unit"].to_pylist(), table["data"].to_pylist(), strict=True):
        low, mark = unpacked(data, np.uint32, np.uint64)
        unit.append(np.full(len(low), u))
        ref.append(mark >> np.uint64(1))
        anchor.append((mark & np.uint64(1)).astype(bool))
        hashed.append(low)
    unit, ref, anchor, hashed = map(np.concatenate, (unit, ref, anchor, hashed))
    order = np.argsort(hashed, kind="stable")
    group = np.cumsum(_heads(hashed[order])) - 1
    others = np.bincount(group, anchor[order])[group] - anchor[order]
    hit = order[others > 0]
    return unit[hit], ref[hit]


def _match_windows(table):
    """Of equal windows all but the first, by document and then by unit."""
    parts, unit = [], []
    for u, data in zip(table["unit"].to_pylist(), table["data"].to_pylist(), strict=True):
        parts.append(unpacked(data, np.uint64, np.uint16, np.int64, np.uint64))
        unit.append(np.full(len(parts[-1][0]), u))
    high, low, okey, ref = (np.concatenate(c) for c in zip(*parts, strict=True))
    unit = np.concatenate(unit)
    order = np.lexsort((unit, okey, low, high))
    later = order[~_heads(high[order], low[order])]
    return unit[later], ref[later]


def _matcher(match):
    def run(batches):
        for table, begins in runs(batches, ["bucket"]):
            for begin, end in zip(begins[:-1], begins[1:], strict=True):
                part = table.slice(begin, end - begin)
                kind = part["kind"].to_numpy()
                passed = part.filter(pa.array(kind != ENTRIES))
                if passed.num_rows:
                    yield passed.select(["unit", "kind", "data"])
                part = part.filter(pa.array(kind == ENTRIES))
                if not part.num_rows:
                    continue
                unit, ref = match(part)
                order = np.argsort(unit, kind="stable")
                unit, ref = unit[order], ref[order]
                cuts = np.flatnonzero(_heads(unit)) if len(unit) else np.zeros(0, np.int64)
                data = [packed(np.sort(r).astype(np.uint32)) for r in np.split(ref, cuts[1:])]
                if len(unit):
                    out = {"unit": unit[cuts], "kind": [PLACES] * len(cuts), "data": data}
                    yield record(out, ANSWER)

    return run


def _joined(first: np.ndarray, last: np.ndarray, doc: np.ndarray):
    """Overlapping or touching spans (sorted by document and begin) put together."""
    if not len(first):
        return first, last, doc
    # The furthest end so far within a document, made comparable by an offset for each.
    far = np.int64(1) << 40
    reach = np.maximum.accumulate(last + doc * far) - doc * far
    new = np.ones(len(first), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (first[1:] > reach[:-1])
    heads = np.flatnonzero(new)
    return first[heads], np.maximum.reduceat(reach, heads), doc[heads]


def _resolver(before: int, after: int, window: int):
    """Places of a unit as spans of its documents: from ``before`` ahead to ``after`` behind."""

    def run(batches):
        for table, begins in runs(batches, ["unit"]):
            for begin, end in zip(begins[:-1], begins[1:], strict=True):
                part = table.slice(begin, end - begin)
                kinds, data = part["kind"].to_pylist(), part["data"].to_pylist()
                okey, th, counts = unpacked(data[kinds.index(DOCS)], np.int64, np.int64, np.int64)
                refs = [unpacked(d, np.uint32)[0] for k, d in zip(kinds, data) if k == PLACES]
                ref = np.unique(np.concatenate(refs)).astype(np.int64)
                if not len(ref):
                    continue
                at = starts(counts)
                doc = np.searchsorted(at, ref, "right") - 1
                place = ref - at[doc]
                first = np.maximum(place - before, 0)
                last = np.minimum(place + after, counts[doc])
                first, last, doc = _joined(first, last, doc)
                cuts = np.flatnonzero(_heads(doc))
                spans = np.stack([first, last], axis=1).astype("<i8")
                out = {"okey": okey[doc[cuts]], "th": th[doc[cuts]]}
                out["spans"] = [s.tobytes() for s in np.split(spans, cuts[1:])]
                yield record(out, FOUND)

    return run


def _spans(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins, ends and row numbers of the spans in a column of binaries, or of lists of them."""
    values = [b"".join(v) if isinstance(v, list) else (v or b"") for v in column.to_pylist()]
    sizes = np.fromiter((len(v) // 16 for v in values), np.int64, len(values))
    both = np.frombuffer(b"".join(values), "<i8").reshape(-1, 2)
    return both[:, 0], both[:, 1], np.repeat(np.arange(len(values)), sizes)


def _windows(window: int, bits: int):
    def send(batches):
        previous = None
        for sequence, rows in enumerate(slices(batches)):
            okey, th = rows["okey"].to_numpy(), rows["th"].to_numpy()
            # Rows with the same id and text follow each other; one of them is enough.
            key = list(zip(okey.tolist(), th.tolist(), strict=True))
            new = [k != p for k, p in zip(key, [previous, *key[:-1]], strict=True)]
            previous = key[-1]
            rows = rows.filter(pa.array(new))
            if not rows.num_rows:
                continue
            okey, th = rows["okey"].to_numpy(), rows["th"].to_numpy()
            flat, counts = words(rows["text"])
            at = starts(counts)
            first, last, doc = _spans(rows["spans"])
            # Starts of the windows within the spans.
            sizes = np.maximum(last - first - window + 1, 0)
            ref = np.unique(gather(at[doc] + first, sizes))
            high, low = (window_hashes(word_hashes(flat, b), window) for b in BASES)
            high, low = high[ref], (low[ref] >> np.uint64(48)).astype(np.uint16)
            order = np.lexsort((low, high))
            high, low, ref = high[order], low[order], ref[order]
            head = _heads(high, low) if len(ref) else np.zeros(0, bool)
            owner = okey[np.searchsorted(at, ref, "right") - 1]
            columns = (high[head], low[head], owner[head], ref[head].astype(np.uint64))
            docs = (okey, th, counts.astype(np.int64))
            yield _send(_unit(sequence), bits, high[head], columns, docs, ref[~head])

    return send


RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.int64())),
        ("kept_text", pa.string()),
    ]
)
RESULT_DDL = "doc_id long, n_words long, n_removed long, spans array<long>, kept_text string"
DIGEST = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
)
DIGEST_DDL = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _left(flat: pa.Array, counts: np.ndarray, column):
    """Texts without the spans of ``column``, words removed from each, and the spans."""
    at = starts(counts)
    first, last, doc = _spans(column)
    # +1 where a removed span begins, -1 where it ends; spans do not overlap.
    edge = np.zeros(len(flat) + 1, np.int8)
    np.add.at(edge, at[doc] + first, 1)
    np.add.at(edge, at[doc] + last, -1)
    gone = np.cumsum(edge[:-1], dtype=np.int8) > 0
    total = np.concatenate([[0], np.cumsum(gone)])
    removed = np.diff(total[at])
    left = flat.filter(pa.array(~gone)) if gone.any() else flat
    lists = pa.ListArray.from_arrays(pa.array(starts(counts - removed), pa.int32()), left)
    return pc.binary_join(lists, " "), removed, first, last, doc


def _kept(digest: bool):
    def run(batches):
        for rows in slices(batches):
            flat, counts = words(rows["text"])
            text, removed, first, last, doc = _left(flat, counts, rows["spans"])
            out = {"doc_id": rows["doc_id"], "n_words": counts, "n_removed": removed}
            if digest:
                out["kept_sha256"] = [hashlib.sha256(t.as_buffer()).hexdigest() for t in text]
                yield record(out, DIGEST)
            else:
                spans = np.stack([first, last], axis=1).tolist()
                sizes = np.bincount(doc, minlength=len(counts))
                cuts = starts(sizes)
                out["spans"] = [sum(spans[i:j], []) for i, j in zip(cuts[:-1], cuts[1:])]
                out["kept_text"] = text
                yield record(out, RESULT)

    return run


def _cut(docs: DataFrame, window: int) -> DataFrame:
    """All columns of ``docs`` in a struct ``row``, with ``text`` and the ``spans`` to remove."""
    if window < 2:
        raise ValueError("a window has two words or more")
    block = window // 2
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(1, (BUCKETS * parts - 1).bit_length())
    th, doc_id = F.xxhash64("text"), F.col("doc_id").cast("long")
    null = F.lit((1 << 63) - 1) - F.pmod(th, F.lit(1 << 40))
    rest = [c for c in docs.columns if c != "text"]
    keyed = docs.select(
        F.struct(*rest).alias("row"), "text", F.coalesce(doc_id, null).alias("okey"), th.alias("th")
    )

    def answered(sent, match, before, after):
        met = sent.repartition(parts, "bucket").sortWithinPartitions("bucket", "unit")
        answers = met.mapInArrow(_matcher(match), ANSWER_DDL)
        answers = answers.repartition(parts, "unit").sortWithinPartitions("unit")
        return answers.mapInArrow(_resolver(before, after, window), FOUND_DDL)

    sent = keyed.select("okey", "th", "text").mapInArrow(_probes(window, bits), SENT_DDL)
    # A window with a hit at its first or its last possible place.
    hits = answered(sent, _match_anchors, window - block, window)
    near = stage(hits, "near-repeats").select(
        F.col("okey").alias("zkey"), F.col("th").alias("zth"), "spans"
    )
    near = near.repartition(parts, "zkey").groupBy("zkey", "zth").agg(
        F.collect_list("spans").alias("spans")
    )
    # Both joins below read the same columns, and so the same shuffle, of the texts. They match on
    # the id alone, with the text's hash as a further condition, so that rows with one id stay in
    # one task, in order.
    placed = keyed.repartition(parts, "okey")
    same = (F.col("okey") == F.col("zkey")) & (F.col("th").bitwiseXOR(F.col("zth")) == 0)
    columns = ["row", "text", "okey", "th", "spans"]
    around = placed.hint("merge").join(near, same).sortWithinPartitions("okey", "th")
    sent = around.select(*columns).mapInArrow(_windows(window, bits), SENT_DDL)
    cuts = answered(sent, _match_windows, 0, window).select(
        F.col("okey").alias("zkey"), F.col("th").alias("zth"), "spans"
    )
    kept = placed.hint("merge").join(cuts.repartition(parts, "zkey"), same, "left")
    return kept.select(*columns)


def remove_repeats(docs: DataFrame, window: int = WINDOW, digest: bool = False) -> DataFrame:
    """Documents without words that a window covers whose words also start earlier.

    Earlier is a smaller ``doc_id``, or an earlier start in the same document. Returns for every
    row ``doc_id``, ``n_words``, ``n_removed``, and ``spans`` (begin and end, in words, of each
    maximal removed stretch, flattened) with ``kept_text`` (kept words joined by one space), or
    with ``digest`` their SHA-256 in place of both.

    Words are runs without ASCII white space, unchanged; a null text has none. Rows with the same
    id and text count as one document and get the same result; rows with one id and different
    texts are ordered by a hash of the text. Null ids come after all others, ordered by that hash.
    Other columns are not read; an empty table gives no rows.
    """
    kept = _cut(docs.select("doc_id", "text"), window).select(
        F.col("row.doc_id").cast("long").alias("doc_id"), "text", "spans"
    )
    return kept.mapInArrow(_kept(digest), DIGEST_DDL if digest else RESULT_DDL)


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """All columns of ``docs``, with ``text`` reduced as by ``remove_repeats``.

    A text that loses no word stays as it is, null included; one that loses all its words goes.
    """
    schema = docs.schema
    columns = [F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    rows = _cut(docs, window)
    cuts = "spans_" + "_".join(docs.columns)  # a name that no column has
    # Only rows that lose words pass through Python.
    cut = rows.where("spans IS NOT NULL").select(*columns, F.col("spans").alias(cuts))
    cut = cut.mapInArrow(_shortened(docs.columns, cuts), schema)
    return rows.where("spans IS NULL").select(*columns).unionByName(cut)


def _shortened(columns: list[str], cuts: str):
    def run(batches):
        for rows in slices(batches):
            flat, counts = words(rows["text"])
            text, removed, _, _, _ = _left(flat, counts, rows[cuts])
            some = pa.array(counts > removed)
            place = rows.schema.get_field_index("text")
            rows = rows.set_column(place, "text", text).select(columns)
            yield rows.filter(some)

    return run
