"""Near duplicates by SimHash fingerprints, with pigeonring filtering of the candidates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..sources.staging import stage
from .cells import cells, forest, runs
from .components import components
from .text import record, slices, starts, within, words

SHINGLE = 3
SEED = 42
DISTANCE = 3
SEGMENTS = 8
# Hash values whose 64 bits are unpacked at once.
BITS_AT_ONCE = 1 << 18


def fingerprints(texts: pa.Array, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The 64-bit SimHash of every text as unsigned integers; 0 for a text without words."""
    flat, counts = words(pc.ascii_lower(texts))
    n = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    hashes = np.fromiter(_hashes(flat, counts, n, shingle, seed), np.uint64, int(n.sum()))
    bits = np.zeros((len(counts), 64), np.int64)
    doc = np.repeat(np.arange(len(n)), n)
    for begin in range(0, len(hashes), BITS_AT_ONCE):
        part = hashes[begin : begin + BITS_AT_ONCE].byteswap().view(np.uint8).reshape(-1, 8)
        ids = doc[begin : begin + BITS_AT_ONCE]
        heads = np.concatenate([[0], np.flatnonzero(ids[1:] != ids[:-1]) + 1])
        ones = np.unpackbits(part, axis=1)
        bits[ids[heads]] += np.add.reduceat(ones, heads, axis=0, dtype=np.int32)
    return np.packbits(2 * bits > n[:, None], axis=1).view(np.uint64).byteswap().ravel()


def _hashes(flat, counts, n, shingle, seed):
    lengths = pc.binary_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
    # All words joined by one space; a shingle is a piece of it.
    joined = pc.binary_join(
        pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat), " "
    )
    data = joined[0].as_buffer().to_pybytes() if len(flat) else b""
    begin = starts(lengths + 1)[:-1]
    end = begin + lengths
    first = np.repeat(starts(counts)[:-1], n) + within(n)
    last = first + np.repeat(np.minimum(counts, shingle), n) - 1
    digest = xxhash.xxh64_intdigest
    return (
        digest(data[i:j], seed)
        for i, j in zip(begin[first].tolist(), end[last].tolist(), strict=True)
    )


FINGERPRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def _fingerprint(batches):
    for part in slices(batches):
        fp = fingerprints(part["text"]).view(np.int64)
        yield record({"doc_id": part["doc_id"], "fp": fp}, FINGERPRINTS)


def chains() -> list[tuple[int, int]]:
    """Start of a chain of segments, and the bits that two fingerprints must share to follow it.

    With eight segments on a ring and three differing bits, some chain of consecutive segments
    keeps, for every length l, its cumulative difference within floor(3 l / 8): none in the first
    two segments, at most one bit in the three after them. Two of those three are thus equal.
    """
    found = []
    for start in range(SEGMENTS):
        ring = [(start + i) % SEGMENTS for i in range(SEGMENTS)]
        for out in (2, 3, 4):
            equal = [ring[i] for i in range(5) if i != out]
            found.append((start, sum(0xFF << (56 - 8 * s) for s in equal)))
    return found


def chain_holds(differing: np.ndarray, start: np.ndarray | int) -> np.ndarray:
    """Whether the chain from segment ``start`` stays within its budget at every length."""
    bits = np.bitwise_count(differing.byteswap().view(np.uint8).reshape(-1, SEGMENTS))
    ring = (np.asarray(start).reshape(-1, 1) + np.arange(SEGMENTS)) % SEGMENTS
    bits = np.take_along_axis(bits, np.broadcast_to(ring, bits.shape), axis=1)
    budget = (np.arange(1, SEGMENTS + 1) * DISTANCE) // SEGMENTS
    return (np.cumsum(bits, axis=1) <= budget).all(axis=1)


EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])
# Pairs compared at once.
PAIRS = 1 << 18


def _links(batches):
    """Links within each cell; of a cell's links as many as connect the same fingerprints."""
    for table, begins in runs(batches, ["k", "masked", "cell"]):
        fp = table["fp"].to_numpy().view(np.uint64)
        rep, start = table["rep"].to_numpy(), table["k"].to_numpy() // 3
        side = table["side"].to_numpy()
        left, right = [], []
        sizes = np.diff(begins)
        run = np.repeat(np.arange(len(sizes)), sizes)
        mixed = np.add.reduceat(side != side[begins[:-1]][run], begins[:-1]) > 0
        # A cell of two blocks compares across the blocks only.
        for i, j in _pairs(begins, sizes):
            ok = ~mixed[run[i]] | (side[i] != side[j])
            i, j = i[ok], j[ok]
            differing = fp[i] ^ fp[j]
            ok = chain_holds(differing, start[i])
            i, j, differing = i[ok], j[ok], differing[ok]
            ok = np.bitwise_count(differing) <= DISTANCE
            left.append(i[ok])
            right.append(j[ok])
        if left:
            nodes, heads = forest(np.concatenate(left), np.concatenate(right), len(fp))
            yield record({"a": rep[nodes], "b": rep[heads]}, EDGES)


def _pairs(begins, sizes):
    """Index pairs of all runs, some at a time."""
    later = (np.repeat(begins[1:], sizes) - np.arange(begins[-1]) - 1).astype(np.int64)
    place = np.arange(begins[-1])
    ends = np.cumsum(later)
    begin = 0
    while begin < len(later):
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + PAIRS)))
        i = np.repeat(place[begin:end], later[begin:end])
        j = i + 1 + within(later[begin:end])
        if len(i):
            yield i, j
        begin = end


def simhash_groups(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fp`` (64 bits as a long) and ``component_id`` of every row.

    Fingerprints that differ in three bits or fewer are linked; a component is named by its
    smallest ``doc_id``. Rows with one fingerprint count as one node. Large groups of close
    fingerprints are compared in cells of bounded size and yield a spanning forest, not pairs.

    A null text counts as empty; texts without words share fingerprint zero and are linked. Rows
    with a null id get a component like any other, and null only if their component holds no
    other id. Repeated rows come back as often as they came in; an empty table gives no rows.
    """
    ids = docs.select(F.col("doc_id").cast("long"), "text")
    prints = stage(ids.mapInArrow(_fingerprint, "doc_id long, fp long"), "simhash")
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-nodes")
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    keys = F.array(
        *[
            F.struct(
                F.lit(k).alias("k"),
                F.col("fp").bitwiseAND(F.lit(signed(mask)).cast("long")).alias("masked"),
            )
            for k, (_, mask) in enumerate(chains())
        ]
    )
    # The fingerprint itself stands for the node, so that those of null ids link as well.
    keyed = nodes.select("fp", F.col("fp").alias("rep"), F.inline(keys))
    met = cells(keyed, ["k", "masked"], "fp")
    edges = met.mapInArrow(_links, "a long, b long")
    linked = components(edges)
    named = nodes.join(linked, nodes.fp == linked.id, "left").select(
        "fp", "rep", F.coalesce("component", "fp").alias("component")
    )
    named = stage(named, "simhash-nodes")
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "component").select("fp", "component_id")
    return prints.join(stage(named, "simhash-components"), "fp")


def without_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose id names their component in ``simhash_groups``.

    Rows that share an id stay or go together. Rows with a null id stay, as nothing names them.
    """
    kept = simhash_groups(docs).where("doc_id = component_id").select("doc_id").distinct()
    kept = kept.withColumnRenamed("doc_id", "kept_id")
    named = docs.join(kept, docs["doc_id"].cast("long") == kept["kept_id"], "left_semi")
    return named.unionByName(docs.where(docs["doc_id"].isNull()))
