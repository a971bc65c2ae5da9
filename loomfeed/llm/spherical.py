"""Near-duplicate vectors by spherical-cap filters."""

from __future__ import annotations

from math import ceil
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.staging import stage
from .cells import cells, forest, runs
from .components import components
from .text import record, starts

COSINE = 0.95
# Blocks of a product code, caps that a vector lies in on average and at least, and vectors in a cap.
BLOCKS = 3
CAPS = 20
LEAST_CAPS = 8
LOAD = 32
SEED = 11
# Numbers in the largest matrix made at once.
AT_ONCE = 1 << 21
# Pairs whose caps are compared at once.
PAIRS = 1 << 12


def codes(dims: int, per_block: int, blocks: int, seed: int = SEED) -> list[np.ndarray]:
    """For each block of dimensions random unit vectors, the same in every task."""
    make = np.random.default_rng([seed, dims, per_block, blocks])
    out = []
    for width in np.diff(np.linspace(0, dims, blocks + 1).astype(int)):
        rows = make.standard_normal((per_block, width))
        out.append(rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300))
    return out


def caps(unit: np.ndarray, code: list[np.ndarray], threshold: float, least: int) -> list[np.ndarray]:
    """The caps of each row: combinations of one code vector per block with a large enough sum.

    List decoding: a partial combination is followed only while the best of the blocks left
    could still reach the threshold. A row in fewer than ``least`` caps gets its best ones.
    """
    rows, per = unit.shape[0], code[0].shape[0]
    cuts = np.cumsum([0, *(c.shape[1] for c in code)])
    parts = [unit[:, i:j] @ c.T for i, j, c in zip(cuts, cuts[1:], code)]
    out: list[np.ndarray] = [np.empty(0, np.int64)] * rows
    todo, limit = np.arange(rows), np.full(rows, threshold)
    while len(todo):
        for begin in range(0, len(todo), 256):
            some = todo[begin : begin + 256]
            row, total, number = some, np.zeros(len(some)), np.zeros(len(some), np.int64)
            for b, part in enumerate(parts):
                ahead = sum(p.max(axis=1) for p in parts[b + 1 :]) if b + 1 < len(parts) else 0.0
                sums = total[:, None] + part[row]
                reach = sums + (ahead[row][:, None] if b + 1 < len(parts) else 0.0)
                i, j = np.nonzero(reach >= limit[row][:, None])
                row, total, number = row[i], sums[i, j], number[i] * per + j
            size = np.bincount(row, minlength=rows)
            order = np.lexsort((number, -total, row))
            ends = starts(size[some])
            for k, r in enumerate(some):
                got = number[order[ends[k] : ends[k + 1]]]
                enough = size[r] >= least or size[r] >= per ** len(parts)
                if limit[r] < threshold and enough:
                    got = got[:least]
                out[r] = np.sort(got)
            again = (size[some] < least) & (size[some] < per ** len(parts))
            todo[begin : begin + 256] = np.where(again, some, -1)
        todo = todo[todo >= 0]
        limit[todo] -= 0.25 * np.abs(limit[todo]) + 0.25
    return out


ASSIGNED = pa.schema(
    [
        ("node", pa.int64()),
        ("copies", pa.int64()),
        ("dims", pa.int32()),
        ("vector", pa.binary()),
        ("caps", pa.list_(pa.int64())),
    ]
)
ASSIGNED_DDL = "node long, copies long, dims int, vector binary, caps array<long>"


def _assigner(per_block: int, blocks: int, share: float, least: int):
    def assign(batches):
        for batch in batches:
            lists = batch["embedding"]
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            for dims in np.unique(sizes):
                rows = batch.filter(pa.array(sizes == dims))
                flat = rows["embedding"].flatten().to_numpy(zero_copy_only=False)
                matrix = flat.astype(np.float64).reshape(-1, dims)
                scale = np.abs(matrix).max(axis=1, keepdims=True)
                unit = matrix / scale
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                used = min(blocks, int(dims))
                # Sums of the blocks' products have a variance of blocks / dims.
                edge = NormalDist().inv_cdf(1 - min(0.5, share)) * (used / int(dims)) ** 0.5
                found = caps(unit, codes(int(dims), per_block, used), edge, least)
                out = {
                    "node": rows["vec_id"],
                    "copies": rows["copies"],
                    "dims": [int(dims)] * len(found),
                    "vector": [u.tobytes() for u in unit],
                    "caps": [c.tolist() for c in found],
                }
                yield record(out, ASSIGNED)

    return assign


LINKED = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])


def _linker(cosine: float):
    def link(batches):
        for table, begins in runs(batches, ["dims", "cap", "cell"]):
            dims = table["dims"].to_numpy()
            # Vectors of one length lie behind each other; cells do not mix lengths.
            for d in np.unique(dims):
                low, high = np.searchsorted(dims, d, "left"), np.searchsorted(dims, d, "right")
                part = table.slice(low, high - low)
                cuts = begins[(begins >= low) & (begins <= high)] - low
                yield from _cells(part, int(d), cuts.tolist(), cosine)

    return link


def _cells(part: pa.RecordBatch, dims: int, cuts: list[int], cosine: float):
    """Links of each cell: to the first of each connected piece, and counted for each vector.

    A pair that shares several caps counts in the first of them only.
    """
    data = b"".join(part["vector"].to_pylist())
    unit = np.frombuffer(data).reshape(part.num_rows, dims)
    node, side, copies, cap = (part[c].to_numpy() for c in ("node", "side", "copies", "cap"))
    lists = part["caps"]
    at = starts(lists.value_lengths().to_numpy(zero_copy_only=False))
    values = lists.flatten().to_numpy()
    for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
        n = end - begin
        step = max(1, AT_ONCE // n)
        links, left, right, earlier = np.zeros(n, np.int64), [], [], None
        for row in range(begin, end, step):
            near = unit[row : min(row + step, end)] @ unit[row:end].T >= cosine
            i, j = np.nonzero(np.triu(near, 1))
            i, j = i + row - begin, j + row - begin
            if side[begin] != side[end - 1]:
                across = side[begin + i] != side[begin + j]
                i, j = i[across], j[across]
            if not len(i):
                continue
            left.append(i)
            right.append(j)
            if earlier is None:
                earlier = _earlier(values, at[begin : end + 1], cap[begin])
            for k in range(0, len(i), PAIRS):
                a, b = i[k : k + PAIRS], j[k : k + PAIRS]
                shared = (earlier[a][:, :, None] == earlier[b][:, None, :]).any(axis=(1, 2))
                a, b = a[~shared], b[~shared]
                links += np.bincount(a, copies[begin + b], n).astype(np.int64)
                links += np.bincount(b, copies[begin + a], n).astype(np.int64)
        if left:
            nodes, heads = forest(np.concatenate(left), np.concatenate(right), n)
            own = np.flatnonzero(links)
            a = np.concatenate([node[begin + nodes], node[begin + own]])
            b = pa.array([*node[begin + heads].tolist(), *[None] * len(own)], pa.int64())
            count = np.concatenate([np.zeros(len(nodes), np.int64), links[own]])
            yield record({"a": a, "b": b, "links": count}, LINKED)


def _earlier(values: np.ndarray, at: np.ndarray, cap: int) -> np.ndarray:
    """For each row its caps before ``cap``, filled up with numbers that occur once."""
    lists = [values[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]
    lists = [c[: np.searchsorted(c, cap)] for c in lists]
    widest = max(map(len, lists))
    out = -np.arange(1, len(lists) * widest + 1, dtype=np.int64).reshape(len(lists), widest)
    for row, c in zip(out, lists, strict=True):
        row[: len(c)] = c
    return out


def vector_groups(
    vectors: DataFrame, cosine: float = COSINE, caps_: int = CAPS, load: int = LOAD
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row of (vec_id, embedding).

    Equal vectors are combined first. A cap is a direction made of one random code vector per
    block of dimensions; the number of code vectors grows with the number of vectors, so that a
    cap holds about ``load`` of them, and the threshold is set so that a vector lies in about
    ``caps_`` caps. Vectors that share a cap are compared by their cosine, large caps in cells of
    bounded size. Of a pair nothing is kept but its count for each side and a spanning forest.

    Vectors that are null, zero or hold null or non-finite components, and rows without an id,
    link with nothing; their component is their own id. Vectors of different length do not link.
    Rows that share an id count as one vector. Other columns are not read; an empty table gives
    no rows.
    """
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    usable = (
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & ~F.exists("embedding", bad)
        & F.exists("embedding", lambda x: x != 0)
    )
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding").withColumn(
        "usable", F.coalesce(usable, F.lit(False))
    )
    distinct = rows.where("usable").select("embedding", "vec_id").distinct()
    reps = distinct.groupBy("embedding").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")
    )
    reps = stage(reps, "vectors")
    per_block = max(4, ceil((reps.count() * caps_ / load) ** (1 / BLOCKS)))
    share = caps_ / per_block**BLOCKS
    assigned = stage(
        reps.mapInArrow(_assigner(per_block, BLOCKS, share, LEAST_CAPS), ASSIGNED_DDL), "caps"
    )
    keyed = assigned.select("*", F.explode("caps").alias("cap"))
    met = cells(keyed, ["dims", "cap"], "node")
    linked = stage(met.mapInArrow(_linker(cosine), "a long, b long, links long"), "links")
    counts = linked.groupBy("a").agg(F.sum("links").alias("links"))
    named = components(linked.where("b IS NOT NULL").select("a", "b"))
    groups = (
        reps.join(counts, F.col("vec_id") == F.col("a"), "left")
        .join(named, F.col("vec_id") == F.col("id"), "left")
        .select(
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
    )
    groups = stage(groups, "vector-groups")
    linked_rows = rows.where("usable").select("vec_id", "embedding").join(groups, "embedding")
    single = rows.where("NOT usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    both = linked_rows.select("vec_id", "n_links", "component_id").unionByName(single)
    return both.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
