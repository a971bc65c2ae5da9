"""Groups of any size cut into cells of bounded size, and their rows read as runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.staging import stage

BLOCK = 1024


def cells(rows: DataFrame, keys: list[str], member: str, block: int = BLOCK) -> DataFrame:
    """Rows of groups with two members or more, once for each cell they belong to.

    A group of up to ``block`` rows is one cell. A larger one is dealt into blocks by a hash of
    ``member``, and every two blocks form a cell, so that any two rows meet in exactly one cell
    (two rows of one block: in the cell of that block with itself). Rows come back partitioned
    by cell and sorted, with ``cell`` and ``side`` (the row's block).
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("rows_")).where("rows_ > 1")
    full = rows.join(stage(counts, "group-sizes"), keys)
    blocks = F.ceil(F.col("rows_") / block)
    side = F.pmod(F.xxhash64(member), blocks).cast("int").alias("side")
    full = full.withColumn("blocks_", blocks).withColumn("side", side)
    other = F.explode(F.sequence(F.lit(0), (F.col("blocks_") - 1).cast("int")))
    full = full.withColumn("other_", other)
    low, high = F.least("side", "other_"), F.greatest("side", "other_")
    full = full.withColumn("cell", low.cast("long") * (1 << 31) + high)
    full = full.drop("rows_", "blocks_", "other_")
    return full.repartition(*keys, "cell").sortWithinPartitions(*keys, "cell", "side")


def runs(batches, keys: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Whole runs of equal ``keys``, and where each begins (with the end as last)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        change = np.zeros(table.num_rows, bool)
        for key in keys:
            values = table[key].to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
        begins = np.flatnonzero(change)
        if len(begins):
            last = int(begins[-1])
            yield table.slice(0, last), np.concatenate([[0], begins])
            held = [table.slice(last)]
        else:
            held = [table]
    if held:
        table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        change = np.zeros(table.num_rows, bool)
        for key in keys:
            values = table[key].to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
        yield table, np.concatenate([[0], np.flatnonzero(change), [table.num_rows]])


def forest(left: np.ndarray, right: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """From links among ``size`` nodes, one link of each node to the first of its component."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    nodes = np.flatnonzero(label != np.arange(size))
    return nodes, label[nodes]
