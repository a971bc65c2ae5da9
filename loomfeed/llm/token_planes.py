"""Token ids in files of compressed byte planes.

The file format. A folder holds ``blocks`` and ``index``, both Parquet without compression of its
own. The ids of all documents, in ascending ``doc_id`` order, form one stream, cut into parts
(one per writing task) and each part into blocks of a fixed number of ids. A row of ``blocks`` is
one block: its ids as little-endian unsigned 32-bit integers, transposed so that plane p holds
byte (or bit) p of every id, each plane compressed with zstandard; and the documents in it, with
for each the ids it has before and within this block. A row of ``index`` tells where a block
begins in its part, its number of ids, its first and last document and the size of its planes.
"""

from __future__ import annotations

import zlib
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from ..session import work_dir
from .encoders import byte_level, ended
from .text import record, slices, starts

BLOCK = 1 << 16
LEVEL = 3
# Bytes of text encoded at once.
TEXT_AT_ONCE = 8 << 20

BLOCKS = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int64()),
        ("n_ids", pa.int32()),
        ("planes", pa.list_(pa.binary())),
        ("doc", pa.list_(pa.int64())),
        ("ordinal", pa.list_(pa.int64())),
        ("before", pa.list_(pa.int64())),
        ("inside", pa.list_(pa.int64())),
    ]
)
BLOCKS_DDL = (
    "part int, block long, n_ids int, planes array<binary>, doc array<long>, "
    "ordinal array<long>, before array<long>, inside array<long>"
)
PIECES = pa.schema(
    [
        ("part", pa.int32()),
        ("ordinal", pa.int64()),
        ("doc_id", pa.int64()),
        ("at", pa.int64()),
        ("before", pa.int64()),
        ("length", pa.int64()),
        ("offset", pa.int64()),
        ("crc", pa.int64()),
    ]
)


def to_planes(ids: np.ndarray, bits: bool = False, level: int = LEVEL) -> list[bytes]:
    """The byte planes of ``ids``, or the bit planes of those, each compressed."""
    rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        rows = np.unpackbits(rows, axis=1, bitorder="little")
        planes = [np.packbits(p, bitorder="little") for p in rows.T]
    else:
        planes = list(rows.T)
    pack = zstandard.ZstdCompressor(level=level).compress
    return [pack(np.ascontiguousarray(p).tobytes()) for p in planes]


def from_planes(planes: list[bytes], count: int) -> np.ndarray:
    """The ids again; 4 planes hold bytes, 32 hold bits."""
    unpack = zstandard.ZstdDecompressor().decompress
    rows = [np.frombuffer(unpack(p), np.uint8) for p in planes]
    if len(rows) == 32:
        bits = [np.unpackbits(r, count=count, bitorder="little") for r in rows]
        rows = np.packbits(np.stack(bits, axis=1), axis=1, bitorder="little").T
    return np.ascontiguousarray(np.stack(rows, axis=1)).view("<u4").ravel()


def _writer(path: str, end: int, block: int, bits: bool, level: int):
    def write(batches):
        encoder, part = byte_level(path), TaskContext.get().partitionId()
        held, docs = np.empty(0, np.int32), []  # ids not yet written, and whose they are
        number = ordinal = 0

        def first(count):
            """The block of the first ``count`` ids held."""
            nonlocal held, docs, number
            taken, room = [], count
            while room:
                doc, place, before, inside = docs[len(taken)]
                taken.append((doc, place, before, min(inside, room)))
                room -= taken[-1][3]
            rest = docs[len(taken) :]
            if taken[-1][3] < inside:
                rest.insert(0, (doc, place, before + taken[-1][3], inside - taken[-1][3]))
            out = {"part": [part], "block": [number], "n_ids": [count]}
            out["planes"] = [to_planes(held[:count], bits, level)]
            for k, values in zip(("doc", "ordinal", "before", "inside"), zip(*taken), strict=True):
                out[k] = [list(values)]
            held, docs, number = held[count:], rest, number + 1
            return record(out, BLOCKS)

        for rows in slices(batches, limit=TEXT_AT_ONCE):
            ids, sizes = ended(*encoder.encode(rows["text"]), end)
            for doc, size in zip(rows["doc_id"].to_pylist(), sizes.tolist(), strict=True):
                docs.append((doc, ordinal, 0, size))
                ordinal += 1
            held = np.concatenate([held, ids])
            while len(held) >= block:
                yield first(block)
        if len(held):
            yield first(len(held))

    return write


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    end: int = 2,
    block: int = BLOCK,
    bits: bool = False,
    level: int = LEVEL,
    folder: str | None = None,
) -> str:
    """Writes the ids of all documents, each followed by ``end``, and returns the folder.

    Documents are sorted by id over all parts; null ids come first, rows with the same id follow
    each other by text. A null text counts as empty and yields ``end`` alone. Columns other than
    ``doc_id`` and ``text`` are not read. An empty table gives files without rows.
    """
    folder = folder or f"{work_dir(docs.sparkSession)}/tokens-{uuid4().hex}"
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    parts = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    blocks = parts.mapInArrow(_writer(tokenizer, end, block, bits, level), BLOCKS_DDL)
    blocks.write.option("compression", "none").parquet(f"{folder}/blocks")
    written = docs.sparkSession.read.parquet(f"{folder}/blocks")
    index = written.select(
        "part",
        "block",
        "n_ids",
        F.col("doc")[0].alias("first_doc"),
        F.element_at("doc", -1).alias("last_doc"),
        F.transform("planes", F.octet_length).alias("plane_bytes"),
        F.size("doc").alias("n_docs"),
    )
    index.write.option("compression", "none").parquet(f"{folder}/index")
    return folder


def _reader(keep: bool):
    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = from_planes(row["planes"], row["n_ids"])
                at = starts(np.array(row["inside"], np.int64)).tolist()
                pieces = [ids[i:j].tobytes() for i, j in zip(at, at[1:])]
                out = {
                    "part": [row["part"]] * len(pieces),
                    "ordinal": row["ordinal"],
                    "doc_id": row["doc"],
                    "at": [row["block"]] * len(pieces),
                    "before": row["before"],
                    "length": row["inside"],
                    "offset": at[:-1],
                    "crc": [zlib.crc32(p) for p in pieces],
                }
                schema = PIECES
                if keep:
                    out["ids"], schema = pieces, PIECES.append(pa.field("ids", pa.binary()))
                yield record(out, schema)

    return read


def read_pieces(spark: SparkSession, folder: str, ids: bool = False) -> DataFrame:
    """One row for each document and block: its ids' place, number, checksum, and the ids."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    ddl = "part int, ordinal long, doc_id long, at long, before long, length long, offset long, crc long"
    return blocks.mapInArrow(_reader(ids), ddl + (", ids binary" if ids else ""))


def joined_crc(pieces) -> int:
    """The checksum of consecutive pieces from their own checksums and lengths in bytes.

    For equal lengths the checksum of an exclusive-or is the exclusive-or of three checksums, so
    going on from a state needs zero bytes in place of the data.
    """
    crc = 0
    for size, own in pieces:
        zeros = bytes(size)
        crc = own ^ zlib.crc32(zeros, crc) ^ zlib.crc32(zeros)
    return crc


@pandas_udf(LongType())
def _joined(pieces: pd.Series) -> pd.Series:
    return pieces.map(lambda ps: joined_crc([(4 * int(p["length"]), int(p["crc"])) for p in ps]))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``.

    Blocks are read in any order; a document that lies in several blocks is put together from
    their checksums, a few numbers for each block it touches.
    """
    index = spark.read.parquet(f"{folder}/index")
    in_part = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = index.select(
        "part", F.col("block").alias("at"), F.coalesce(F.sum("n_ids").over(in_part), F.lit(0)).alias("base")
    )
    # One row for each part, so their running sum is small whatever the number of documents.
    sums = index.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("earlier"))
    placed = blocks.join(sums, "part").select("part", "at", (F.col("base") + F.col("earlier")).alias("base"))
    pieces = read_pieces(spark, folder).join(placed, ["part", "at"])
    docs = pieces.groupBy("part", "ordinal").agg(
        F.first("doc_id").alias("doc_id"),
        F.min(F.col("base") + F.col("offset")).alias("start"),
        F.sum("length").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("before", "length", "crc"))).alias("pieces"),
    )
    return docs.select("doc_id", "start", "n_tokens", _joined("pieces").alias("ids_crc32"))
