"""Token files: ids in the fewest bits that hold the vocabulary, in blocks of whole documents.

A file is a Parquet table, so that Spark writes it with its usual commit and any executor may be lost.
One row is a block: its documents, their offsets in the block, the ids before it in its shard, and the
packed ids.  Shards ascend by document id and are written by one task each.  An id is found from its
position alone: shard totals give the shard, ``first`` the block, and ``bits`` the byte.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratagrid.llm.tokens import encoder, vocabulary_path
from stratagrid.scratch import scratch_dir

BLOCK_IDS = 1 << 16
_FILE = ("shard long, block long, first long, n_ids long, bits int, doc_ids array<long>, "
         "doc_offsets array<long>, payload binary")


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    """Little-endian bit stream of ``bits`` bits per id."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(spread.reshape(-1), bitorder="little").tobytes()


def unpack_ids(payload: bytes, bits: int, first: int, n: int) -> np.ndarray:
    """``n`` ids from position ``first`` on; only their bytes are touched."""
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", n, first * bits // 8).astype("<u4")
    begin, end = first * bits, (first + n) * bits
    raw = np.frombuffer(payload, np.uint8)[begin // 8:-(-end // 8)]
    stream = np.unpackbits(raw, bitorder="little")[begin % 8:begin % 8 + n * bits].reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = stream
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(n)


def write_tokens(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                 vocabulary: str | None = None, end_id: int = 0, block_ids: int = BLOCK_IDS) -> None:
    """Encode every text and write its ids and ``end_id`` in ascending order of document id.

    A null text is empty; null ids come first and rows that repeat an id are ordered by text.  A block
    ends with the document that brings it to ``block_ids``.  Other columns are ignored.
    An empty table gives a file without blocks.
    """
    vocabulary = vocabulary_path(vocabulary)
    end = end_id.to_bytes(4, "little")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        bits = bits_for(max(encode.vocabulary, end_id + 1))
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        names, offsets, held = [], [0], []

        def close() -> pa.RecordBatch:
            nonlocal block, first
            ids = np.frombuffer(b"".join(held), "<u4")
            row = pa.RecordBatch.from_pylist([{
                "shard": shard, "block": block, "first": first, "n_ids": len(ids), "bits": bits,
                "doc_ids": list(names), "doc_offsets": list(offsets), "payload": pack_ids(ids, bits)}], schema=_arrow())
            block, first = block + 1, first + len(ids)
            names.clear(), held.clear(), offsets.clear()
            offsets.append(0)
            return row

        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode.encode(body.as_py() or "") + end
                names.append(name)
                held.append(ids)
                offsets.append(offsets[-1] + len(ids) // 4)
                if offsets[-1] >= block_ids:
                    yield close()
        if names:
            yield close()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    # packed ids do not compress
    ordered.mapInArrow(pack, _FILE).write.option("compression", "none").parquet(path)


def _arrow() -> pa.Schema:
    longs = pa.list_(pa.int64())
    return pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()),
                      ("bits", pa.int32()), ("doc_ids", longs), ("doc_offsets", longs), ("payload", pa.binary())])


def _bases(blocks: DataFrame) -> DataFrame:
    """``shard, ids, base``: ids of each shard and of all before it.  One row per task that wrote the file."""
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_range(spark: SparkSession, path: str, begin: int, end: int) -> DataFrame:
    """Ids ``begin`` to ``end - 1`` of a token file as ``start, n_ids, ids``, a row per block that holds some.

    The shard totals tell the first and last shard, so that only their files and those between are
    opened; ``first`` tells the blocks, and of these only the bytes of the range are unpacked.  ``ids`` are
    little-endian 32-bit integers from position ``start`` on.  What lies outside the file is left out.
    """
    blocks = spark.read.parquet(path)
    inside = (F.col("base") < end) & (F.col("base") + F.col("ids") > begin)
    low, high = _bases(blocks).filter(inside).agg(F.min_by(F.struct("shard", "base"), "shard"),
                                                  F.max_by(F.struct("shard", "base"), "shard")).first()
    schema = "start long, n_ids long, ids binary"
    if low is None or begin >= end:
        return spark.createDataFrame([], schema)
    touched = blocks.filter(F.col("shard").between(low["shard"], high["shard"])).filter(
        (F.col("shard") > low["shard"]) | (F.col("first") + F.col("n_ids") > begin - low["base"])).filter(
        (F.col("shard") < high["shard"]) | (F.col("first") < end - high["base"]))
    placed = touched.join(F.broadcast(_bases(blocks).filter(inside)), "shard")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                start = max(begin, row["at"])
                n = min(end, row["at"] + row["n_ids"]) - start
                ids = unpack_ids(row["payload"], row["bits"], start - row["at"], n)
                yield pa.record_batch([pa.array([start]), pa.array([n]), pa.array([ids.tobytes()])], ["start", "n_ids", "ids"])

    return placed.select((F.col("base") + F.col("first")).alias("at"), "n_ids", "bits", "payload").mapInArrow(unpack, schema)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` per document from a token file.

    ``start`` counts the ids of all documents before it; ``ids`` are little-endian 32-bit integers.
    """
    blocks = spark.read.parquet(path)
    bases = _bases(blocks).drop("ids")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack_ids(row["payload"], row["bits"], 0, row["n_ids"])
                cuts = row["doc_offsets"]
                spans = list(zip(cuts[:-1], cuts[1:]))
                yield pa.record_batch([
                    pa.array([row["shard"]] * len(spans), pa.int64()), pa.array(row["doc_ids"], pa.int64()),
                    pa.array([row["first"] + a for a, _ in spans], pa.int64()),
                    pa.array([b - a for a, b in spans], pa.int64()),
                    pa.array([ids[a:b].tobytes() for a, b in spans], pa.binary()),
                ], ["shard", "doc_id", "inner", "n_tokens", "ids"])

    unpacked = blocks.select("shard", "first", "n_ids", "bits", "doc_ids", "doc_offsets", "payload").mapInArrow(
        unpack, "shard long, doc_id long, inner long, n_tokens long, ids binary")
    return unpacked.join(F.broadcast(bases), "shard").select(
        "doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids")


def token_file(docs: DataFrame, **options) -> str:
    """Write a token file into the shared folder and return its path."""
    path = f"{scratch_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, **options)
    return path
