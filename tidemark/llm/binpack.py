"""Operator 3: token ids in fixed-width bit packing.

Each id takes the minimum number of bits for the vocabulary. A file set is a Parquet
table of blocks, so that Spark's commit keeps attempts of lost tasks out and any store
that Spark reaches can hold it; a block's payload is self-contained bytes:

    magic 'TMP1' | u8 bits | 3 zero bytes | u32 documents | u64 ids
    | i64 doc_id per document | u8 null mark per document | u64 offset per document, and the end
    | ids, packed little-endian, ``bits`` each

Offsets count ids inside the block; a document's ids are found at offset x bits. Blocks
stand in ascending document order by (part, block).

Defined results: a null text is encoded as empty and holds only the end id; null doc_ids
come first; repeated doc_ids are separate documents ordered by a hash of the text; an
empty table gives no blocks; long documents make long blocks of their own; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import gathered, slices
from tidemark.llm.encoding import encoder, ship
from tidemark.session import work_path

MAGIC = b"TMP1"
HEAD = struct.Struct("<4sB3xIQ")
BLOCK_IDS = 1 << 18

def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Little-endian bit packing."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    out = []
    for i in range(0, len(ids), 1 << 16):  # a multiple of 8 ids: pieces end on whole bytes
        x = ids[i:i + (1 << 16)].astype(np.uint64)
        out.append(np.packbits(((x[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8),
                               bitorder="little").tobytes())
    return b"".join(out)


def unpack(buf, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids start..stop of a packed buffer, without touching the others."""
    if bits in (8, 16, 32):
        w = bits // 8
        return np.frombuffer(buf, f"<u{w}", stop - start, start * w).astype(np.uint32)
    first, last = start * bits // 8, -(-stop * bits // 8)
    raw = np.unpackbits(np.frombuffer(buf, np.uint8, last - first, first), bitorder="little")
    raw = raw[start * bits - first * 8:][:(stop - start) * bits].reshape(-1, bits).astype(np.uint32)
    return raw @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


def make_block(doc_ids: list, ids: list[np.ndarray], bits: int) -> bytes:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype("<u8")
    return b"".join([
        HEAD.pack(MAGIC, bits, len(ids), int(offsets[-1])),
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        offsets.tobytes(), pack(np.concatenate(ids) if ids else np.zeros(0, np.uint32), bits)])


def open_block(payload: bytes) -> tuple[int, list, np.ndarray, memoryview]:
    """bits, doc_ids, offsets and the packed ids of a block."""
    magic, bits, n, _ = HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a block of packed ids")
    at = HEAD.size
    doc_ids = np.frombuffer(payload, "<i8", n, at)
    null = np.frombuffer(payload, np.uint8, n, at + 8 * n)
    offsets = np.frombuffer(payload, "<u8", n + 1, at + 9 * n).astype(np.int64)
    return bits, [None if z else int(d) for d, z in zip(doc_ids, null)], offsets, memoryview(payload)[at + 9 * n + 8 * (n + 1):]


def write_packed(docs: DataFrame, path: str, tokenizer: str, vocabulary: int, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Encode all texts in ascending id order and write the block table to ``path``."""
    bits, shipped = bits_for(vocabulary), ship(docs.sparkSession, tokenizer)

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        enc, part, no = encoder(shipped.value), TaskContext.get().partitionId(), 0
        end = np.array([end_id], np.uint32)
        held: list[tuple] = []
        size = 0

        def block():
            payload = make_block([d for d, _ in held], [x for _, x in held], bits)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([no], pa.int64()), pa.array([next((d for d, _ in held if d is not None), None)], pa.int64()),
                pa.array([held[-1][0]], pa.int64()), pa.array([len(held)], pa.int64()), pa.array([size], pa.int64()),
                pa.array([payload], pa.binary())], ["part", "block", "first_id", "last_id", "n_docs", "n_ids", "payload"])

        for b in gathered(batches):
            for d, x in zip(b.column(0).to_pylist(), enc.encode_all(b.column(1))):
                ids = np.concatenate([x, end])
                held.append((d, ids))
                size += len(ids)
                if size >= BLOCK_IDS:
                    yield block()
                    held, size, no = [], 0, no + 1
        if held:
            yield block()

    d = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("t"))
    h = F.xxhash64("t")
    d = d.withColumn("h", h).repartitionByRange("d", "h").sortWithinPartitions("d", "h").select("d", "t")
    blocks = d.mapInArrow(encode, "part int, block long, first_id long, last_id long, n_docs long, n_ids long, payload binary")
    # packed ids hardly compress; blocks are read whole
    blocks.write.option("compression", "none").option("parquet.block.size", 16 << 20).parquet(path)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32, part, block."""
    blocks = spark.read.parquet(path)
    per = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    heads = blocks.select("part", "block", "n_ids")
    parts = heads.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("part_start"))
    starts = heads.withColumn("in_part", F.coalesce(F.sum("n_ids").over(per), F.lit(0))).join(parts, "part")
    starts = starts.select("part", "block", (F.col("part_start") + F.col("in_part")).alias("block_start"))

    def decode(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in slices(batches, 1):
            bits, doc_ids, offsets, packed = open_block(b.column(2)[0].as_py())
            sums = [zlib.crc32(unpack(packed, bits, i, j).astype("<u4").tobytes())
                    for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            n = len(doc_ids)
            yield pa.RecordBatch.from_arrays([
                pa.array([b.column(0)[0].as_py()] * n, pa.int32()), pa.array([b.column(1)[0].as_py()] * n, pa.int64()),
                pa.array(doc_ids, pa.int64()), pa.array(offsets[:-1], pa.int64()), pa.array(np.diff(offsets), pa.int64()),
                pa.array(sums, pa.int64())], ["part", "block", "doc_id", "at", "n_tokens", "ids_crc32"])

    rows = blocks.select("part", "block", "payload").mapInArrow(
        decode, "part int, block long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(starts, ["part", "block"]).select(
        "doc_id", (F.col("block_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "part", "block")


def document_ids(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """Random access: the ids of one document (of each that has this id).

    Block ranges prune the files read; inside a block only that document is unpacked.
    """
    hit = spark.read.parquet(path).where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
    out = []
    for row in hit.sort("part", "block").select("payload").toLocalIterator():
        bits, doc_ids, offsets, packed = open_block(bytes(row[0]))
        out += [unpack(packed, bits, int(offsets[i]), int(offsets[i + 1])) for i, d in enumerate(doc_ids) if d == doc_id]
    return out


def tokenize_to_files(docs: DataFrame, tokenizer: str, vocabulary: int, path: str | None = None, **options) -> DataFrame:
    """Write ``docs`` as packed ids and return one row per document, read back from the files."""
    spark = docs.sparkSession
    path = path or work_path(spark, "llm", "packed-ids")
    write_packed(docs, path, tokenizer, vocabulary, **options)
    return read_packed(spark, path)
