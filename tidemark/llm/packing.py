"""Operator 11: packing by power-of-two decomposition.

A document's ids, closed by the end id, are cut into as many pieces of ``max_length`` ids as
fit and then into the powers of two that its remainder is made of, longest first. Pieces of
one length form a bucket; a piece is a training sequence of its own, so no sequence crosses
documents and none is padded. A batch takes ``batch_tokens`` ids of one bucket.

Tasks encode the texts where they are read; nothing is shuffled. Sequences are written as a
Parquet table of bucket, part, place in the part, and ids (little-endian unsigned 32-bit);
numbers come from one count per bucket and part of the written table, so they stay the same
for all readers of it and survive lost executors.

Defined results: a null or empty text holds only the end id and is one sequence of length
one; null, equal and repeated doc_ids are separate documents; an empty table gives no
sequences; long documents are cut like others; other columns, whatever their names, are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import gathered, stage
from tidemark.llm.encoding import encoder, end_each, ship
from tidemark.session import work_path


def decompose(lengths: np.ndarray, max_length: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of all documents' pieces, one document after another, and the document of each."""
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("the longest piece must be a power of two")
    powers = max_length >> np.arange(max_length.bit_length())
    counts = np.concatenate([lengths[:, None] // max_length, (lengths[:, None] & powers[1:]) > 0], axis=1).astype(np.int64)
    pieces = np.repeat(np.tile(powers, len(lengths)), counts.ravel())
    return pieces, np.repeat(np.arange(len(lengths)), counts.sum(axis=1))


def write_sequences(docs: DataFrame, path: str, tokenizer: str, max_length: int = 1024, end_id: int = 0, id_col: str = "doc_id",
                    text_col: str = "text") -> None:
    """Encode all texts and write their pieces as sequences to ``path``."""
    shipped = ship(docs.sparkSession, tokenizer)

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        enc, part = encoder(shipped.value), TaskContext.get().partitionId()
        met = np.zeros(max_length.bit_length(), np.int64)   # sequences of each bucket so far
        for b in gathered(batches):
            ids, lengths = end_each(enc.encode_all(b.column(1)), end_id)
            pieces, doc = decompose(lengths, max_length)
            ends = np.cumsum(pieces)
            bucket = np.log2(pieces).astype(np.int32)
            place = np.empty(len(pieces), np.int64)
            for k in np.unique(bucket):
                hit = bucket == k
                n = int(hit.sum())
                place[hit] = met[k] + np.arange(n)
                met[k] += n
            starts = ends - pieces - (np.cumsum(lengths) - lengths)[doc]
            offsets = np.concatenate([[0], ends * 4]).astype(np.int64)
            payload = pa.Array.from_buffers(pa.large_binary(), len(pieces), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u4"))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket), pa.array(np.full(len(pieces), part, np.int32)), pa.array(place), b.column(0).take(pa.array(doc)),
                 pa.array(starts), pa.array(lengths[doc]), payload.cast(pa.binary())],
                ["bucket", "part", "place", "doc_id", "start", "doc_tokens", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).cast("string").alias("t"))
    rows = rows.mapInArrow(cut, "bucket int, part int, place long, doc_id long, start long, doc_tokens long, ids binary")
    rows.write.option("compression", "zstd").parquet(path)


def read_sequences(spark: SparkSession, path: str, batch_tokens: int = 1 << 20, max_broadcast: int = 1_000_000) -> DataFrame:
    """The written sequences: sequence_id (gapless from 0, long buckets first), bucket, batch, doc_id, start, length, doc_tokens, ids.

    Batches hold sequences of one length and ``batch_tokens`` ids, the last of a bucket fewer.
    """
    seqs = spark.read.parquet(path)
    counts = seqs.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("in_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # one row per bucket: a dozen at most, whatever the input
    sizes = counts.groupBy("bucket").agg(F.sum("n").alias("size"))
    longer = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("bucket", F.coalesce(F.sum("size").over(longer), F.lit(0)).alias("base"))
    counts = stage(counts.join(F.broadcast(sizes), "bucket").drop("n"), "sequence-counts")
    # a dozen rows per part: beside the ids, which then stay where they are, unless there are very many parts
    counts = F.broadcast(counts) if counts.count() <= max_broadcast else counts
    length = F.expr("shiftleft(1L, bucket)")
    rank = F.col("in_bucket") + F.col("place")
    return seqs.join(counts, ["bucket", "part"]).select(
        (F.col("base") + rank).alias("sequence_id"), "bucket",
        F.floor(rank / F.greatest(F.lit(1).cast("long"), F.floor(F.lit(batch_tokens) / length))).alias("batch"),
        "doc_id", "start", length.alias("length"), "doc_tokens", "ids")


def pack_sequences(docs: DataFrame, tokenizer: str, path: str | None = None, **options) -> DataFrame:
    """Write the sequences of ``docs`` and read them back; one row per sequence, which is one piece."""
    spark = docs.sparkSession
    path = path or work_path(spark, "llm", "sequences")
    write_sequences(docs, path, tokenizer, **options)
    return read_sequences(spark, path)
