"""Operator 12: ranked lexical search, accumulator-limited term at a time.

Items (the queries) are taken in blocks of bounded bytes. For a block, one pass over all
documents counts documents, terms and how many documents hold each query term. A second
pass ranks: a task gathers a segment of documents, makes postings of the query terms, and
for every item goes through its terms, rarest first. A term's postings open accumulators
until the most that the terms still to come can add is below the k-th partial score (or
the k-th score that the task has already met); from then on only open accumulators are
updated, each exactly, so the k highest scores are exact. What leaves a task is k rows an item at most;
they are merged by rank in two steps, the first within groups of tasks.

No text and no posting is shuffled; a task holds one segment (``segment_bytes``) and k rows
an item. A block of items is held by the driver and every task, ``block_bytes`` of text.

Score (all 64-bit integers, divisions rounding down, logarithm in doubles): with N documents
that have terms, L terms in all, n in the document, df documents with the term, tf in this one,
w = floor(1000 ln((2N + 2) / (2df + 1))), m = 50 + 50 n N div L, and the sum over the item's
different terms of w (10^9 tf div (1000 tf + 20 m)).

Defined results: null and empty texts have no terms, are not counted and not found; items
without terms, or without any document in common, have no rows; equal scores rank by doc_id,
null last, and rows equal in both (repeated documents) in any order, as their rows are alike;
repeated items are ranked each for itself under their own id; an empty table on either side
gives no rows; very long texts are taken whole; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_BYTES, slices, stage, text_bytes, words

#: Groups of tasks whose rows are merged first.
MERGE_GROUPS = 64


@dataclass
class Block:
    """Items of one block: their row keys, and each one's terms as codes of the vocabulary."""
    keys: list[int]
    terms: list[np.ndarray]
    vocabulary: list[str]

    @classmethod
    def of(cls, rows: list[tuple]) -> Block:
        found = [(k, sorted({w.decode() for w in words(t.encode() if t is not None else None)})) for k, t in rows]
        code: dict[str, int] = {}
        terms = [np.array([code.setdefault(w, len(code)) for w in ws], np.int64) for _, ws in found]
        return cls([k for k, _ in found], terms, list(code))

    def rarest_first(self, df: np.ndarray) -> list[np.ndarray]:
        return [t[np.argsort(df[t], kind="stable")] for t in self.terms]


def postings(batch, col: str, vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each document with repeats; and codes, documents and counts of the query terms in them, by code."""
    import pyarrow as pa
    import pyarrow.compute as pc
    plain = pa.array([t.translate(WORD_BYTES) if t else b"" for t in text_bytes(batch, col)], pa.large_binary()).cast(pa.large_string())
    lists = pc.ascii_split_whitespace(plain)
    found = lists.flatten()
    doc = np.asarray(pc.list_parent_indices(lists)).astype(np.int64)
    n = np.bincount(doc[pc.not_equal(found, "").to_numpy(zero_copy_only=False)], minlength=batch.num_rows).astype(np.int64)
    code = pc.fill_null(pc.index_in(found, value_set=vocabulary), -1).to_numpy()
    hit = code >= 0
    pair, tf = np.unique(code[hit].astype(np.int64) * batch.num_rows + doc[hit], return_counts=True)
    return n, pair // max(batch.num_rows, 1), pair % max(batch.num_rows, 1), tf.astype(np.int64)


def length_part(n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """m of documents of n terms."""
    if len(n) and 50 * int(n.max()) * docs >= 1 << 63:
        return np.array([50 + 50 * x * docs // terms for x in n.tolist()], np.int64)
    return 50 + 50 * n * docs // max(terms, 1)


class Segment:
    """Postings of the query terms over some documents, with what each adds to a score."""

    def __init__(self, code, doc, tf, m, weights: np.ndarray):
        order = np.lexsort((doc, code))
        code, self.doc, tf = code[order], doc[order], tf[order]
        self.gain = weights[code] * (1_000_000_000 * tf // (1000 * tf + 20 * m[self.doc]))
        self.start = np.searchsorted(code, np.arange(len(weights) + 1))
        self.bound = np.zeros(len(weights), np.int64)
        if len(code):
            here = np.flatnonzero(np.diff(self.start))
            self.bound[here] = np.maximum.reduceat(self.gain, self.start[here])
        self.size = len(m)

    def scores(self, terms: np.ndarray, k: int, floor: int = 0) -> tuple[np.ndarray, int]:
        """Partial scores of all documents, exact for any that is among the k highest and not below ``floor``; accumulators opened."""
        terms = terms[self.bound[terms] > 0]
        rest = np.cumsum(self.bound[terms][::-1])[::-1].tolist()    # most that this term and all after it can add
        acc, open_ = np.zeros(self.size, np.int64), None
        for term, most in zip(terms.tolist(), rest):
            doc, gain = (x[self.start[term]:self.start[term + 1]] for x in (self.doc, self.gain))
            if open_ is None and (most < floor or most < int(acc.max()) and most < kth(acc, k)):
                open_ = acc > 0
            if open_ is not None:
                doc, gain = doc[open_[doc]], gain[open_[doc]]
            acc[doc] += gain
        return acc, int(np.count_nonzero(acc))


def kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


class Best:
    """The k best (score, doc_id) of one item so far."""

    def __init__(self, k: int):
        self.k, self.score = k, np.zeros(0, np.int64)
        self.doc, self.null = np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def floor(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, scores: np.ndarray, doc_ids: np.ndarray, null: np.ndarray) -> None:
        at = np.flatnonzero(scores >= max(1, self.floor, kth(scores, self.k)))
        score, doc, no = (np.concatenate([a, b[at]]) for a, b in ((self.score, scores), (self.doc, doc_ids), (self.null, null)))
        order = np.lexsort((doc, no, -score))[:self.k]
        self.score, self.doc, self.null = score[order], doc[order], no[order]


def _count(docs: DataFrame, block, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with terms, terms in all, and documents of each query term."""
    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa
        vocabulary = pa.array(block.value.vocabulary, pa.large_string())
        df, with_terms, total = np.zeros(n_terms, np.int64), 0, 0
        for b in slices(batches):
            n, code, _, _ = postings(b, "t", vocabulary)
            df += np.bincount(code, minlength=n_terms)
            with_terms, total = with_terms + int(np.count_nonzero(n)), total + int(n.sum())
        code = np.concatenate([[-2, -1], np.flatnonzero(df)])
        yield pa.RecordBatch.from_arrays([pa.array(code.astype(np.int64)), pa.array(np.concatenate([[total, with_terms], df[df > 0]]))],
                                         ["code", "x"])

    sums = docs.mapInArrow(count, "code long, x long").groupBy("code").agg(F.sum("x"))
    found = {r[0]: r[1] for r in sums.collect()}    # no more rows than the block has terms, and two
    df = np.zeros(n_terms, np.int64)
    for code, x in found.items():
        if code >= 0:
            df[code] = x
    return found.get(-1, 0), found.get(-2, 0), df


def _rank_block(docs: DataFrame, block: Block, k: int, segment_bytes: int) -> DataFrame:
    """key, doc_id, score, part: the best of every task, written, so that the block can be let go."""
    sc = docs.sparkSession.sparkContext
    terms = sc.broadcast(block)
    n_docs, n_terms, df = _count(docs, terms, len(block.vocabulary))
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    queries = sc.broadcast((block.rarest_first(df), weights))

    def search(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        vocabulary = pa.array(terms.value.vocabulary, pa.large_string())
        ordered, w = queries.value
        best = [Best(k) for _ in ordered]
        held: list[tuple] = []
        size = 0

        def run():
            base = np.cumsum([0, *(len(h[0]) for h in held)])
            n, code, tf, ids, null = (np.concatenate([h[i] for h in held]) for i in (0, 1, 3, 4, 5))
            doc = np.concatenate([h[2] + b for h, b in zip(held, base)])
            seg = Segment(code, doc, tf, length_part(n, n_docs, n_terms), w)
            for item, own in zip(ordered, best):
                own.add(seg.scores(item, k, own.floor)[0], ids, null)

        for b in slices(batches):
            ids = b.column(0)
            held.append((*postings(b, "t", vocabulary), ids.fill_null(0).to_numpy(zero_copy_only=False),
                         ids.is_null().to_numpy(zero_copy_only=False)))
            size += b.nbytes
            if size >= segment_bytes:
                run()
                held, size = [], 0
        if held:
            run()
        part = TaskContext.get().partitionId()
        for key, own in zip(terms.value.keys, best):
            m = len(own.score)
            yield pa.RecordBatch.from_arrays([pa.array([key] * m, pa.int64()), pa.array(own.doc, mask=own.null), pa.array(own.score),
                                              pa.array([part] * m, pa.int32())], ["key", "doc_id", "score", "part"])

    out = stage(docs.mapInArrow(search, "key long, doc_id long, score long, part int"), "ranked")
    queries.destroy()
    terms.destroy()
    return out


def _best(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 4 << 20,
                  segment_bytes: int = 16 << 20) -> DataFrame:
    """The k highest-scoring documents of each item: item_id, rank, doc_id, score."""
    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("t"))
    asked = stage(items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("q"),
                               F.monotonically_increasing_id().alias("key")), "search-items")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("q")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    found = None
    for i in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == i).select("key", "q")
        block = Block.of([tuple(r) for r in own.toLocalIterator()])    # about block_bytes, whatever the tables' sizes
        if i == 0 or block.vocabulary:
            part = _rank_block(rows, block, k, segment_bytes)
            found = part if found is None else found.unionByName(part)
    group = F.pmod(F.col("part"), F.lit(MERGE_GROUPS))
    top = _best(_best(found.withColumn("part", group), k, "key", "part").drop("rank"), k, "key")
    return top.join(asked.select("key", "item_id"), "key").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
