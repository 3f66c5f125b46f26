"""Operator 8: n-gram Jaccard join by chosen paths (Christiani, Pagh, Sivertsen).

A document is the set of hashes of its five-word shingles. In each run and at each level
a set chooses the tokens whose seeded hash lies below 1 / (threshold x set size): about
1.25 tokens, and two sets that are similar enough choose at least one shared token on
average. The chosen tokens of level one split the sets into buckets; a bucket of more than
``split`` sets is split again by the tokens of level two, and so on to ``levels``. From level
two on a set chooses ``WIDER`` times as many tokens, so that a pair that has met is hardly
lost again. Small buckets, what is left at the last level, and buckets whose parts would take
as many comparisons as they do themselves are compared by brute force: exact Jaccard on whole
sets, in blocks (see ``blocks``). Runs are repeated until a pair at the threshold is found
with probability ``recall`` even if it has to pass all levels: at 0.99999 a document with
10,000 links at the threshold loses 0.1 of them on average, fewer of closer ones.

Documents with equal sets are one class, compared once and counted as often as it occurs.
Sets are not stored: documents that meet others are shingled again from their text.

Defined results: words are those of ``common.words``; fewer than five words, but not
none, make one shingle of all; documents without words (null, empty) link with nothing and
are components of their own; repeated rows are separate documents of one class; an empty
table gives an empty result; very long texts are shingled whole. A similarity equal to the
threshold links; of a component the least id stays, then the least text digest. Other
columns, whatever their names, are carried along by ``drop_near_copies`` and not read otherwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import blocks
from tidemark.llm.common import fresh, slices, stage, text_bytes, words

MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
WIDER = 4.0  # chosen tokens at level two and below, as a multiple of those at level one


class WordHashes(dict):
    """64-bit hashes of words, computed once; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A seeded 64-bit mix of hashes."""
    with np.errstate(over="ignore"):
        x = (x ^ np.uint64(seed * 0xD1B54A32D192ED03 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


def shingles(text: bytes | None, n: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles of a text."""
    ws = words(text)
    if not ws:
        return np.zeros(0, np.uint64)
    h = np.array([known[w] for w in ws], np.uint64)
    n = min(n, len(h))
    out = np.zeros(len(h) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = (out ^ (out >> np.uint64(31))) * MULTIPLY + h[i:len(h) - n + 1 + i]
    return np.unique(mix(out, n))


def runs_for(threshold: float, levels: int, recall: float, wider: float = 1.0) -> int:
    """Runs after which a pair at the threshold is found with probability ``recall``, all levels passed.

    The larger of two sets chooses each shared token with probability 1 / (threshold x size), so at least
    one of them in a level with probability 1 - exp(-shared / (threshold x size)), where the share is
    the threshold at least; after level one, where ``wider`` times as many are chosen, 1 - exp(-wider) at least.
    """
    once = (1 - np.exp(-1.0)) * (1 - np.exp(-wider)) ** (levels - 1)
    return int(np.ceil(np.log(1 - recall) / np.log(1 - once)))


def chosen(tokens: np.ndarray, seed: int, threshold: float, wider: float = 1.0) -> np.ndarray:
    """Tokens that a set chooses."""
    limit = wider * 2.0**64 / (threshold * len(tokens))
    return tokens if limit >= 2.0**64 else tokens[mix(tokens, seed) < np.uint64(min(limit, 2.0**64 - 2048))]


def jaccard_links(left: list[np.ndarray], right: list[np.ndarray], threshold: float, width: int = 4096) -> np.ndarray:
    """Which pairs reach the threshold. Tokens of one set only cannot be shared and are left out of the products."""
    same = right is left
    sets = left if same else left + right
    sizes = np.array([len(s) for s in sets], np.float64)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes.astype(np.int64))
    keep = count[column] > 1
    row, column = row[keep], np.unique(column[keep], return_inverse=True)[1]
    n, m = len(left), len(sets) - len(left)
    shared = np.zeros((n, n if same else m), np.float64)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        i, j = np.searchsorted(column, [a, a + width])
        x = np.zeros((len(sets), int(column[j - 1]) - a + 1), np.float32)
        x[row[i:j], column[i:j] - a] = 1
        shared += x @ x.T if same else x[:n] @ x[n:].T
    total = sizes[:n, None] + (sizes[None, :] if same else sizes[None, n:])
    return shared * (1 + threshold) >= threshold * total - 1e-9


def _signatures(docs: DataFrame, n: int, threshold: float, runs: int, levels: int) -> DataFrame:
    """docs: (t, ...). Adds size, set digest (k1, k2) and chosen tokens: paths, an array (run) of arrays, and those
    of the further levels in 32 bits, deeper, an array (run x (levels - 1)) of arrays."""
    from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        known = WordHashes()
        for b in slices(batches):
            size, k1, k2, paths, deeper = [], [], [], [], []
            for text in text_bytes(b, "t"):
                s = shingles(text, n, known)
                d = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
                size.append(len(s))
                k1.append(int(d[0]))
                k2.append(int(d[1]))
                paths.append([chosen(s, 1 + i, threshold).view(np.int64).tolist() for i in range(runs)] if len(s) else [])
                deeper.append([chosen(s, 1 + i, threshold, WIDER).astype(np.uint32).view(np.int32).tolist()
                               for i in range(runs, runs * levels)] if len(s) else [])
            cols = [c for c, name in zip(b.columns, b.schema.names) if name != "t"]
            names = [name for name in b.schema.names if name != "t"]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(size, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                                              pa.array(paths, pa.list_(pa.list_(pa.int64()))), pa.array(deeper, pa.list_(pa.list_(pa.int32())))],
                                             [*names, "size", "k1", "k2", "paths", "deeper"])

    extra = [StructField(c, LongType()) for c in ("size", "k1", "k2")] + [
        StructField(c, ArrayType(ArrayType(kind()))) for c, kind in (("paths", LongType), ("deeper", IntegerType))]
    return docs.mapInArrow(run, StructType([f for f in docs.schema.fields if f.name != "t"] + extra))


def _split(classes: DataFrame, runs: int, levels: int, split: int) -> DataFrame:
    """(bucket, id, weight): members of small buckets at any level, of large ones that splitting would not make
    cheaper, and of all buckets at the last level."""
    now = classes.select("id", "size", F.posexplode("paths").alias("run", "tokens")).select(
        "id", "size", "run", F.explode("tokens").alias("token"))
    now = stage(now.select("id", "size", "run", F.xxhash64("run", "token").alias("bucket")), "chosen-paths")
    sizes = stage(now.groupBy("bucket").count().where("count > 1"), "path-sizes")
    done = []
    for level in range(1, levels):
        here = now.join(sizes, "bucket")
        done.append(here.where(F.col("count") <= split).select("bucket", "id", "size"))
        large = here.where(F.col("count") > split).select("bucket", "id", "run")
        tokens = classes.select("id", "size", F.slice("deeper", (level - 1) * runs + 1, runs).alias("next"))
        parts = (large.join(tokens, "id")
                 .select("id", "size", "run", F.col("bucket").alias("parent"), F.explode(F.element_at("next", F.col("run") + 1)).alias("token"))
                 .select("id", "size", "run", "parent", F.xxhash64("parent", "token").alias("bucket")))
        parts = stage(parts, "chosen-paths")
        part_sizes = stage(parts.groupBy("parent", "bucket").count().where("count > 1"), "path-sizes")
        square = F.col("count").cast("double") * F.col("count")
        cost = part_sizes.groupBy("parent").agg(F.sum(square).alias("cost"))
        whole = sizes.join(cost, sizes["bucket"] == cost["parent"]).where(F.col("cost") >= square).select("parent")
        whole = stage(whole, "whole-buckets")
        done.append(now.join(whole.withColumnRenamed("parent", "bucket"), "bucket").select("bucket", "id", "size"))
        now = parts.join(whole, "parent", "left_anti").drop("parent")
        sizes = part_sizes.join(whole, "parent", "left_anti").select("bucket", "count")
    done.append(now.join(sizes, "bucket").select("bucket", "id", "size"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.withColumnRenamed("size", "weight")


def _join(docs: DataFrame, id_col: str, text_col: str, n: int, threshold: float, levels: int, recall: float, split: int,
          chunk: int, chunk_weight: int) -> DataFrame:
    """Per row: doc_id, t1, t2 (text digest), size, class_id, n_links, component (long, unique per component), component_id."""
    runs = runs_for(threshold, levels, recall, WIDER)
    text = [F.xxhash64(F.lit(i), text_col).alias(f"t{i}") for i in (1, 2)]
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), *text, F.col(text_col).alias("t"))
    rows = stage(_signatures(d, n, threshold, runs, levels), "shingled")
    classes = rows.where("size > 0").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("mult"), F.min(F.struct("t1", "t2")).alias("text"),
        F.first("size").alias("size"), F.first(F.struct("paths", "deeper")).alias("p")).select("*", "p.paths", "p.deeper").drop("p")
    classes = stage(classes.withColumn("id", F.monotonically_increasing_id()), "shingle-classes")
    members = stage(_split(classes, runs, levels, split), "path-members")
    at = blocks.members_of(members, blocks.distinct_buckets(members))

    # texts of classes that meet others; copies of a text fall together before the exchange
    needed = classes.select("id", "mult", "text.t1", "text.t2").join(at, "id")
    texts = docs.select(*text, F.col(text_col).alias("t")).groupBy("t1", "t2").agg(F.first("t").alias("t"))
    carriers = texts.join(needed, ["t1", "t2"]).select("id", "mult", "at", "t")

    def sets(batches: Iterator) -> Iterator:
        import pyarrow as pa
        known = WordHashes()
        for b in slices(batches):
            data = [shingles(t, n, known).tobytes() for t in text_bytes(b, "t")]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(data, pa.binary())], ["id", "mult", "at", "data"])

    carriers = carriers.mapInArrow(sets, "id long, mult long, at array<struct<bucket:long,n:long,weight:long>>, data binary")

    def similar(left: list, right: list) -> np.ndarray:
        a = [np.frombuffer(x, np.uint64) for x in left]
        return jaccard_links(a, a if right is left else [np.frombuffer(x, np.uint64) for x in right], threshold)

    counts, comps = blocks.settle(blocks.links(carriers, similar, chunk, chunk_weight))
    out = (classes.select("k1", "k2", "id", "class_id", "mult").join(counts, "id", "left")
           .join(comps.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id")))
    least = out.groupBy("component").agg(F.min("class_id").alias("component_id"))
    out = stage(out.join(least, "component").select(
        "k1", "k2", "class_id", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), "component", "component_id"), "near-classes")
    some = rows.where("size > 0").drop("paths", "deeper").join(out, ["k1", "k2"])
    none = rows.where("size = 0").drop("paths", "deeper").select(
        "*", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component"),
        F.col("doc_id").alias("component_id"))
    return some.unionByName(none)


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float = 0.8, levels: int = 2,
               recall: float = 0.99999, split: int = 512, chunk: int = 1024, chunk_weight: int = 1 << 21) -> DataFrame:
    """Per document: doc_id, class_id (least id with the same shingles), n_links (other documents at the
    threshold or above), component_id (least id reachable by links), kept (doc_id = component_id)."""
    out = _join(docs, id_col, text_col, n, threshold, levels, recall, split, chunk, chunk_weight)
    return out.select("doc_id", "class_id", F.col("n_links").cast("long").alias("n_links"), "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float = 0.8,
                     levels: int = 2, recall: float = 0.99999, split: int = 512, chunk: int = 1024, chunk_weight: int = 1 << 21) -> DataFrame:
    """``docs`` with one document of each component: the one of least id, null last, then of least text digest.

    Documents without words all stay; rows of the same id and text are one document.
    """
    out = _join(docs, id_col, text_col, n, threshold, levels, recall, split, chunk, chunk_weight)
    key = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "t1", "t2")
    best = out.where("component is not null").groupBy("component").agg(F.min(key).alias("k"))
    keep = best.select("k.doc_id", "k.t1", "k.t2").unionByName(out.where("component is null").select("doc_id", "t1", "t2")).distinct()
    i, a, b = fresh(docs, "_i", "_a", "_b")
    keep = stage(keep.toDF(i, a, b), "kept")
    x, y = fresh(docs.withColumns({c: F.lit(0) for c in (i, a, b)}), "_x", "_y")
    d = docs.withColumns({x: F.xxhash64(F.lit(1), text_col), y: F.xxhash64(F.lit(2), text_col)})
    on = (F.col(x) == F.col(a)) & (F.col(y) == F.col(b)) & F.col(id_col).eqNullSafe(F.col(i))
    return d.join(keep, on, "left_semi").dropDuplicates([id_col, x, y]).select(*docs.columns)
