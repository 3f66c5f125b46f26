"""Operator 7: near-duplicate vectors by cross-polytope hashing.

A vector is rotated at random (sign flips and fast Hadamard transforms, three times) and
hashed to the nearest of the +- unit vectors. A table joins the hashes of ``k`` rotations;
each vector goes into its own bucket of every table and into the bucket of the next best
choice (multiprobe). ``k`` grows with the logarithm of the number of vectors, so that
unrelated vectors rarely meet, and the number of tables follows from ``k``: the chance
that two vectors at the threshold meet in a table is measured on random pairs, and tables
are added until the target recall is reached.

Vectors that meet are compared by cosine in double precision, in blocks (see ``blocks``).
Equal vectors are one class and are compared once, counted as often as they occur.

Defined results: vectors that are null, empty, zero or hold null or non-finite components
link with nothing and are components of their own; vectors of different length do not
link; repeated rows are separate vectors; a null id has a null component only if its
whole component has null ids, and is not kept; an empty table gives an empty result. A
cosine equal to the threshold links; of equal ids all rows are kept or none. Other columns,
whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import blocks
from tidemark.llm.common import stage


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, to the same length."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        h *= 2
    return x.reshape(n, d) / np.sqrt(d)


@cache
def signs(d: int, number: int) -> np.ndarray:
    """Sign flips of one rotation."""
    return np.random.default_rng([17, d, number]).choice([-1.0, 1.0], (3, d))


def rotated(x: np.ndarray, number: int) -> np.ndarray:
    n, d = x.shape
    size = 1 << max(0, d - 1).bit_length()
    y = np.zeros((n, size))
    y[:, :d] = x
    for s in signs(size, number):
        y = hadamard(y * s)
    return y


def hashes(x: np.ndarray, table: int, k: int) -> np.ndarray:
    """Bucket numbers (vectors x 2) of one table: own choice, and the next best one."""
    n = len(x)
    own, nxt, gap = np.empty((k, n), np.int64), np.empty((k, n), np.int64), np.empty((k, n))
    rows = np.arange(n)
    for i in range(k):
        y = rotated(x, table * k + i)
        d = y.shape[1]
        a = np.abs(y)
        first = a.argmax(1)
        top = a[rows, first]
        a[rows, first] = -1
        second = a.argmax(1)
        gap[i] = top - a[rows, second]
        own[i] = 2 * first + (y[rows, first] < 0)
        nxt[i] = 2 * second + (y[rows, second] < 0)
    probe = own.copy()
    least = gap.argmin(0)
    probe[least, rows] = nxt[least, rows]
    base = np.int64(2 * d)
    out = np.zeros((n, 2), np.int64)
    for i in range(k):
        out[:, 0], out[:, 1] = out[:, 0] * base + own[i], out[:, 1] * base + probe[i]
    return out


def meeting_chance(d: int, k: int, cosine: float, pairs: int = 1500) -> float:
    """Share of random pairs at ``cosine`` that meet in a table."""
    rng = np.random.default_rng(23)
    x, z = rng.normal(size=(2, pairs, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
    a, b = hashes(x, 10_000, k), hashes(cosine * x + np.sqrt(1 - cosine**2) * z, 10_000, k)
    return float((a[:, :, None] == b[:, None, :]).any((1, 2)).mean())


def plan(n: int, d: int, cosine: float, recall: float) -> tuple[int, int]:
    """Hashes per table and number of tables for n vectors of length d."""
    values = 2 * (1 << max(0, d - 1).bit_length())
    k = max(1, int(np.ceil(np.log(max(n, 2)) / np.log(values))))
    p = meeting_chance(d, k, cosine)
    while p < 0.02 and k > 1:       # fewer hashes: larger buckets instead of hundreds of tables
        k -= 1
        p = meeting_chance(d, k, cosine)
    if not p:
        raise ValueError(f"vectors of length {d} at cosine {cosine} hardly ever meet: this hash does not suit them")
    return k, max(1, int(np.ceil(np.log(1 - recall) / np.log(1 - min(p, 0.999)))))


def near_vectors(vectors: DataFrame, cosine: float = 0.95, recall: float = 0.995, id_col: str = "vec_id",
                 vec_col: str = "embedding", chunk: int = 1024) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ok = F.coalesce((F.size("v") > 0) & ~bad & F.exists("v", lambda x: x != 0), F.lit(False))
    v = v.withColumn("ok", ok)
    key = [F.xxhash64(F.lit(i), "v").alias(f"k{i}") for i in (1, 2)]
    rows = stage(v.select("vec_id", "ok", *key), "vector-rows")
    classes = stage(v.where("ok").select("vec_id", "v", *key).groupBy("k1", "k2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("mult"), F.first("v").alias("v"))
        .withColumn("id", F.monotonically_increasing_id()), "vector-classes")
    plans = {d: plan(n, d, cosine, recall) for d, n in classes.groupBy(F.size("v")).count().collect()}

    def hash_rows(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            lists = b.column(1)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            ids = b.column(0).to_numpy()
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)
            for d in np.unique(sizes).tolist():
                pick = np.flatnonzero(sizes == d)
                x = np.stack([flat[ends[i] - d:ends[i]] for i in pick])
                x = x / np.abs(x).max(1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                k, tables = plans[d]
                for t in range(tables):
                    h = hashes(x, t, k)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(2 * len(pick), d)), pa.array(np.full(2 * len(pick), t)), pa.array(h.T.reshape(-1)),
                        pa.array(np.tile(ids[pick], 2))], ["d", "t", "h", "id"])

    hashed = classes.select("id", "v").mapInArrow(hash_rows, "d long, t long, h long, id long")
    members = stage(hashed.select(F.xxhash64("d", "t", "h").alias("bucket"), "id", F.lit(1).cast("long").alias("weight")), "vector-members")
    at = blocks.members_of(members, blocks.distinct_buckets(members))

    def similar(left: list, right: list) -> np.ndarray:
        return _unit(left) @ _unit(right).T >= cosine

    packed = classes.select("id", "mult", "v").mapInArrow(_pack, "id long, mult long, data binary")
    counts, comps = blocks.settle(blocks.links(packed.join(at, "id"), similar, chunk, chunk))
    out = classes.select("k1", "k2", "id", "rep", "mult").join(counts, "id", "left").join(
        comps.withColumnRenamed("node", "id"), "id", "left")
    out = out.withColumn("component", F.coalesce("component", "id"))
    least = out.groupBy("component").agg(F.min("rep").alias("component_id"))
    out = stage(out.join(least, "component").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("links"), "component_id"), "vector-components")
    good = rows.where("ok").join(out, ["k1", "k2"]).select("vec_id", F.col("links").cast("long").alias("n_links"), "component_id")
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _pack(batches: Iterator) -> Iterator:
    """(id, mult, vector) to (id, mult, bytes of the unit vector in doubles)."""
    import pyarrow as pa
    for b in batches:
        out = []
        for x in b.column(2).to_pylist():
            x = np.array(x)
            x = x / np.abs(x).max()
            out.append((x / np.sqrt(x @ x)).tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], ["id", "mult", "data"])


def _unit(data: list) -> np.ndarray:
    return np.frombuffer(b"".join(data)).reshape(len(data), -1)
