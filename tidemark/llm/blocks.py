"""Links between the members of buckets, without gathering a bucket in one task.

Members of a bucket are dealt by hash into chunks; every pair of chunks is a block, and a
step compares one block at a time. A bucket of n members makes (n / chunk)**2 / 2 blocks
of bounded size, spread over all tasks.

Pairs are never written out. A block gives for each member the number of rows it links
to, and one edge to the least member of its group inside the block, which is all that
link counts and components need. Members that meet in several buckets are counted in the
lowest of them only: each carries the list of its buckets. Buckets of exactly the same
members are compared once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import give_back, stage


def distinct_buckets(members: DataFrame) -> DataFrame:
    """members: (bucket, id, weight). Buckets of two members or more, one for each set of members: (bucket, n, weight)."""
    sums = members.groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum("weight").alias("weight"), F.min("id").alias("lo"), F.max("id").alias("hi"),
        F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("x1"), F.bit_xor(F.xxhash64(F.lit(2), "id")).alias("x2"))
    return sums.where("n > 1").groupBy("n", "weight", "lo", "hi", "x1", "x2").agg(F.min("bucket").alias("bucket")).select("bucket", "n", "weight")


def members_of(members: DataFrame, buckets: DataFrame) -> DataFrame:
    """Per id its buckets with their sizes: (id, at array<struct<bucket, n, weight>>)."""
    return members.select("bucket", "id").join(buckets, "bucket").groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("bucket", "n", "weight"))).alias("at"))


def links(carriers: DataFrame, similar: Callable, chunk: int, chunk_weight: int) -> DataFrame:
    """carriers: (id, mult, at, data binary). Returns (id, links, root) per block and linked member.

    ``similar(left, right)`` takes two lists of data (the same list object for a block of one
    chunk) and returns the matrix of links as booleans. ``links`` adds up the ``mult`` of what a
    member links to.
    """
    m = carriers.select("id", "mult", "data", F.transform("at", lambda b: b["bucket"]).alias("all"), F.explode("at").alias("b"))
    m = m.select("id", "mult", "data", "all", "b.bucket",
                 F.greatest(F.ceil(F.col("b.n") / chunk), F.ceil(F.col("b.weight") / chunk_weight)).cast("int").alias("k"))
    m = m.withColumn("c", F.pmod(F.xxhash64("id", "bucket"), F.col("k")).cast("int"))
    m = m.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    m = m.select("bucket", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"),
                 (F.col("c") > F.least("c", "o")).cast("int").alias("side"), "id", "mult", "all", "data")
    m = m.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "side")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        out: list[tuple] = []
        for bucket, diagonal, rows in _blocks(batches):
            out += _block(bucket, diagonal, rows, similar)
            if len(out) > 20_000:
                yield _batch(pa, out)
                out = []
        if out:
            yield _batch(pa, out)
        give_back()

    return m.mapInArrow(run, "id long, links long, root long")


def _batch(pa, out: list[tuple]):
    cols = zip(*out)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["id", "links", "root"])


def _blocks(batches: Iterator) -> Iterator[tuple]:
    """(bucket, one chunk only, [(side, id, mult, all, data)]) from rows sorted by block; one block is held at a time."""
    held, last = [], None
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in range(3)))
        rest = zip(*(batch.column(c).to_pylist() for c in range(3, 8)))
        for key, row in zip(keys, rest):
            if key != last:
                if held:
                    yield last[0], last[1] == last[2], held
                held, last = [], key
            held.append(row)
    if held:
        yield last[0], last[1] == last[2], held


def _block(bucket: int, diagonal: bool, rows: list[tuple], similar: Callable) -> list[tuple]:
    left = [r for r in rows if r[0] == 0]
    right = left if diagonal else [r for r in rows if r[0] == 1]
    if not left or not right or (diagonal and len(left) < 2):
        return []
    if diagonal and len(left) == 2 and min(set(left[0][3]) & set(left[1][3])) != bucket:
        return []
    data = [r[4] for r in left]
    hit = similar(data, data if diagonal else [r[4] for r in right])
    if diagonal:
        np.fill_diagonal(hit, False)
    if not hit.any():
        return []
    hit &= ~_met_before(bucket, left, right)
    if not hit.any():
        return []
    lm, rm = np.array([r[2] for r in left], np.int64), np.array([r[2] for r in right], np.int64)
    ids = [r[1] for r in left] if diagonal else [r[1] for r in left] + [r[1] for r in right]
    count = hit @ rm if diagonal else np.concatenate([hit @ rm, lm @ hit])
    root = _roots(hit, diagonal)
    best: dict[int, int] = {}
    for r, x in zip(root.tolist(), ids):
        best[r] = min(best.get(r, x), x)
    return [(x, c, best[r]) for x, c, r in zip(ids, count.tolist(), root.tolist()) if c]


def _met_before(bucket: int, left: list, right: list, width: int = 2048) -> np.ndarray:
    """Pairs that meet in a lower bucket as well. Only buckets of members on both sides count, some at a time."""
    met = np.zeros((len(left), len(right)), bool)
    once, again = set(), set()
    for r in left:
        for b in r[3]:
            if b < bucket:
                (again if b in once else once).add(b)
    shared = sorted(again if right is left else once.intersection(b for r in right for b in r[3]))
    for a in range(0, len(shared), width):
        place = {b: i for i, b in enumerate(shared[a:a + width])}
        x, y = np.zeros((len(left), len(place)), np.float32), np.zeros((len(right), len(place)), np.float32)
        for m, side in ((x, left), (y, right)):
            for i, r in enumerate(side):
                m[i, [place[b] for b in r[3] if b in place]] = 1
        met |= x @ y.T > 0
    return met


def _roots(hit: np.ndarray, diagonal: bool) -> np.ndarray:
    """Group number of each member (left, then right) under the links of a block, by least labels."""
    n, m = hit.shape
    if diagonal:
        lab = np.arange(n)
        while True:
            new = np.minimum(lab, np.where(hit, lab[None, :], n).min(1))
            new = new[new]
            if (new == lab).all():
                return lab
            lab = new
    lab_l, lab_r = np.arange(n), np.arange(n, n + m)
    while True:
        new_r = np.minimum(lab_r, np.where(hit, lab_l[:, None], n + m).min(0))
        new_l = np.minimum(lab_l, np.where(hit, new_r[None, :], n + m).min(1))
        if (new_l == lab_l).all() and (new_r == lab_r).all():
            return np.concatenate([lab_l, lab_r])
        lab_l, lab_r = new_l, new_r


def settle(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (id, links, root): links per id, and (node, component)."""
    from tidemark.llm.components import components
    found = stage(found, "links")
    return (found.groupBy("id").agg(F.sum("links").alias("links")),
            components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))))
