import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import awkward
from tidemark.llm.mixing import mix_documents, mix_plan, source_targets
from tidemark.llm.queries import QUERIES
from tidemark.llm.sharding import communication_matrix, hypergeometric, shuffle_to_shards

SF = "/root/testdata/sf0.001"


def test_matrix_has_exact_margins():
    blocks, shards = [13, 0, 7, 100, 1], [31, 30, 30, 30]
    m = communication_matrix(blocks, shards, 3)
    assert [sum(r) for r in m] == blocks and [sum(c) for c in zip(*m)] == shards
    assert m == communication_matrix(blocks, shards, 3) != communication_matrix(blocks, shards, 4)


def test_hypergeometric_law():
    rng = np.random.default_rng(1)
    got = Counter(hypergeometric(rng, 6, 10, 4) for _ in range(20_000))
    for k in range(5):
        p = math.comb(6, k) * math.comb(4, 4 - k) / math.comb(10, 4)
        assert abs(got[k] / 20_000 - p) < 0.015
    big = [hypergeometric(rng, 10**11, 4 * 10**12, 10**6) for _ in range(400)]
    assert abs(np.mean(big) - 25_000) < 40 and 100 < np.std(big) < 220


@pytest.mark.parametrize("per", [8, 500_000])
def test_shards_exact_and_gapless(spark, per):
    df = awkward(spark)
    rows = shuffle_to_shards(df.repartition(5), 7, rows_per_block=per).collect()
    assert len(rows) == df.count()
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and len(by) == 7
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    drop = [c for c in df.columns if c != "shard"]
    assert Counter(tuple(r[c] for c in drop) for r in rows) == Counter(tuple(r) for r in df.select(drop).collect())


def test_shards_empty_and_uniform(spark):
    assert shuffle_to_shards(awkward(spark, empty=True), 4).count() == 0
    hits = Counter()
    for seed in range(12):
        rows = shuffle_to_shards(spark.range(40).repartition(3), 4, seed).where("id < 8").collect()
        hits.update(r.shard for r in rows)
    assert all(abs(v - 24) < 18 for v in hits.values())


def test_every_position_is_equally_likely(spark):
    """Chi-square over where a row ends up: 4 shards x 5 slots for 20 rows, blocks of 8, over many seeds."""
    df = spark.range(20).repartition(3).cache()
    seeds = 100
    counts = np.zeros((20, 20))
    for seed in range(seeds):
        for r in shuffle_to_shards(df, 4, seed, rows_per_block=8).collect():
            counts[r.id, 5 * r.shard + r.slot] += 1
    assert (counts.sum(0) == seeds).all() and (counts.sum(1) == seeds).all()
    want = seeds / 20
    chi = ((counts - want) ** 2 / want).sum()
    freedom = 19 * 19
    assert abs(chi - freedom) < 5 * np.sqrt(2 * freedom)
    # and for neighbours in the input: they do not stay neighbours
    assert abs(counts[:10, :10].sum() - 10 * seeds / 2) < 5 * np.sqrt(10 * seeds / 4)


def test_op1_query(spark):
    src = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = QUERIES["op1_sharding"](spark, SF).collect()
    assert sorted(r.doc_id for r in out) == sorted(src)
    for r in out:
        b = (src[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(b) + 16, zlib.crc32(b), "rows", None)
    assert set(Counter(r.shard for r in out)) == set(range(40))


def brute_targets(sizes: dict, weights=(5, 2, 1), most=3.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, target, full = sum(sizes.values()), {}, set()
    while True:
        free = [s for s in order if s not in full]
        left = total - sum(most * sizes[s] for s in full)
        target = {s: most * sizes[s] if s in full else left * w[s] / sum(w[x] for x in free) for s in order}
        over = {s for s in free if target[s] > most * sizes[s] + 1e-9}
        if not over:
            return target
        full |= over


def count(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def test_targets_by_brute_force(spark):
    rnd = random.Random(2)
    for _ in range(6):
        sizes = {s: rnd.choice([0, 1, 5, 100, 1000, 7000]) for s in ["a", "b", "é", "z", "Z", None][:rnd.randrange(1, 7)]}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in source_targets(df).collect()}
        want = brute_targets(sizes)
        assert all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in sizes), (sizes, got, want)


@pytest.mark.parametrize("make", [lambda s: s.read.parquet("/root/testdata/sf0.01/documents.parquet"), awkward])
def test_mix_near_targets(spark, make):
    docs = make(spark)
    src = docs.select("doc_id", "text", "source").collect()
    sizes = Counter()
    for r in src:
        sizes[r.source] += count(r.text)
    want = brute_targets(sizes)
    out = mix_plan(docs).collect()
    assert len(out) == len(src) and Counter((r.doc_id, r["size"]) for r in out) == Counter((r.doc_id, count(r.text)) for r in src)
    of = {(r.doc_id, count(r.text)): r.source for r in src}
    taken = Counter()
    for r in out:
        s = of[r.doc_id, r["size"]]
        assert 0 <= r.taken <= 3 * r["size"] and r.source_size == sizes[s]
        assert abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 6 for s in sizes), (taken, want)
    assert sorted(out, key=repr) == sorted(mix_plan(docs.repartition(3)).collect(), key=repr)


def test_mix_hot_identical_rows(spark):
    docs = spark.createDataFrame([(None, "a b c d", "x")] * 300 + [(i, "q w", "y") for i in range(900)], "doc_id long, text string, source string")
    out = mix_plan(docs).groupBy("source_size").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect()
    assert all(abs(r.t - r.g) <= 300 for r in out)


def test_mix_documents_whole_copies(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    mixed = mix_documents(docs)
    assert mixed.columns == docs.columns
    got = Counter(r.doc_id for r in mixed.select("doc_id").collect())
    for r in mix_plan(docs).collect():
        assert got[r.doc_id] == round(r.taken / r["size"]) or abs(r.taken / r["size"] - got[r.doc_id]) <= 0.5
    assert mix_documents(awkward(spark)).columns == awkward(spark).columns
    assert mix_documents(awkward(spark, empty=True)).count() == 0 == mix_plan(awkward(spark, empty=True)).count()
