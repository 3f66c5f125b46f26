import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from cases import awkward
from tidemark.llm.queries import QUERIES
from tidemark.llm.ranked import Block, Segment, kth, length_part, ranked_search

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return [w.translate(LOWER) for w in WORD.findall(text)] if text else []


def brute(docs, items, k=50):
    """docs, items: (id, text). Rows of the contract, rank by rank."""
    tf = [(d, Counter(terms(t))) for d, t in docs]
    tf = [(d, c) for d, c in tf if c]
    n, length = len(tf), sum(sum(c.values()) for _, c in tf)
    df = Counter(w for _, c in tf for w in c)
    out = []
    for item, text in items:
        own = set(terms(text))
        found = []
        for d, c in tf:
            m = 100 - 50 + (50 * sum(c.values()) * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 20 * m))
                    for w in own if w in c)
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        out += [(item, i + 1, f[3], -f[0]) for i, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_op12_query(spark):
    d = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{d}/benchmark.parquet").select("item_id", "text").collect()]
    got = QUERIES["op12_ranked_search"](spark, d)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(got) == brute(docs, items)


@pytest.mark.parametrize("k,segment,block", [(1, 1, 1 << 20), (5, 1, 64), (50, 1 << 20, 200), (1000, 3000, 1 << 20)])
def test_awkward(spark, k, segment, block):
    docs = awkward(spark)
    items = [(1, "alpha1 beta2 mit3 MIT3 the7"), (2, None), (3, ""), (None, "délta5 Zed1 long"), (1, "nothing-like-it"), (7, "the1 the2"),
             (7, "the1 the2"), (8, "テキスト 😀 words")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumnsRenamed({}).selectExpr("*", "1 AS size", "'x' AS code")
    got = ranked_search(docs.repartition(4), asked, k, segment_bytes=segment, block_bytes=block)
    assert rows_of(got) == brute([(r.doc_id, r.text) for r in docs.collect()], items, k)


def test_empty(spark):
    docs, none = awkward(spark), awkward(spark, empty=True)
    items = spark.createDataFrame([(1, "the1 the2")], "item_id long, text string")
    assert ranked_search(none, items).collect() == []
    assert ranked_search(docs, items.where("false")).collect() == []


def test_accumulators_are_limited_and_exact():
    rng = np.random.default_rng(4)
    size, n_terms, k = 3000, 30, 10
    # term t is in about size / (t + 1) documents: later ones are rarer and weigh more
    pairs = [(t, d, int(rng.integers(1, 5))) for t in range(n_terms) for d in np.flatnonzero(rng.random(size) < 1 / (t + 1) ** 1.5)]
    code, doc, tf = (np.array(x) for x in zip(*pairs))
    m = length_part(rng.integers(5, 200, size), size, 50 * size)
    df = np.bincount(code, minlength=n_terms)
    weights = np.array([math.floor(1000 * math.log((2 * size + 2) / (2 * x + 1))) for x in df])
    seg = Segment(code, doc, tf, m, weights)
    full = np.zeros(size, np.int64)
    for t, d, f in pairs:
        full[d] += weights[t] * (10**9 * f // (1000 * f + 20 * int(m[d])))
    fewer = 0
    for _ in range(50):
        own = rng.choice(n_terms, 8, replace=False)
        part = np.zeros(size, np.int64)
        for t, d, f in pairs:
            if t in own:
                part[d] += weights[t] * (10**9 * f // (1000 * f + 20 * int(m[d])))
        got, opened = seg.scores(own[np.argsort(df[own], kind="stable")], k)
        best = np.flatnonzero(part >= kth(part, k))
        assert (got[best] == part[best]).all() and (got <= part).all() and kth(got, k) == kth(part, k)
        fewer += opened < np.count_nonzero(part)
        high = int(np.sort(part)[-3])
        above, _ = seg.scores(own[np.argsort(df[own], kind="stable")], k, high)
        assert (above[part >= high] == part[part >= high]).all()
    assert fewer > 10


def test_block_terms_and_long_documents():
    block = Block.of([(4, "b A a"), (5, None), (6, "a c")])
    assert [[block.vocabulary[c] for c in t] for t in block.terms] == [["a", "b"], [], ["a", "c"]]
    big = np.array([10**12, 5])
    assert length_part(big, 10**10, 10**13).tolist() == [50 + 50 * 10**12 * 10**10 // 10**13, 50 + 50 * 5 * 10**10 // 10**13]


def test_ties_and_many_copies(spark):
    rnd = random.Random(2)
    docs = [(i % 70 if i % 9 else None, rnd.choice(["x y z", "x y", "z q q", "y"])) for i in range(900)]
    items = [(i, t) for i, t in enumerate(["x", "q y", "z", "w"])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    got = ranked_search(frame, spark.createDataFrame(items, "item_id long, text string"), 40, segment_bytes=50)
    assert rows_of(got) == brute(docs, items, 40)
