import random
from collections import defaultdict

import numpy as np
import pytest

from cases import awkward
from tidemark.llm import blocks
from tidemark.llm.components import components
from tidemark.llm.ngram_join import WIDER, WordHashes, drop_near_copies, jaccard_links, ngram_join, runs_for, shingles
from tidemark.llm.queries import QUERIES
from tidemark.llm.vectors import hadamard, near_vectors, plan


def roots(n, pairs):
    p = list(range(n))

    def find(x):
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        p[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 7), (5, 900)] + [(rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(40)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = roots(901, edges)
    assert got == {x: want[x] for e in edges for x in e if e[0] != e[1]}


def test_components_of_a_long_chain(spark, monkeypatch):
    from tidemark.llm import components as module
    rounds, write = [], module.stage
    monkeypatch.setattr(module, "stage", lambda df, name: (rounds.append(name), write(df, name))[1])
    rnd = random.Random(6)
    names = list(range(5000))
    rnd.shuffle(names)
    edges = spark.createDataFrame(list(zip(names, names[1:])), "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == dict.fromkeys(range(5000), 0)
    assert rounds.count("edges") - 1 <= 20


def test_components_of_stars_trees_and_cliques(spark):
    rnd = random.Random(8)
    edges = [(0, i) for i in range(1, 400)] + [(i // 2 + 1000, i + 1000) for i in range(1, 500)]
    edges += [(2000 + i, 2000 + j) for i in range(25) for j in range(i)] + [(rnd.randrange(3000, 3400), rnd.randrange(3000, 3400)) for _ in range(260)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = roots(3400, edges)
    assert got == {x: want[x] for e in edges for x in e if e[0] != e[1]}
    assert components(spark.createDataFrame([(4, 4)], "a long, b long")).collect() == []


def test_chain_of_versions(spark):
    """Each text shares most with the next one only: one component, however long the chain."""
    rnd = random.Random(7)
    ws = [f"w{rnd.randrange(10**6)}" for _ in range(60 + 6 * 900)]
    texts = [" ".join(ws[6 * i:6 * i + 60]) for i in range(900)]
    order = list(range(900))
    rnd.shuffle(order)
    docs = spark.createDataFrame([(order[i], t) for i, t in enumerate(texts)], "doc_id long, text string")
    sets = word_sets(texts)
    links, comps = brute(sets)
    assert len(set(comps)) == 1
    got = {r.doc_id: (r.n_links, r.component_id) for r in ngram_join(docs).collect()}
    assert got == {order[i]: (links[i], 0) for i in range(900)}


def test_chain_of_vectors(spark):
    """Each vector is near the next one only. Links are found with the recall that was asked for, so a long
    chain may break at a few places, but labels run along the rest of it however long it is."""
    rng = np.random.default_rng(3)
    n, d = 400, 32
    x = np.zeros((n, d))
    x[0] = rng.normal(size=d)
    x[0] /= np.linalg.norm(x[0])
    for i in range(1, n):
        z = rng.normal(size=d)
        z -= (z @ x[i - 1]) * x[i - 1]
        x[i] = 0.965 * x[i - 1] + np.sqrt(1 - 0.965**2) * z / np.linalg.norm(z)
    hit = x @ x.T >= 0.95
    np.fill_diagonal(hit, False)
    order = rng.permutation(n)
    frame = spark.createDataFrame([(int(order[i]), [float(v) for v in x[i]]) for i in range(n)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in near_vectors(frame).collect()}
    links = [got[int(order[i])].n_links for i in range(n)]
    assert sum(links) >= 0.97 * hit.sum() and (np.array(links) <= hit.sum(1)).all()
    missed = (int(hit.sum()) - sum(links)) // 2
    parts = defaultdict(set)
    for r in got.values():
        parts[r.component_id].add(r.vec_id)
    assert len(parts) <= 1 + missed and all(k == min(v) for k, v in parts.items())


def test_met_before_by_any_width():
    from tidemark.llm.blocks import _met_before
    rnd = random.Random(3)
    left, right = ([(s, i, 1, sorted(rnd.sample(range(60), 6)), b"") for i in range(30)] for s in (0, 1))
    for other in (left, right):
        want = [[any(b < 40 and b in y[3] for b in x[3]) for y in other] for x in left]
        for width in (1, 7, 2048):
            got = _met_before(40, left, other, width)
            off = ~np.eye(30, dtype=bool) if other is left else np.ones((30, 30), bool)
            assert (got == np.array(want))[off].all()


def brute(sets, threshold=0.8):
    n = len(sets)
    pairs = [(i, j) for i in range(n) for j in range(i) if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9]
    deg = [0] * n
    for i, j in pairs:
        deg[i] += 1
        deg[j] += 1
    return deg, roots(n, pairs)


def word_sets(texts):
    from tidemark.llm.common import words
    out = []
    for t in texts:
        ws = words((t or "").encode())
        out.append({tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set())
    return out


def near_texts(seed, groups, most):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    line = " ".join(rnd.choice(vocab) for _ in range(14))
    out = []
    for _ in range(groups):
        ws = [rnd.choice(vocab) for _ in range(rnd.randrange(5, 160))]
        for _ in range(rnd.randrange(1, most)):
            v = list(ws)
            for _ in range(rnd.randrange(0, 4)):
                v[rnd.randrange(len(v))] = rnd.choice(vocab)
            out.append(" ".join(v) + (" " + line if rnd.random() < 0.5 else ""))
    return out


@pytest.mark.parametrize("split, chunk, weight", [(512, 1024, 1 << 21), (3, 4, 600)])
def test_ngram_join_by_brute_force(spark, split, chunk, weight):
    texts = near_texts(3, 60, 9) + [None, "", " ., ", "one two", "One, two!", "a b c d e", "a b c d e"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    deg, comp = brute(word_sets(texts))
    got = {r.doc_id: r for r in ngram_join(docs, split=split, chunk=chunk, chunk_weight=weight).collect()}
    assert len(got) == len(texts)
    found = sum(got[i].n_links for i in range(len(texts)))
    assert all(got[i].n_links <= deg[i] for i in got) and found >= (1 if split == 512 else 0.99) * sum(deg)
    assert [got[i].component_id for i in range(len(texts))] == comp
    kept = sorted(r.doc_id for r in drop_near_copies(docs, split=split).collect())
    assert kept == sorted({c for c in comp})


def test_ngram_join_hot_groups(spark):
    rnd = random.Random(2)
    base = [f"h{i}" for i in range(120)]
    near = []
    for i in range(300):
        v = list(base)
        v[rnd.randrange(120)] = f"x{i}"
        near.append(" ".join(v))
    texts = near + ["the very same words in all of these"] * 250 + near_texts(5, 10, 3)
    deg, comp = brute(word_sets(texts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in ngram_join(docs, split=50, chunk=64).collect()}
    assert sum(r.n_links for r in got.values()) >= 0.99 * sum(deg) and all(got[i].n_links <= deg[i] for i in got)
    assert [got[i].component_id for i in range(len(texts))] == comp


def test_ngram_large_buckets_lose_no_links(spark):
    """Groups of more distinct near copies than a bucket may hold, and unlike documents that share long passages."""
    rnd = random.Random(8)
    texts = []
    for g in (119, 240):  # groups whose common words are seldom chosen at two levels of a run
        for i in range(560):
            v = [f"g{g}h{j}" for j in range(95)]
            v[rnd.randrange(95)] = f"x{i}"
            texts.append(" ".join(v))
    passage = " ".join(f"p{i}" for i in range(60))
    for i in range(600):
        own = " ".join(f"u{i // 2}w{j}" for j in range(60))
        texts.append(f"{passage} {own} {f'end{i}' if i % 2 else ''}")
    deg, comp = brute(word_sets(texts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in ngram_join(docs).collect()}
    assert [got[i].n_links for i in range(len(texts))] == deg
    assert [got[i].component_id for i in range(len(texts))] == comp


def test_ngram_recall_of_all_levels():
    once = (1 - np.exp(-1)) * (1 - np.exp(-WIDER))
    assert 1 - (1 - once) ** runs_for(0.8, 2, 0.99999, WIDER) >= 0.99999


def test_ngram_query(spark):
    d = "/root/testdata/sf0.01"
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect())
    deg, comp = brute(word_sets([t for _, t in rows]))
    out = sorted(QUERIES["op8_ngram_join"](spark, d).collect(), key=lambda r: r.doc_id)
    assert [(r.n_links, r.component_id) for r in out] == [(g, rows[c][0]) for g, c in zip(deg, comp)]


def test_ngram_awkward(spark):
    docs = awkward(spark)
    out = ngram_join(docs).collect()
    assert len(out) == docs.count() and sum(r.doc_id == 3 and r.n_links == 3 for r in out) == 4
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 3").count() == 1 and kept.where("doc_id is null").count() == 2
    assert kept.where("doc_id between 60 and 62").count() == 3
    assert ngram_join(awkward(spark, empty=True)).count() == 0 == drop_near_copies(awkward(spark, empty=True)).count()


def test_jaccard_matrix_and_runs():
    rnd = random.Random(9)
    k = WordHashes()
    sets = [shingles(t.encode(), 5, k) for t in near_texts(1, 12, 4)]
    want = [[len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b)) for b in sets] for a in sets]
    off = ~np.eye(len(sets), dtype=bool)      # a set is not a partner of itself
    assert (jaccard_links(sets, sets, 0.8, width=7) == want)[off].all()
    assert (jaccard_links(sets[:5], list(sets[5:]), 0.8) == np.array(want)[:5, 5:]).all()
    assert 1 - (1 - (1 - np.exp(-1)) ** 2) ** runs_for(0.8, 2, 0.99) >= 0.99 and rnd


# ---- vectors --------------------------------------------------------------------------
def test_hadamard():
    h = np.array([[1]])
    for _ in range(4):
        h = np.block([[h, h], [h, -h]])
    x = np.random.default_rng(1).normal(size=(3, 16))
    assert np.allclose(hadamard(x), x @ h / 4)


def brute_vectors(x, threshold=0.95):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = u @ u.T >= threshold
    np.fill_diagonal(hit, False)
    return hit.sum(1), roots(len(x), zip(*np.nonzero(np.triu(hit))))


@pytest.mark.parametrize("chunk", [1024, 16])
def test_near_vectors_by_brute_force(spark, chunk):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(150, 24))
    x = np.concatenate([c + rng.normal(scale=s, size=(int(m), 24)) for c, s, m in zip(centres, rng.choice([0.02, 0.15, 0.25], 150), rng.integers(1, 9, 150))]
                       + [centres[0] + rng.normal(scale=0.05, size=(120, 24))] + [np.repeat(centres[1:2], 90, 0)]).astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    deg, comp = brute_vectors(x)
    got = {r.vec_id: r for r in near_vectors(df, chunk=chunk).collect()}
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= deg).all() and found.sum() >= 0.97 * deg.sum()
    assert np.mean([got[i].component_id == c for i, c in enumerate(comp)]) > 0.98
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_vector_query_and_recall(spark):
    d = "/root/testdata/sf0.01"
    rows = sorted((r.vec_id, r.embedding) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect())
    deg, comp = brute_vectors(np.array([v for _, v in rows], float))
    out = sorted(QUERIES["op7_near_vectors"](spark, d).collect(), key=lambda r: r.vec_id)
    assert [(r.n_links, r.component_id) for r in out] == [(g, rows[c][0]) for g, c in zip(deg.tolist(), comp)]
    for n in (500, 50_000, 10**8):
        assert plan(n, 64, 0.95, 0.9)[1] < 60


def test_vectors_awkward(spark):
    nan, inf = float("nan"), float("inf")
    vecs = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.1]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]),
            (9, [None, 1.0]), (None, [1.0, 0.01]), (1, [1.0, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [-1.0, 0.0]), (None, None), (12, [1e-30, 0.0]), (None, [0.0, 5.0])]
    df = spark.createDataFrame([(*v, 3, "x") for v in vecs], "vec_id long, embedding array<double>, id int, k1 string")
    out = near_vectors(df).collect()
    assert len(out) == len(vecs)
    got = defaultdict(list)
    for r in out:
        got[r.vec_id].append((r.n_links, r.component_id, r.kept))
    assert got[1] == [(5, 1, True)] * 2 and got[2] == got[12] == [(5, 1, False)] and got[3] == [(5, 1, False)]
    assert all(got[i] == [(0, i, True)] for i in (4, 5, 6, 7, 8, 9, 10, 11))
    assert sorted(got[None], key=repr) == sorted([(5, 1, False), (0, None, False), (0, None, False)], key=repr)
    assert near_vectors(df.limit(0)).count() == 0


def test_blocks_count_pairs_once(spark):
    """Members meet in many buckets of all sizes; every pair is counted once."""
    rnd = random.Random(7)
    ids = list(range(60))
    buckets = [(b, rnd.sample(ids, rnd.randrange(1, 40))) for b in range(30)]
    m = spark.createDataFrame([(b, i, 1) for b, s in buckets for i in s], "bucket long, id long, weight long")
    at = blocks.members_of(m, blocks.distinct_buckets(m))
    data = spark.createDataFrame([(i, 2, bytes([i % 5])) for i in ids], "id long, mult long, data binary")
    out = blocks.links(data.join(at, "id"), lambda a, b: np.array([[x == y for y in b] for x in a]), 8, 100)
    got = defaultdict(int)
    for r in out.collect():
        got[r.id] += r.links
    meet = {(i, j) for _, s in buckets for i in s for j in s if i != j and i % 5 == j % 5}
    assert got == {i: n for i in ids if (n := 2 * sum(a == i for a, _ in meet))}
