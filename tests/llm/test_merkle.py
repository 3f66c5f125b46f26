import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cases import awkward
from tidemark.llm.merkle import Manifest, address, addresses, build, fold, hashed, merkle_digest, node, pack_path, siblings
from tidemark.llm.queries import QUERIES


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, more=0):
    def one(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    n = None if r.n_chars is None else r.n_chars + more
    return h(*[one(v) for v in (r.doc_id, r.source, r.lang, n, r.text)])


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def path_in(levels, p):
    out = []
    for level in levels[:-1]:
        if (p ^ 1) < len(level):
            out.append((p & 1, level[p ^ 1]))
        else:
            out.append((0, None))
        p >>= 1
    return out


def brute(rows):
    """Rows of the contract by one plain tree per language."""
    by = {}
    for r in rows:
        by.setdefault(r.lang, []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for x in langs:
        by[x].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r)))
        trees[x] = levels_of([leaf_of(r) for r in by[x]])
    crown = levels_of([trees[x][-1][0] for x in langs])
    out = []
    for i, x in enumerate(langs):
        for p, r in enumerate(by[x]):
            path = path_in(trees[x], p) + path_in(crown, i)
            tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            at = leaf_of(r, 1 if tampered else 0)
            for left, s in path:
                at = h(at) if s is None else h(s, at) if left else h(at, s)
            root = crown[-1][0]
            out.append((r.doc_id, leaf_of(r), trees[x][-1][0], root, h(*[s for _, s in path if s]), at, at == root))
    return out


@pytest.mark.parametrize("height", [0, 1, 2, 3, 5, 8, 12])
def test_addresses_are_a_layout(height):
    places = addresses(height)
    assert sorted(a for level in places for a in level) == list(range((2 << height) - 1))
    assert places[height] == [0]    # the root comes first


def test_layout_is_recursive():
    # height 3: upper two levels (0-2), then four subtrees of two levels, three places each
    assert [address(1, i, 3) for i in range(2)] == [1, 2]
    assert [address(2, i, 3) for i in range(4)] == [3, 6, 9, 12]
    assert [address(3, i, 3) for i in range(8)] == [4, 5, 7, 8, 10, 11, 13, 14]


@pytest.mark.parametrize("n,top", [(1, 0), (1, 3), (2, 1), (5, 3), (8, 3), (9, 4), (3, 8)])
def test_block(n, top):
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
    payload = bytes(build(leaves, top))
    for i in range(n):
        assert node(payload, top, 0, i) == leaves[i]
        packed = pack_path(siblings(payload, n, top, i))
        assert fold(leaves[i], packed) == payload[:32]
        assert fold(hashed([leaves[i]]), packed) != payload[:32]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("height", [1, 3, 8])
def test_awkward_against_brute_force(spark, height):
    docs = awkward(spark, 90)
    got = merkle_digest(docs.repartition(5), height)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert rows_of(got) == sorted(brute(docs.collect()), key=repr)


def test_op13_query(spark):
    d = "/root/testdata/sf0.001"
    got = QUERIES["op13_merkle_manifest"](spark, d)
    want = brute(spark.read.parquet(f"{d}/documents.parquet").collect())
    assert rows_of(got) == sorted(want, key=repr)
    assert {w[-1] for w in want} == {True, False}


def test_many_groups_and_equal_rows(spark):
    rnd = random.Random(3)
    rows = [(i % 50, "same", f"l{rnd.randrange(40)}", "s", 4) for i in range(400)] + [(7, "same", "l1", "s", 4)] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert rows_of(merkle_digest(docs, 2)) == sorted(brute(docs.collect()), key=repr)


def test_empty_and_random_access(spark):
    docs = awkward(spark, empty=True)
    assert merkle_digest(docs).collect() == []
    leaves = spark.range(77).select(F.lit("a").alias("g"), "id", F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("node"))
    tree = Manifest(leaves, ["id"], height=3)
    levels = levels_of([h(str(i)) for i in range(77)])
    assert tree.root().hex() == levels[-1][0]
    for p in (0, 41, 76):
        got = [(left, s.hex() if s else None) for left, s in tree.path("a", p)]
        assert [s for _, s in got] == [s for _, s in path_in(levels, p)]
        assert fold(bytes.fromhex(levels[0][p]), pack_path(tree.path("a", p))).hex() == levels[-1][0]
    with pytest.raises(KeyError):
        tree.path("b", 0)
    assert Manifest(leaves.where("id < 0"), ["id"]).root() is None
