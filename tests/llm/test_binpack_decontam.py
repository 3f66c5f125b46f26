import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cases import awkward
from tidemark.llm.binpack import bits_for, document_ids, make_block, open_block, pack, tokenize_to_files, unpack
from tidemark.llm.common import words
from tidemark.llm.encoding import PieceEncoder
from tidemark.llm.decontam import SuffixAutomaton, contamination, merged, remove_contamination
from tidemark.llm.queries import QUERIES
from tidemark.session import work_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOK = Tokenizer.from_file(PATH)


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 32])
def test_pack_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 70_001, dtype=np.uint64).astype(np.uint32)
    buf = pack(ids, bits)
    assert len(buf) == -(-len(ids) * bits // 8)
    for a, b in ((0, len(ids)), (5, 5), (65_530, 65_545), (70_000, 70_001), (123, 4567)):
        assert (unpack(buf, bits, a, b) == ids[a:b]).all()
    assert bits_for(2**bits) == bits


def test_block_round_trip():
    ids = [np.arange(5), np.zeros(0, int), np.array([50_256])]
    bits, docs, offsets, packed = open_block(make_block([3, None, -9], ids, 16))
    assert (bits, docs, offsets.tolist()) == (16, [3, None, -9], [0, 5, 5, 6])
    assert unpack(packed, bits, 5, 6).tolist() == [50_256]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60) | st.text("ab 'stREre1\n\t.é  ,", max_size=80))
def test_pieces_equal_whole_text(text):
    enc = test_pieces_equal_whole_text.__dict__.setdefault("enc", PieceEncoder(open(PATH).read(), 50))
    assert enc.encode(text).tolist() == TOK.encode(text, add_special_tokens=False).ids


def expected(rows):
    ids = {d: TOK.encode(t or "", add_special_tokens=False).ids + [0] for d, t in rows}
    out, start = {}, 0
    for d in sorted(ids):
        x = np.array(ids[d], "<u4")
        out[d] = (start, len(x), zlib.crc32(x.tobytes()))
        start += len(x)
    return out


def test_op3_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    out = QUERIES["op3_token_output"](spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in out} == expected(rows) and len(out) == len(rows)


def test_packed_awkward(spark):
    docs = awkward(spark)
    path = work_path(spark, "test-packed")
    out = tokenize_to_files(docs.repartition(4), PATH, 50_257, path).collect()
    src = docs.collect()
    assert len(out) == len(src)
    at = 0
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert at == sum(len(TOK.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in src)
    order = [r.doc_id for r in sorted(out, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d))
    text = {r.doc_id: r.text for r in src}
    for d in (0, 17, 63):
        (ids,) = document_ids(spark, path, d)
        assert TOK.decode(ids[:-1].tolist()) == (text[d] or "") and ids[-1] == 0
    assert len(document_ids(spark, path, 3)) == 4
    assert tokenize_to_files(awkward(spark, empty=True), PATH, 50_257).count() == 0


def brute(doc, items, window):
    ws, hit, found = doc, set(), set()
    for name, item in items:
        n = min(window, len(item))
        for k in range(len(item) - n + 1 if n else 0):
            for i in range(len(ws) - n + 1):
                if ws[i:i + n] == item[k:k + n]:
                    hit.update(range(i, i + n))
                    found.add(name)
    return hit, found


@settings(max_examples=300, deadline=None)
@given(st.randoms(use_true_random=False), st.integers(1, 5))
def test_automaton_equals_brute_force(rnd, window):
    w = [b"a", b"b", b"c"]
    items = [(str(i % 5), [rnd.choice(w) for _ in range(rnd.randrange(0, 12))]) for i in range(rnd.randrange(0, 8))]
    auto = SuffixAutomaton(items, window)
    for _ in range(3):
        doc = [rnd.choice([*w, b"z"]) for _ in range(rnd.randrange(0, 40))]
        hits, names = auto.scan(doc)
        assert ({x for a, b in merged(hits) for x in range(a, b)}, names) == brute(doc, items, window)


def test_op4_query(spark):
    d = "/root/testdata/sf0.001"
    items = [(str(r.item_id), words(r.text.encode())) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    grams = {}
    for name, ws in items:
        n = min(10, len(ws))
        for k in range(len(ws) - n + 1):
            grams.setdefault(tuple(ws[k:k + n]), set()).add(name)
    want = {}
    for r in spark.read.parquet(f"{d}/documents.parquet").collect():
        ws = [m.encode() for m in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))]
        hit, found = set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(ws) - n + 1):
                if g := grams.get(tuple(ws[i:i + n])):
                    hit.update(range(i, i + n))
                    found |= g
        want[r.doc_id] = (len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    out = QUERIES["op4_decontamination"](spark, d).collect()
    assert {r.doc_id: tuple(r)[1:] for r in out} == want and any(r.contaminated for r in out)


def test_decontamination_awkward(spark):
    docs = awkward(spark)
    rnd = random.Random(1)
    texts = [r.text for r in docs.collect() if r.text]
    bench = [(1, " ".join(texts[4].split()[2:20])), (None, "alpha1"), (2, None), (3, ""), (1, texts[9]), (4, "long words " * 8),
             *[(10 + i, " ".join(rnd.choice(texts).split()[:9])) for i in range(4)]]
    items = spark.createDataFrame(bench, "item_id long, text string")
    whole = contamination(docs, items).collect()
    blocked = contamination(docs, items, block_bytes=40).collect()
    assert sorted(map(repr, whole)) == sorted(map(repr, blocked)) and len(whole) == len(texts) + docs.where("text is null or text = ''").count()
    parsed = [(None if n is None else str(n), words((t or "").encode())) for n, t in bench]
    by = {r.doc_id: r for r in whole}
    for r in docs.where("doc_id < 60").collect():
        hit, found = brute(words(r.text.encode()), parsed, 10)
        assert (by[r.doc_id].n_hit, by[r.doc_id].n_items) == (len(hit), len(found - {None}))
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(docs, none).where("contaminated").count() == 0
    assert contamination(awkward(spark, empty=True), items).count() == 0


def test_removal_by_blocks(spark):
    """A document cut by items of several blocks loses the words of all, as it does in one block."""
    rnd = random.Random(9)
    items = [(i, " ".join(f"v{rnd.randrange(500)}" for _ in range(25))) for i in range(12)]
    docs = [(i, " ".join(f"u{rnd.randrange(900)}" for _ in range(80)) + ", " + items[i % 12][1] + ". " + " ".join(
        items[(i + 1) % 12][1].split()[:14]) + " " + " ".join(f"u{rnd.randrange(900)}" for _ in range(60))) for i in range(30)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, remove_contamination(d, b).collect()))
    assert sorted(map(tuple, remove_contamination(d, b, block_bytes=300).collect())) == whole
    assert len(whole) == 30 and not any("v" in t for _, t in whole)


def test_removal_cuts_and_drops(spark):
    item = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"Some text before, {item.upper()}. And some more after that one, and much more text to keep it whole."),
                                  (2, item), (3, "clean"), (4, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = {r.doc_id: r.text for r in remove_contamination(docs, items).collect()}
    assert out == {1: "Some text before, . And some more after that one, and much more text to keep it whole.", 3: "clean", 4: None}
    a = awkward(spark)
    assert remove_contamination(a, items).columns == a.columns and remove_contamination(a, items).count() == a.count()
