import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cases import awkward
from tidemark.llm.encoding import PieceEncoder, end_each
from tidemark.llm.packing import decompose, pack_sequences, read_sequences, write_sequences
from tidemark.llm.queries import QUERIES
from tidemark.session import work_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOK = Tokenizer.from_file(PATH)
ENC = PieceEncoder(open(PATH).read(), 50)

texts = st.none() | st.text(max_size=60) | st.text("ab 'stREre1\n\t.é  ,", max_size=80) | st.text("ab1 ,.\n", max_size=14)


@settings(max_examples=400, deadline=None)
@given(st.lists(texts, max_size=8))
def test_batch_ids_equal_whole_texts(batch):
    got = ENC.encode_all(pa.array(batch, pa.string()))
    assert [x.tolist() for x in got] == [TOK.encode(t or "", add_special_tokens=False).ids for t in batch]


@pytest.mark.parametrize("size", [1, 8, 1024])
def test_decompose(size):
    lengths = np.arange(3 * size + 5)
    pieces, doc = decompose(lengths, size)
    assert (np.bincount(doc, pieces, len(lengths)) == lengths).all()
    for n in lengths:
        own = pieces[doc == n].tolist()
        assert own == sorted(own, reverse=True) and all(p & (p - 1) == 0 and p <= size for p in own)
        assert all(c == 1 for p, c in Counter(own).items() if p < size)
    with pytest.raises(ValueError):
        decompose(lengths, 6)


def test_end_each():
    ids, lengths = end_each([np.array([5, 6], np.uint32), np.zeros(0, np.uint32)], 9)
    assert ids.tolist() == [5, 6, 9, 9] and lengths.tolist() == [3, 1]
    assert [len(x) for x in end_each([], 9)] == [0, 0]


def check(rows, docs, max_length=1024):
    """Rows against brute force: pieces of each document, and the law of sequences."""
    want = Counter()
    for doc_id, text in docs:
        ids = np.array(TOK.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        while at < len(ids):
            n = min(max_length, 1 << ((len(ids) - at).bit_length() - 1))
            want[doc_id, at, n, zlib.crc32(ids[at:at + n].tobytes()), len(ids)] += 1
            at += n
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    by_length = [r.length for r in sorted(rows, key=lambda r: r.sequence_id)]
    assert by_length == sorted(by_length, reverse=True)


def test_op11_query(spark):
    d = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    out = QUERIES["op11_packing"](spark, d)
    assert out.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    rows = out.collect()
    assert {r.offset for r in rows} == {0}
    check(rows, docs)


def test_packing_awkward_and_batches(spark):
    from pyspark.sql import functions as F
    docs = awkward(spark).repartition(3)
    path = work_path(spark, "test-sequences")
    write_sequences(docs, path, PATH, max_length=64)
    out = read_sequences(spark, path, batch_tokens=256)
    rows = out.withColumn("ids_crc32", F.crc32("ids")).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()], 64)
    for r in rows:
        assert len(r.ids) == 4 * r.length and r.length == 1 << r.bucket
    tokens = Counter()
    for r in rows:
        tokens[r.bucket, r.batch] += r.length
    assert max(tokens.values()) == 256
    assert all(n == 256 for (k, b), n in tokens.items() if (k, b + 1) in tokens)
    text = "".join(TOK.decode(np.frombuffer(r.ids, "<u4").tolist(), skip_special_tokens=False)
                   for r in sorted((r for r in rows if r.doc_id == 64), key=lambda r: r.start))
    assert text.removesuffix(TOK.decode([0])) == "日本語 テキスト 😀 ñandú"


def test_packing_empty(spark):
    assert pack_sequences(awkward(spark, empty=True), PATH).collect() == []
