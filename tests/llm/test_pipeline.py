from collections import Counter

import corpus_pipeline
from cases import awkward
from tidemark.llm.common import stage
from tidemark.llm.decontam import contamination

SF = "/root/testdata/sf0.01"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    seen = []
    for name, work in corpus_pipeline.STAGES[:-1]:
        out = stage(work(spark, docs, SF), "test-" + name)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        seen.append((docs, out))
        docs = out
    ids = [({r.doc_id for r in a.collect()}, [r.doc_id for r in b.collect()]) for a, b in seen]
    # languages: only texts without letters or unlike all languages go
    gone = ids[0][0] - set(ids[0][1])
    assert all(not any(c.isalpha() for c in r.text) for r in seen[0][0].collect() if r.doc_id in gone)
    # near copies: one document of a group stays
    from tidemark.llm.ngram_join import ngram_join
    assert sorted(ids[1][1]) == sorted(r.doc_id for r in ngram_join(seen[1][0]).where("kept").collect()) and len(ids[1][1]) < len(ids[1][0])
    # benchmark: nothing is hit any more, clean documents are as they were
    before = {r.doc_id: r for r in contamination(seen[2][0], items).collect()}
    assert any(r.contaminated for r in before.values()) and contamination(seen[2][1], items).where("contaminated").count() == 0
    texts, after = ({r.doc_id: r.text for r in x.collect()} for x in seen[2])
    assert all(after[d] == texts[d] for d, r in before.items() if not r.contaminated)
    assert all(r.n_chars == len(r.text) for r in seen[2][1].collect())
    # the mix repeats whole documents, three times at most
    assert max(Counter(ids[3][1]).values()) <= 3
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert Counter(r.doc_id for r in out) == Counter(ids[3][1])


def test_run_and_awkward(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at and r.n_tokens >= 1
        at += r.n_tokens
    for docs in (awkward(spark), awkward(spark, empty=True)):
        for _, work in corpus_pipeline.STAGES:
            docs = stage(work(spark, docs, SF), "test-awkward")
