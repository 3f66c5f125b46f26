import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cases import awkward
from tidemark.llm import langid, licenses, pii, toxicity
from tidemark.llm.common import held_out
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def with_truth(spark, name, cols):
    docs = spark.read.parquet(f"{SF}/{name}.parquet").select("doc_id", *cols)
    return docs


# ---- language -------------------------------------------------------------------------
def test_language_held_out_accuracy(spark):
    out = QUERIES["op10_language_id"](spark, SF).join(with_truth(spark, "documents", ["lang"]), "doc_id").collect()
    assert len(out) == 1000
    kept = [r for r in out if r.held_out]
    assert len(kept) > 150 and np.mean([r.lang_pred == r.lang for r in kept]) > 0.98
    assert all(0 <= r.score <= 1 for r in out)


def test_language_scores_by_brute_force():
    text = "Ontier ätion, the and".encode()
    vec = np.zeros(langid.DIMENSIONS)
    low = " ontier ätion  the and "
    v, table = langid.letters(), langid.symbol_table()
    for a, b, c in zip(low, re.sub("  ", " ", low)[1:], re.sub("  ", " ", low)[2:]):
        pass
    clean = " " + " ".join(re.findall(r"\w+", low)) + " "
    for a, b, c in zip(clean, clean[1:], clean[2:]):
        if b != " ":
            s = [table[ord(x)] for x in (a, b, c)]
            vec += np.roll(v[s[0]], 2).astype(float) * np.roll(v[s[1]], 1) * v[s[2]]
    protos = np.random.default_rng(1).normal(size=(3, langid.DIMENSIONS))
    want = protos @ vec / np.linalg.norm(vec) / np.linalg.norm(protos, axis=1)
    got, has = langid.cosines([text, None, b"12 ,"], protos)
    assert np.allclose(got[0], want, atol=1e-5) and has.tolist() == [True, False, False] and not got[1:].any()


def test_language_awkward(spark):
    out = langid.identify(awkward(spark)).collect()
    assert len(out) == awkward(spark).count()
    by = {r.doc_id: r for r in out}
    assert {by[60].lang_pred, by[61].lang_pred, by[62].lang_pred} == {"und"} and by[60].score == 0
    assert by[63].lang_pred in ("en", "de", "xx")
    nothing = langid.identify(awkward(spark).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    assert langid.identify(awkward(spark, empty=True)).count() == 0
    kept = langid.keep_identified(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert {60, 61, 62}.isdisjoint({r.doc_id for r in kept.collect()}) and kept.where("doc_id < 60").count() == 63


def test_language_keeps_all_with_letters(spark):
    """Single words, codes and texts in scripts without labels stay, as op10 names a language for them."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rnd = random.Random(4)
    words = sorted({w for r in docs.limit(300).collect() for w in (r.text or "").split() if any(c.isalpha() for c in w)})
    short = rnd.sample(words, 400) + ["".join(rnd.choice("bcdfgklmnprstvwxz") for _ in range(5)) for _ in range(200)]
    short += [" ".join("".join(chr(rnd.randrange(0x3b1, 0x3c9)) for _ in range(6)) for _ in range(80)) for _ in range(20)]
    more = spark.createDataFrame([(10**9 + i, t, None) for i, t in enumerate([*short, None, "", "12 - 7"])], docs.schema)
    every = docs.unionByName(more)
    named = {r.doc_id for r in langid.identify(every).where("lang_pred != 'und'").collect()}
    assert {r.doc_id for r in langid.keep_identified(every).collect()} == named and {10**9 + i for i in range(len(short))} <= named
    assert not {10**9 + len(short) + i for i in range(3)} & named


def test_language_copies_of_one_text_do_not_fill_the_sample(spark):
    """50,000 copies of one text beside 400 others: the others are learnt as well."""
    copies = spark.range(50_000).select("id", F.lit("zzz zzz zzz").alias("text"), F.lit("xx").alias("lang"))
    rest = spark.range(400).select((F.col("id") + 60_000).alias("id"), F.concat(F.lit("abc bca cab "), F.col("id").cast("string")).alias("text"),
                                   F.when(F.col("id") < 200, "xx").otherwise("yy").alias("lang"))
    docs = copies.unionByName(rest).withColumnRenamed("id", "doc_id")
    langs, prototypes = langid.learn(docs, "text", "lang", 100)
    assert langs == ["xx", "yy"]
    near, _ = langid.cosines([b"zzz zzz zzz", b"abc bca cab 7"], prototypes)
    assert near[0].argmax() == 0 and near[1].argmax() == 1


def test_language_ignores_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    other = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    a, b = (langid.identify(x).select("doc_id", "lang_pred").collect() for x in (docs, other))
    assert sorted(a) == sorted(b)


# ---- toxicity -------------------------------------------------------------------------
def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    out = QUERIES["op5_toxicity"](spark, d).join(spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    hit = sum(r.predicted and r.toxic for r in out)
    assert hit / sum(r.toxic for r in out) > 0.9 and hit / sum(r.predicted for r in out) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)


def test_nnpu_recovers_the_posterior():
    rng = np.random.default_rng(0)
    prior, n = 0.3, 20_000
    y = rng.random(n) < prior
    x = (rng.random((n, 2)) < np.where(y[:, None], [0.8, 0.5], [0.1, 0.5])).astype(np.float32)
    w, b = toxicity.fit_nnpu(x[y][:2000], x, prior, steps=1500)
    for v, p in ((1, 0.8), (0, 0.2)):
        q = 0.1 if v else 0.9
        want = prior * p / (prior * p + (1 - prior) * q)
        assert abs(toxicity.sigmoid(np.array([v * w[0] + b + 0.5 * w[1]]))[0] - want) < 0.07


def test_toxicity_sample_is_bounded_by_rows(spark):
    hot = spark.range(20_000).select(F.lit(5).cast("long").alias("doc_id"), F.concat(F.lit("vile text "), F.col("id")).alias("text"))
    docs = hot.unionByName(spark.range(200).select((F.col("id") + 100).alias("doc_id"), F.concat(F.lit("good text "), F.col("id")).alias("text")))
    labels = spark.createDataFrame([(5, 1)] + [(100 + i, 0) for i in range(200)], "id long, toxic int")
    n = dict(toxicity._sampled(docs, labels, "doc_id", "text", 30, 60).groupBy("y").count().collect())
    assert n[1] == 30 and n[0] <= 60


def test_toxicity_scores_by_brute_force(spark):
    """Scores recomputed from the learnt weights, one document at a time."""
    docs = awkward(spark)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    weights, bias = toxicity.learn(docs, labels, least_ratio=0.0, lift=1.01)
    assert weights
    got = sorted((repr(r.doc_id), round(r.score, 9), r.predicted)
                 for r in toxicity.toxicity(docs, labels, least_ratio=0.0, lift=1.01).collect())
    want = []
    for r in docs.collect():
        z = bias + sum(w for f, w in weights.items() if f in toxicity.features(r.text.encode() if r.text is not None else None))
        score = 1 / (1 + np.exp(-z))
        want.append((repr(r.doc_id), round(float(score), 9), int(score >= 0.3)))
    assert got == sorted(want)


def test_toxicity_awkward(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(i, i % 2, int(i % 7 == 0)) for i in range(50)] + [(None, 1, 1), (3, None, None), (3, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    none = toxicity.toxicity(docs, labels.where("toxic = 0")).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.toxicity(awkward(spark, empty=True), labels).count() == 0
    assert toxicity.toxicity(docs, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.drop_toxic(docs, labels).columns == docs.columns


# ---- licences -------------------------------------------------------------------------
def brute_base(text):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at, labels = [], set()
    for p, label in licenses.BASE.items():
        p = p.split()
        for i in range(len(ws) - len(p) + 1):
            if ws[i:i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(ws), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_license_query(spark):
    src = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = QUERIES["op6_license_scan"](spark, SF).collect()
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out} == {k: brute_base(v) for k, v in src.items()}
    assert any(r.n_base for r in out) and all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in out)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["mit", "License", "apache", "GENERAL", "public", "license", "x", "mit license", "é"]), max_size=30))
def test_license_places_by_brute_force(ws):
    text = ", ".join(ws)
    assert licenses.scan(text.encode())[:5] == brute_base(text)


@pytest.mark.parametrize("line, names, free", [
    ("MIT", {"mit"}, True), ("GPL-2.0-only OR MIT", {"gpl", "mit"}, True), ("GPL-2.0-only AND MIT", {"gpl", "mit"}, False),
    ("MIT AND (GPL-3.0+ OR Apache-2.0)", {"mit", "gpl", "apache"}, True), ("MIT OR GPL-2.0 AND GPL-3.0", {"mit", "gpl"}, True),
    ("(MIT OR GPL-2.0) AND GPL-3.0", {"mit", "gpl"}, False), ("GPL-2.0 WITH Classpath-exception-2.0 or BSD-3-Clause", {"gpl", "bsd"}, True)])
def test_expressions(line, names, free):
    assert licenses.evaluate(licenses.read_expression(line)) == (names, free)
    scanned = licenses.scan(f"x\n// SPDX-License-Identifier: {line}\nmore text".encode())
    assert set(scanned[5].split(",")) == names and scanned[7] is free and scanned[6] == 0.95


@pytest.mark.parametrize("line", ["", "AND MIT", "(MIT", "MIT OR"])
def test_broken_expressions(line):
    with pytest.raises(ValueError):
        licenses.evaluate(licenses.read_expression(line))
    scanned = licenses.scan(f"SPDX-License-Identifier: {line}\n".encode())
    assert scanned[6] == 0.5 and scanned[7] is None


def test_license_awkward(spark):
    out = licenses.license_scan(awkward(spark)).collect()
    assert len(out) == awkward(spark).count()
    assert licenses.license_scan(awkward(spark, empty=True)).count() == 0
    assert licenses.scan(None) == (0, 0, None, None, "", "", 0.0, None)


# ---- personal data --------------------------------------------------------------------
def brute_spans(text):
    out = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), m.end(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        if 14 <= len(d) <= 19 and (sum(d[-1::-2]) + sum(x * 2 - 9 * (x > 4) for x in d[-2::-2])) % 10 == 0:
            out.append((m.start(), m.end(), 2))
    out += [(m.start(), m.end(), 3) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


@settings(max_examples=600, deadline=None)
@given(st.text("01@.+-a (9)é", max_size=60) | st.lists(st.sampled_from(
    ["a.b@c.de", "@", ".", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "+1 (555) 123-4567", "x", " ", "-", "7", "."]), max_size=12).map("".join))
def test_base_spans_by_brute_force(text):
    assert pii.base_spans(text) == brute_spans(text)


def test_base_spans_linear():
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "+1" + "(" * 400_000, "a@" * 200_000):
        pii.base_spans(text)


def test_gradient_by_differences():
    rng = np.random.default_rng(3)
    t = pii.Tagger(hidden=3)
    t.p = {k: v.astype(np.float64) for k, v in t.p.items()}
    x, y = rng.integers(0, 130, (4, 7)).astype(np.uint8), rng.integers(0, pii.TAGS, (4, 7)).astype(np.uint8)
    _, grad = t.loss_and_grad(x, y)
    for k, p in t.p.items():
        i = np.unravel_index(np.abs(grad[k]).argmax(), p.shape)
        old, e = p[i], 1e-3
        p[i] = old + e
        up = t.loss_and_grad(x, y)[0]
        p[i] = old - e
        down = t.loss_and_grad(x, y)[0]
        p[i] = old
        assert abs((up - down) / (2 * e) - grad[k][i]) < 2e-2 * max(0.05, abs(grad[k][i])), k


def test_viterbi_by_brute_force():
    import itertools
    rng = np.random.default_rng(5)
    t = pii.Tagger(hidden=2)
    t.p["trans"] = rng.normal(size=(pii.TAGS, pii.TAGS)).astype(np.float32)
    x = rng.integers(0, 130, (2, 4)).astype(np.uint8)
    e, best = t.emissions(x)[0], t.decode(x)
    for n in range(2):
        score = lambda s: sum(e[i][n, c] for i, c in enumerate(s)) + sum(t.p["trans"][a, b] for a, b in zip(s, s[1:]))
        assert tuple(best[n]) == max(itertools.product(range(pii.TAGS), repeat=4), key=score)


def synthetic(n, seed):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        words = ["".join(rnd.choice("abcdeinorst") for _ in range(rnd.randrange(2, 8))) for _ in range(rnd.randrange(15, 60))]
        kind = rnd.randrange(4)
        num = lambda k: "".join(rnd.choice("0123456789") for _ in range(k))
        item = [f"{words[0]}.{num(2)}@{words[1]}.com", ".".join(str(rnd.randrange(1, 256)) for _ in range(4)), "4111111111111111",
                f"+1 ({num(3)}) {num(3)}-{num(4)}"][kind]
        words.insert(rnd.randrange(len(words)), item)
        out.append(" ".join(words))
    return out


def test_tagger_finds_shapes_and_adds_checked_spans():
    texts = synthetic(260, 1)
    rows = [w for t in texts for w in pii.labelled_windows(t)]
    x = np.full((len(rows), pii.WINDOW), pii.PAD, np.uint8)
    y = np.zeros_like(x)
    for i, (_, a, b) in enumerate(rows):
        x[i, :len(a)], y[i, :len(b)] = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    tagger = pii.train(x, y)
    fresh = synthetic(80, 2)
    found = pii.added_spans(tagger, fresh, [[] for _ in fresh])  # without base spans the tagger must find them itself
    truth = [pii.base_spans(t) for t in fresh]
    hit = sum(any(a < e and s < b and k == kind for a, b, k in f) for f, t in zip(found, truth) for s, e, kind in t)
    assert hit / sum(map(len, truth)) > 0.8
    assert pii.added_spans(tagger, fresh, truth) == [[] for _ in fresh] or all(
        not any(a < e and s < b for s, e, _ in t) for f, t in zip(pii.added_spans(tagger, fresh, truth), truth) for a, b, _ in f)
    long = " ".join(fresh)
    every = [pii.window_starts(len(long))]
    assert all(b - a <= pii.WINDOW for a, b in zip(every[0], every[0][1:])) and every[0][-1] + pii.WINDOW >= len(long)


def test_windows_are_decoded_as_far_as_spans_reach():
    """The same spans as from all windows, also where names are longer than a window."""

    class Letters:
        """Tags runs of letters, digits, dots and @ between spaces, which hold any dot, as e-mail."""

        def decode(self, x):
            inside = (x != 32) & (x != pii.PAD)
            y = np.where(inside, 2, 0).astype(np.uint8)
            y[:, 1:][inside[:, 1:] & ~inside[:, :-1]] = 1
            return y

    rnd = random.Random(6)
    name = lambda k: "".join(rnd.choice("abcdeüéß") for _ in range(k))
    texts, truth = [], []
    for k in [5, 30, 60, 100, 200, 400] * 6:
        before = " ".join(name(rnd.randrange(2, 9)) for _ in range(rnd.randrange(60)))
        item = rnd.choice([f"{name(k)}@{name(k)}x.de", f"{name(3)}@{name(k)}x.de", f"{name(k)}.{name(k)}@x.de"])
        texts.append(f"{before} {item} " + " ".join(name(5) for _ in range(rnd.randrange(60))))
        truth.append((len(before) + 1, len(before) + 1 + len(item), 0))
    found = pii.added_spans(Letters(), texts, [[] for _ in texts])
    assert found == [[t] for t in truth]
    # as few windows as the spans need: a text of many windows and one mark is not decoded whole
    seen = []
    Letters.decode, old = lambda self, x: (seen.append(len(x)), old(self, x))[1], Letters.decode
    pii.added_spans(Letters(), ["word " * 5000 + "7 " + "word " * 5000], [[]])
    assert sum(seen) < 10


def test_rare_kinds_are_learnt_on_large_tables(spark):
    docs = spark.range(10_000).select(F.when(F.col("id") == 4321, "mail to some.one@example.org now").otherwise(
        F.concat(F.lit("call +49 30 1234567"), F.col("id") % 10, F.lit(" today"))).alias("t"))
    x, y = pii.training_set(docs, 20)
    tags = {pii.KINDS[(t - 1) // 2] for t in np.unique(y).tolist() if t}
    assert {"email", "phone"} <= tags and len(x) <= 20 * 6
    again, _ = pii.training_set(docs.repartition(7), 20)
    assert (x == again).all()


def test_pii_query_and_awkward(spark):
    d = "/root/testdata/sf0.001"
    src = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    out = QUERIES["op9_pii"](spark, d).collect()
    assert len(out) == len(src)
    for r in out:
        base = brute_spans(src[r.doc_id])
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, _, k in base) for i in range(4)]
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))
    docs = awkward(spark).withColumn("text", F.when(F.col("doc_id") < 9, F.concat("text", F.lit(" me@here.org +1 (555) 010-9999"))).otherwise(F.col("text")))
    small = pii.pii_digest(docs, train_windows=20).collect()
    assert len(small) == docs.count() and sum(r.n_email for r in small) == 12
    assert pii.pii_digest(awkward(spark, empty=True)).count() == 0
    assert pii.redact("a me@x.org b", [(2, 10, "email")]) == "a <email> b"
