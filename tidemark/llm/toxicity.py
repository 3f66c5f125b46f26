"""Operator 5: toxicity by non-negative positive-unlabelled learning.

Known: texts confirmed as toxic, and texts of which nothing is said. A linear model on
presence features (words and their first four to eight bytes, once, twice, four times) minimises the risk
estimator of Kiryo et al.: with class prior p, logistic loss l and model g,

    p E_P[l(g)] + max(0, E_U[l(-g)] - p E_P[l(-g)]),

stepping back where the second term is negative. The score is the logistic of g.

Fitted on a bounded sample: at most ``max_positive`` confirmed texts and
``max_unlabelled`` texts drawn without regard to labels, those of the lowest hash of the
id. Features that the positives hold less than ``lift`` times as often as the unlabelled,
or whose likelihood ratio is below ``least_ratio`` (chance would give one in 100,000), are
left out, so that length, common words and rare words have no say. The prior is the share of
confirmed texts among the labelled ones of the training rows.

Defined results: null and empty texts have no features and get the base score; repeated
rows score alike; null ids and null labels teach nothing; without any confirmed text all
scores are 0; an empty table gives an empty result; whole texts are scored, very long ones
too. Rows of one hash in the sample are taken in any order, as they are alike; a score equal
to the threshold is toxic. Other columns, whatever their names, are not read (``drop_toxic``
carries them along).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.llm.common import chance, fresh, held_out, lowest, slices, stage, text_bytes, words


#: Lengths in bytes of the word beginnings that are features.
BEGINNINGS = (4, 5, 6, 7, 8)


def features(text: bytes | None, heads: set[bytes] | None = None) -> set[bytes]:
    """Words and word beginnings (marked by a star) that occur, that occur twice and four times (marked so).

    With ``heads`` only of words whose first bytes are among them.
    """
    ws = Counter(words(text))
    if heads is not None:
        ws = {w: c for w, c in ws.items() if w[:BEGINNINGS[0]] in heads}
    times = Counter(ws)
    for n in BEGINNINGS:
        for w, c in ws.items():
            if len(w) > n:
                times[w[:n] + b"*"] += c
    out = set(times)
    out.update(f + b"#2" for f, c in times.items() if c >= 2)
    out.update(f + b"#4" for f, c in times.items() if c >= 4)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_nnpu(p: np.ndarray, u: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05, decay: float = 1e-3,
             back: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights and bias from feature matrices of positives and unlabelled, by Adam on the non-negative risk."""
    w = np.zeros(p.shape[1] + 1)
    w[-1] = np.log(prior / (1 - prior))
    p1, u1 = (np.hstack([x, np.ones((len(x), 1), x.dtype)]) for x in (p, u))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        gp, gu = p1 @ w, u1 @ w
        # logistic losses: l(g) = log(1 + exp(-g)); dl(-g)/dg = sigmoid(g)
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        d_neg = u1.T @ sigmoid(gu) / len(u) - prior * (p1.T @ sigmoid(gp)) / len(p)
        d_pos = -prior * (p1.T @ sigmoid(-gp)) / len(p)
        grad = -back * d_neg if negative < 0 else d_pos + d_neg
        grad = grad + decay * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def _sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, max_positive: int, max_unlabelled: int) -> DataFrame:
    """(y, doc, features) of the confirmed (y = 1) and of the unlabelled sample, staged."""
    pos = lowest(labels.where("toxic = 1").select("id").distinct(), max_positive, "id").withColumn("y", F.lit(1))
    ids = docs.select(F.col(id_col).alias("id")).where(F.col("id").isNotNull() & ~held_out(F.col("id"))).distinct()
    unl = lowest(ids, max_unlabelled, "id").withColumn("y", F.lit(0))
    chosen = F.broadcast(pos.unionByName(unl))  # at most max_positive + max_unlabelled ids
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(chosen, "id").withColumn("h", F.xxhash64("t"))
    # an id may have any number of rows: the bounds hold for rows as well
    order = Window.partitionBy("y").orderBy(chance("id", "h"), "id", "h")
    d = d.withColumn("n", F.row_number().over(order)).where(
        F.col("n") <= F.when(F.col("y") == 1, max_positive).otherwise(max_unlabelled)).select("t", "y")

    def found(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([
                b.column(1), pa.array([sorted(features(t)) for t in text_bytes(b, "t")], pa.list_(pa.binary()))], ["y", "f"])

    return stage(d.mapInArrow(found, "y int, f array<binary>").withColumn("doc", F.monotonically_increasing_id()), "tox-sample")


def select_features(sample: DataFrame, n: int, m: int, lift: float, least: float, most: int) -> list[bytes]:
    """Features that the n positives hold clearly more often than the m unlabelled (likelihood ratio of
    at least ``least``), the most telling first; counted on the executors."""
    counts = sample.select("y", F.explode("f").alias("f")).groupBy("f").agg(
        F.sum("y").alias("k"), F.sum(1 - F.col("y")).alias("u"))
    both = (F.col("k") + F.col("u")) / (n + m)

    def part(x, expected):
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)

    k, u = F.col("k").cast("double"), F.col("u").cast("double")
    ratio = 2 * (part(k, n * both) + part(n - k, n * (1 - both)) + part(u, m * both) + part(m - u, m * (1 - both)))
    kept = counts.where((k >= 3) & (k / n >= lift * (u + 0.5) / (m + 0.5))).withColumn("g", ratio).where(F.col("g") >= least)
    return [bytes(r.f) for r in kept.orderBy(F.desc("g"), "f").limit(most).collect()]


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_positive: int = 1500,
          max_unlabelled: int = 3000, lift: float = 3.0, least_ratio: float = 20.0,
          max_features: int = 2000) -> tuple[dict[bytes, float], float]:
    """Feature weights and bias, from rows that are not held out."""
    known = labels.select(F.col(id_col).alias("id"), F.col("toxic")).where(
        F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("id")))
    labelled, toxic = known.agg(F.count("*"), F.sum((F.col("toxic") == 1).cast("long"))).first()
    if not toxic:
        return {}, -np.inf
    prior = min(max(toxic / labelled, 0.01), 0.9)
    sample = _sampled(docs, known, id_col, text_col, max_positive, max_unlabelled)
    sizes = dict(sample.groupBy("y").count().collect())
    n, m = sizes.get(1, 0), sizes.get(0, 0)
    names = select_features(sample, n, m, lift, least_ratio, max_features) if n and m else []
    if not names:
        return {}, float(np.log(prior / (1 - prior)))
    place = {f: i for i, f in enumerate(names)}
    chosen = docs.sparkSession.createDataFrame([(bytearray(f), i) for f, i in place.items()], "f binary, i int")
    cells = (sample.select("y", "doc", F.explode("f").alias("f")).join(F.broadcast(chosen), "f")
             .groupBy("y", "doc").agg(F.collect_list("i").alias("i")).orderBy("y", "doc").collect())
    x = {1: np.zeros((n, len(names)), np.float32), 0: np.zeros((m, len(names)), np.float32)}
    at = {1: 0, 0: 0}          # documents without any of the features are the rows of zeros left over
    for y, _, some in cells:
        x[y][at[y], some] = 1
        at[y] += 1
    w, bias = fit_nnpu(x[1], x[0], prior)
    return {f: float(a) for f, a in zip(names, w)}, bias


def score(docs: DataFrame, weights: dict[bytes, float], bias: float, text_col: str, out: str) -> DataFrame:
    """``docs`` with a score column."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        # a word matters only if its first bytes begin some feature
        heads = {f.split(b"#")[0].rstrip(b"*")[:BEGINNINGS[0]] for f in weights}
        for b in slices(batches):
            g = [sum(weights.get(f, 0.0) for f in features(t, heads)) + bias for t in text_bytes(b, text_col)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sigmoid(np.array(g, float)), pa.float64())], [*b.schema.names, out])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3,
             **options) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    weights, bias = learn(docs, labels, id_col, text_col, **options)
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    d = score(d, weights, bias, "text", "score")
    return d.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text",
               **options) -> DataFrame:
    """``docs`` with scores below ``threshold``."""
    (s,) = fresh(docs, "_score")
    return score(docs, *learn(docs, labels, id_col, text_col, **options), text_col, s).where(F.col(s) < threshold).drop(s)
