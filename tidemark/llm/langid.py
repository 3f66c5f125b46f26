"""Operator 10: language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A trigram's vector binds (multiplies) its
three letter vectors, rotated by two, one and no places; a text's vector bundles (adds)
those of its trigrams, a language's prototype those of its training texts. The language
whose prototype has the highest cosine with the text's vector is predicted, the cosine
(0 at least) is the score.

Letters are the alphabetic characters in lower case; all else separates words and stands
as one symbol. a to z have symbols of their own, other letters share 37 by code point, so
a text has at most 64**3 different trigrams, whatever its alphabet.

Prototypes are fitted on a bounded sample: at most ``per_language`` training documents of
each language, those of the lowest row hash. Trigrams are counted on the executors; one
row per language and trigram reaches the driver.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is
everything when no language was learnt; ties go to the first language in code-point
order; null languages teach nothing; repeated rows are predicted alike; an empty table
gives an empty result; long texts are counted whole. Other columns, whatever their names, are
not read (``keep_identified`` carries them along).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidemark.llm.common import chance, fresh, held_out, slices, text_bytes

SYMBOLS = 64
DIMENSIONS = 512
UNDETERMINED = "und"


@cache
def symbol_table() -> np.ndarray:
    """Symbol of every code point; 0 is no letter."""
    t = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ord(ch.lower()[0])
            t[c] = low - 96 if 97 <= low <= 122 else 27 + low * 2654435761 % 2**32 % 37
    return t


def trigrams(text: bytes | None) -> np.ndarray:
    """Trigram numbers of a text, one per letter: it and its two neighbours."""
    if not text:
        return np.zeros(0, np.int64)
    s = symbol_table()[np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)]
    s = np.concatenate([[0], s, [0]]).astype(np.int64)
    s = s[np.concatenate([[True], (s[1:] > 0) | (s[:-1] > 0)])]
    t = (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]
    return t[s[1:-1] > 0]


@cache
def letters(seed: int = 11) -> np.ndarray:
    return np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), (SYMBOLS, DIMENSIONS))


def bind(t: np.ndarray) -> np.ndarray:
    """Vectors of trigrams."""
    v = letters()
    a, b, c = t // SYMBOLS**2, t // SYMBOLS % SYMBOLS, t % SYMBOLS
    return np.roll(v, 2, axis=1)[a] * np.roll(v, 1, axis=1)[b] * v[c]


def bundle(counts: dict[int, float]) -> np.ndarray:
    """Sum of the vectors of counted trigrams."""
    t, n = np.array(list(counts), np.int64), np.array(list(counts.values()), np.float64)
    out = np.zeros(DIMENSIONS)
    for i in range(0, len(t), 4096):
        out += n[i:i + 4096] @ bind(t[i:i + 4096]).astype(np.float64)
    return out


def cosines(texts: list[bytes | None], prototypes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cosines (texts x prototypes) and whether a text has letters."""
    grams = [trigrams(t) for t in texts]
    sizes = np.array([len(g) for g in grams])
    out = np.zeros((len(texts), len(prototypes)))
    if sizes.sum() and len(prototypes):
        every = np.concatenate(grams)
        seen = np.zeros(SYMBOLS**3, bool)
        seen[every] = True
        place = np.cumsum(seen) - 1
        k = int(place[-1]) + 1
        counts = np.bincount(np.repeat(np.arange(len(texts)), sizes) * k + place[every], minlength=len(texts) * k)
        vec = counts.reshape(len(texts), k).astype(np.float32) @ bind(np.flatnonzero(seen)).astype(np.float32)
        norm = np.linalg.norm(vec, axis=1, keepdims=True)
        unit = prototypes / np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-12)
        out = (vec / np.maximum(norm, 1e-12)).astype(np.float64) @ unit.T
    return out, sizes > 0


def learn(docs: DataFrame, text_col: str, lang_col: str, per_language: int, id_col: str = "doc_id") -> tuple[list[str], np.ndarray]:
    """Languages in code-point order and their prototypes."""
    d = docs.select(F.col(text_col).alias("t"), F.col(lang_col).alias("l"), F.col(id_col).alias("i")).where("l is not null and t is not null")
    sizes = d.groupBy("l").count().collect()  # one row per language
    # a hash limit per language lets some 2 x per_language texts into the ranking
    if sizes:
        limit = F.create_map(*[F.lit(x) for lang, n in sizes for x in (lang, (2.0 * per_language + 100) / n)])
        d = d.where(chance("i", "t") < limit[F.col("l")])    # by id as well: copies of a common text do not pass together
    first = Window.partitionBy("l").orderBy(chance("i", "t"), "i", "t")
    d = d.withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language)

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in slices(batches):
            keys: list[str] = []
            grams, sums = [], []
            for lang, text in zip(b.column(1).to_pylist(), text_bytes(b, "t")):
                t, n = np.unique(trigrams(text), return_counts=True)
                keys += [lang] * len(t)
                grams.append(t)
                sums.append(n)
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(np.concatenate(grams), pa.int64()),
                                                  pa.array(np.concatenate(sums), pa.int64())], ["l", "g", "n"])

    rows = d.select("t", "l").mapInArrow(count, "l string, g long, n long").groupBy("l", "g").agg(F.sum("n").alias("n")).collect()
    by: dict[str, dict[int, float]] = {}
    for lang, g, n in rows:
        by.setdefault(lang, {})[g] = n
    langs = sorted(by)
    return langs, np.array([bundle(by[x]) for x in langs]).reshape(len(langs), DIMENSIONS)


def predict(docs: DataFrame, langs: list[str], prototypes: np.ndarray, text_col: str, pred: str, score: str,
            rows: int = 256, size: int = 1 << 20) -> DataFrame:
    """``docs`` with the predicted language and its score; texts are scored up to ``size`` bytes at a time."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in slices(batches, rows):
            texts = text_bytes(b, text_col)
            names, scores, i = [], [], 0
            while i < len(texts):
                j, held = i, 0
                while j < len(texts) and (j == i or held + len(texts[j] or b"") <= size):
                    held += len(texts[j] or b"")
                    j += 1
                cos, has = cosines(texts[i:j], prototypes)
                for c, ok in zip(cos, has):
                    best = int(c.argmax()) if ok and len(langs) else -1
                    names.append(langs[best] if best >= 0 else UNDETERMINED)
                    scores.append(float(min(1.0, max(0.0, c[best]))) if best >= 0 else 0.0)
                i = j
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             [*b.schema.names, pred, score])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(pred, StringType()), StructField(score, DoubleType())]))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             per_language: int = 400) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score. Learns from rows that are not held out."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    langs, prototypes = learn(d.where(~held_out(F.col("doc_id"))), "text", "lang", per_language)
    d = d.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return predict(d, langs, prototypes, "text", "lang_pred", "score").drop("text")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    per_language: int = 400) -> DataFrame:
    """``docs`` without those that are in no language: null, or without a letter.

    The cosine sets no limit: that of a few letters lies within the noise of unrelated vectors (1 / sqrt(DIMENSIONS)).
    """
    langs, prototypes = learn(docs.where(~held_out(F.col(id_col))), text_col, lang_col, per_language, id_col)
    pred, score = fresh(docs, "_pred", "_score")
    out = predict(docs, langs, prototypes, text_col, pred, score)
    return out.where(F.col(pred) != UNDETERMINED if langs else F.lit(True)).drop(pred, score)
