"""Awkward documents that every operator must take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, shard string, _row int, pred string, h int"


def awkward(spark, n: int = 60, empty: bool = False):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    rnd = random.Random(5)
    vocab = ["alpha", "beta", "gamma", "délta", "mit", "license", "x1", "the", "of", "Zed"]
    rows = []
    for i in range(n):
        text = " ".join(rnd.choice(vocab) + str(rnd.randrange(40)) for _ in range(rnd.randrange(1, 60)))
        rows.append((i, text, rnd.choice(["en", "de", None]), rnd.choice(["a", "b", "é", None]), len(text), 1, "s", 2, "p", 3))
    rows += [(n, None, None, None, None, None, None, None, None, None), (n + 1, "", "en", "a", 0, 1, "s", 2, "p", 3),
             (n + 2, " \n\t.,;", "en", "a", 7, 1, "s", 2, "p", 3), (None, "no id here at all", "en", "b", 17, 1, "s", 2, "p", 3),
             (None, None, None, "zzz", None, None, None, None, None, None),
             (n + 3, "long words " * 20_000, "en", "b", 220_000, 1, "s", 2, "p", 3), (n + 4, "日本語 テキスト 😀 ñandú", "xx", "c", 20, 1, "s", 2, "p", 3)]
    rows += [rows[3]] * 3 + [rows[n]] * 2
    return spark.createDataFrame([] if empty else rows, SCHEMA)


def plain(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]
