"""Operator 6: licence scan.

One Aho-Corasick pass over the normalised words finds notice phrases and the words of
licence tags. Where a tag occurs, the expression after it is read from the raw text,
brought to reverse Polish order by a shunting-yard parser (with binds tighter than and,
and tighter than or; brackets) and evaluated: the licences it names, and whether it lets
one use the text under permissive terms only.

Base places are occurrences of the three base phrases as consecutive words. All other
phrases and expressions add labels. The score is 1 - product(1 - weight) over the
distinct findings: 0.6 for a phrase, 0.95 for a sound expression, 0.5 for a broken one.

Defined results: a null or empty text has no words, no labels and score 0; repeated rows
are scanned alike; an empty table gives an empty result; long texts are scanned whole.
Phrases at the same place all count; labels are distinct and sorted. Other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, text_bytes, words

# ---- fixed values -------------------------------------------------------------------
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
PHRASES = {
    "permission is hereby granted free of charge to any person": "mit",
    "the software is provided as is without warranty of any kind": "as-is",
    "licensed under the apache": "apache",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "boost",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "dedicated to the public domain": "public-domain",
    "this is free and unencumbered software": "unlicense",
    "all rights reserved": "all-rights-reserved",
}
TAGS = ("spdx license identifier",)
#: Licence identifiers begin with these, longest first.
FAMILIES = {
    "agpl": "agpl", "lgpl": "lgpl", "gpl": "gpl", "apache": "apache", "mit": "mit", "bsd": "bsd", "0bsd": "bsd", "mpl": "mpl",
    "epl": "epl", "isc": "isc", "bsl": "boost", "cc0": "cc0", "cc-by": "cc-by", "unlicense": "unlicense", "zlib": "zlib",
}
PERMISSIVE = {"apache", "mit", "bsd", "isc", "boost", "cc0", "unlicense", "zlib"}
BINDS = {"or": 1, "and": 2, "with": 3}
WEIGHT_PHRASE, WEIGHT_SOUND, WEIGHT_BROKEN = 0.6, 0.95, 0.5
# -------------------------------------------------------------------------------------

TAG_LINE = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.I)
TOKEN = re.compile(r"\(|\)|[A-Za-z0-9.+:-]+")


def family(name: str) -> str:
    low = name.lower()
    return next((v for k, v in sorted(FAMILIES.items(), key=lambda x: -len(x[0])) if low.startswith(k)), low.rstrip("+"))


def read_expression(line: str) -> list[str]:
    """Tokens of the longest beginning of a line that can be an expression."""
    out: list[str] = []
    depth, end, want = 0, 0, True  # want: an operand or "(" may come next
    for m in TOKEN.finditer(line):
        t = m.group()
        if line[end:m.start()].strip():
            break
        low = t.lower()
        if t == "(":
            if not want:
                break
            depth += 1
        elif t == ")":
            if want or not depth:
                break
            depth -= 1
        elif low in BINDS:
            if want:
                break
            want = True
        else:
            if not want:
                break
            want = False
        out.append(t)
        end = m.end()
    return out


def to_polish(tokens: list[str]) -> list[str]:
    """Shunting-yard: reverse Polish order. Raises ValueError on unbalanced brackets."""
    out: list[str] = []
    ops: list[str] = []
    for t in tokens:
        low = t.lower()
        if low in BINDS:
            while ops and ops[-1] != "(" and BINDS[ops[-1]] >= BINDS[low]:
                out.append(ops.pop())
            ops.append(low)
        elif t == "(":
            ops.append(t)
        elif t == ")":
            while ops and ops[-1] != "(":
                out.append(ops.pop())
            if not ops:
                raise ValueError("bracket closed but not opened")
            ops.pop()
        else:
            out.append(t)
    while ops:
        if ops[-1] == "(":
            raise ValueError("bracket opened but not closed")
        out.append(ops.pop())
    return out


def evaluate(tokens: list[str]) -> tuple[set[str], bool]:
    """Licence families of an expression and whether permissive terms are enough for it."""
    stack: list[tuple[set[str], bool]] = []
    for t in to_polish(tokens):
        if t not in BINDS:
            name = family(t.removesuffix("."))
            stack.append(({name}, name in PERMISSIVE))
            continue
        if len(stack) < 2:
            raise ValueError(f"{t} lacks an operand")
        (b, pb), (a, pa) = stack.pop(), stack.pop()
        # an exception after "with" only adds permissions to its licence
        stack.append((a, pa) if t == "with" else (a | b, pa and pb if t == "and" else pa or pb))
    if len(stack) != 1:
        raise ValueError("no expression" if not stack else "two operands without an operator")
    return stack[0]


@cache
def automaton():
    import ahocorasick
    a = ahocorasick.Automaton()
    for p, label in {**PHRASES, **BASE, **dict.fromkeys(TAGS, "")}.items():
        a.add_word(f" {p} ", (p, label))
    a.make_automaton()
    return a


def scan(text: bytes | None) -> tuple:
    """n_words, n_base, first, last, base labels, labels, score, permissive of one text."""
    ws = words(text)
    line = b" ".join([b"", *ws, b""]).decode("latin-1")  # patterns are ASCII: bytes as characters will do
    starts, base, more, found, permissive = [], set(), set(), {}, None
    at = place = 0
    tagged = False
    for end, (phrase, label) in sorted(automaton().iter(line), key=lambda x: x[0] - len(x[1][0])):
        start = end - len(phrase) - 1  # of the space before the phrase
        if phrase in BASE:
            place += line.count(" ", at, start)
            at = start
            starts.append(place)
            base.add(label)
        if label:
            more.add(label)
            found[phrase] = WEIGHT_PHRASE
        else:
            tagged = True
    if tagged:
        for m in TAG_LINE.finditer(text.decode()):
            tokens = read_expression(m.group(1))
            try:
                names, free = evaluate(tokens)
                found["tag " + " ".join(tokens).lower()] = WEIGHT_SOUND
                permissive = free if permissive is None else permissive and free
            except ValueError:
                names = {family(t) for t in tokens if t.lower() not in BINDS and t not in "()"}
                found["broken " + " ".join(tokens).lower()] = WEIGHT_BROKEN
            more |= names
    rest = 1.0
    for w in found.values():
        rest *= 1 - w
    return (len(ws), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(more)), 1 - rest, permissive)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, permissive.

    ``permissive`` is null without a sound expression, else whether each allows permissive use.
    """
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "permissive"]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.bool_()]
        for b in slices(batches):
            rows = [scan(t) for t in text_bytes(b, "t")]
            cols = list(zip(*rows)) if rows else [[]] * 8
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]], ["doc_id", *names])

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    return d.mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
                             "labels string, score double, permissive boolean")
