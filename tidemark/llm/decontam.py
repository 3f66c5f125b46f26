"""Operator 4: benchmark decontamination by a generalised suffix automaton.

The normalised words of all benchmark items go into one suffix automaton (Blumer et al.).
Each document's words are streamed through it; the state and the matched length after a
word give the longest run of item words that ends there. Where that length reaches the
window, the last ``window`` words are hit, and the items that hold these words are read
off the state. Items shorter than the window count as one window of their own length and
are found along the suffix links.

The automaton is built in blocks of items of about ``block_bytes`` text, each sent to
the executors by itself and let go afterwards, so a larger benchmark means more passes, not a
larger broadcast or automaton.

Defined results: a null text has no words; items without words hit nothing; null item ids
hit words but are not listed; repeated item ids are one item; an empty benchmark leaves all documents clean; an empty table gives an
empty result. Equal texts are cut alike; other columns, whatever their names, pass through
(in ``contamination`` they are not read).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tidemark.llm.common import fresh, slices, stage, text_bytes, words


class SuffixAutomaton:
    """Generalised suffix automaton over word numbers, with the items of each window."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.word: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        paths = []
        for name, ws in items:
            last, path = 0, []
            for w in ws:
                last = self._extend(last, self.word.setdefault(w, len(self.word)))
                path.append(last)
            paths.append((name, [self.word[w] for w in ws]))
        # items by the state of each of their windows; whole short items by their state
        self.names: dict[int, set] = {}
        self.short: dict[int, int] = {}
        for name, ids in paths:
            n = min(window, len(ids))
            state, size = 0, 0
            for c in ids:
                state, size = self.step(state, size, c)
                while self.len[self.link[state]] >= n > 0 and state:
                    state = self.link[state]
                size = min(size, self.len[state])
                if size >= n > 0:
                    self.names.setdefault(state, set()).add(name)
                    if n < window:
                        self.short[state] = n
        # nearest state along the suffix links, itself included, that ends a short item
        self.ends: list[int] = [-1] * len(self.len)
        for v in sorted(range(1, len(self.len)), key=self.len.__getitem__):
            self.ends[v] = v if v in self.short else self.ends[self.link[v]]
        self.least = min(self.short.values(), default=window)

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None and self.len[q] == self.len[last] + 1:
            return q
        if q is not None:
            return self._clone(last, c, q)
        cur = self._state(self.len[last] + 1, {})
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p == -1:
            self.link[cur] = 0
        else:
            q = self.next[p][c]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        new = self._state(self.len[p] + 1, dict(self.next[q]))
        self.link[new], self.link[q] = self.link[q], new
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def _state(self, length: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(-1)
        self.len.append(length)
        return len(self.len) - 1

    def step(self, state: int, size: int, c: int) -> tuple[int, int]:
        """State and longest matching length after one more word."""
        while state and c not in self.next[state]:
            state = self.link[state]
            size = self.len[state]
        q = self.next[state].get(c)
        return (q, size + 1) if q is not None else (0, 0)

    def scan(self, ws: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit stretches (start, end) of a document, possibly overlapping, and the items with occurring windows."""
        get, window, least = self.word.get, self.window, self.least
        hits: list[tuple[int, int]] = []
        names: set = set()
        ids = np.fromiter((get(w, -1) for w in ws), np.int64, len(ws))
        # a match lies inside a run of item words; runs below the shortest window hold none
        known = np.concatenate([[0], (ids >= 0).astype(np.int8), [0]])
        edge = np.flatnonzero(np.diff(known))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if b - a < least:
                continue
            state = size = 0
            for i, c in enumerate(ids[a:b].tolist(), a):
                state, size = self.step(state, size, c)
                if size >= window:
                    v = state
                    while self.len[self.link[v]] >= window:
                        v = self.link[v]
                    hits.append((i - window + 1, i + 1))
                    names |= self.names.get(v, set())
                if self.short:
                    v = self.ends[state]
                    while v > 0:
                        if self.short[v] <= size:
                            hits.append((i - self.short[v] + 1, i + 1))
                            names |= self.names[v]
                        v = self.ends[self.link[v]]
        return hits, names


def merged(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint sorted stretches that cover the same words."""
    out: list[list[int]] = []
    for a, b in sorted(hits):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


_built: dict[str, SuffixAutomaton] = {}


def automaton_of(key: str, items: Callable[[], list], window: int) -> SuffixAutomaton:
    """The automaton of a block: a Python worker builds it once and holds one at a time."""
    if key not in _built:
        _built.clear()
        _built[key] = SuffixAutomaton([(name, words(t)) for name, t in items()], window)
    return _built[key]


def _scan(docs: DataFrame, block: list, window: int, text_col: str, found: str, every: bool) -> tuple[DataFrame, object]:
    """``docs`` with column ``found``: n words, at, items; those without hits as well if ``every``."""
    sent = docs.sparkSession.sparkContext.broadcast(block)  # about block_bytes of text
    key = uuid.uuid4().hex
    kind = StructType([StructField("n", IntegerType()), StructField("at", ArrayType(IntegerType())),
                       StructField("items", ArrayType(StringType()))])

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa
        automaton = automaton_of(key, lambda: sent.value, window)
        shape = pa.struct([("n", pa.int32()), ("at", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])
        for b in slices(batches):
            rows = []
            for text in text_bytes(b, text_col):
                ws = words(text)
                hits, names = automaton.scan(ws)
                rows.append({"n": len(ws), "at": [x for s in merged(hits) for x in s],
                             "items": sorted(x for x in names if x is not None)})
            out = pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, shape)], [*b.schema.names, found])
            yield out if every else out.filter(pa.array([bool(r["at"]) for r in rows], pa.bool_()))

    return docs.mapInArrow(scan, StructType([*docs.schema.fields, StructField(found, kind)])), sent


def find_spans(docs: DataFrame, items: DataFrame, window: int = 10, text_col: str = "text", item_id: str = "item_id",
               item_text: str = "text", block_bytes: int = 1 << 20) -> tuple[DataFrame, str]:
    """``docs`` with a column (its name is returned): n words, at = flat list of disjoint hit
    stretches (start, end in words), items with occurring windows.

    Items are dealt into blocks of about ``block_bytes`` of text, whose automaton (some hundred
    times that) a worker holds one at a time. With several blocks the documents are written
    once with a row number, each block's hits are written beside them, and met again by row.
    """
    (found, row) = fresh(docs, "_found", "_row")
    asked = items.select(F.col(item_id).cast("string").alias("name"), F.col(item_text).alias("t")).where(F.col("t").isNotNull())
    size = asked.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    if blocks == 1:
        return _scan(docs, [(r[0], r[1].encode()) for r in asked.toLocalIterator()], window, text_col, found, True)[0], found
    asked = stage(asked.withColumn("key", F.monotonically_increasing_id()), "decontam-items")
    d = stage(docs.withColumn(row, F.monotonically_increasing_id()), "decontam-docs")
    texts = d.select(F.col(row).alias("row"), F.col(text_col).alias("text"))
    parts = []
    for i in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == i)
        hits, sent = _scan(texts, [(r[0], r[1].encode()) for r in own.toLocalIterator()], window, "text", "f", i == 0)
        parts.append(stage(hits.select("row", "f.*"), "decontam-hits"))
        sent.destroy()
    every = reduce(DataFrame.unionByName, parts).groupBy("row").agg(
        F.max("n").alias("n"), F.flatten(F.collect_list("at")).alias("at"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def join_spans(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            at = [[x for s in merged(list(zip(flat[::2], flat[1::2]))) for x in s] for flat in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at, pa.list_(pa.int32())), b.column(3)], b.schema.names)

    every = every.mapInArrow(join_spans, every.schema).select(F.col("row").alias(row), F.struct("n", "at", "items").alias(found))
    return d.join(every, row).drop(row), found


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    d, found = find_spans(d, items, window, "text", **options)
    at = F.col(f"{found}.at")
    n_hit = F.aggregate(F.transform(at, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0), lambda a, x: a + x)
    out = d.select("doc_id", F.col(f"{found}.n").cast("long").alias("n_words"), n_hit.cast("long").alias("n_hit"),
                   F.col(f"{found}.items").alias("items"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def cut_spans(text: str, at: list[int]) -> str:
    """The text without the words of the stretches, and without what stands between them."""
    import re
    if not at:
        return text
    place = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
    out, end = [], 0
    for a, b in zip(at[::2], at[1::2]):
        out.append(text[end:place[a][0]])
        end = place[b - 1][1]
    return "".join([*out, text[end:]])


def remove_contamination(docs: DataFrame, items: DataFrame, window: int = 10, text_col: str = "text",
                         max_share: float = 0.5, max_run: int = 1000, **options) -> DataFrame:
    """``docs`` without hit stretches.

    A document is dropped whole if more than ``max_share`` of its words are hit or one
    stretch is longer than ``max_run`` words; otherwise the stretches are cut out of its
    text. Other documents and all other columns stay as they are.
    """
    d, found = find_spans(docs, items, window, text_col, **options)
    at, n = F.col(f"{found}.at"), F.col(f"{found}.n")
    n_hit = F.aggregate(F.transform(at, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0), lambda a, x: a + x)
    runs = F.transform(F.sequence(F.lit(1), F.size(at), F.lit(2)), lambda i: F.element_at(at, i + 1) - F.element_at(at, i))
    longest = F.when(F.size(at) > 0, F.array_max(runs)).otherwise(0)
    keep = (n_hit <= F.lit(max_share) * n) & (longest <= max_run)
    kept = d.where(keep).select(*docs.columns, at.alias(found))

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in slices(batches):
            i, spans = b.schema.get_field_index(text_col), b.column(b.num_columns - 1)
            texts = [t if not at else cut_spans(t, at) for t, at in zip(b.column(i).to_pylist(), spans.to_pylist())]
            cols = [pa.array(texts, b.column(i).type) if j == i else c for j, c in enumerate(b.columns[:-1])]
            yield pa.RecordBatch.from_arrays(cols, b.schema.names[:-1])

    return kept.mapInArrow(cut, docs.schema)
