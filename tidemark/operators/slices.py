"""Rows at ranks of an order, without sorting the table into one task (2.12 limit and offset).

The first order column's exact values at the two ends of the slice cut it by a filter; only rows
that share an end's value are cut further, by the next column, and at last by a hash of the
row. Rows alike in all of that are interchangeable, and a number of them is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.changes import fingerprint
from tidemark.operators.control import literal
from tidemark.operators.ranges import OrderStatistics

ROW_HASH = "__tm_row"


def rank_slice(df: DataFrame, order_by: list[str], offset: int = 0, limit: int | None = None) -> DataFrame:
    """The rows after the first ``offset`` in ascending order (null first), ``limit`` of them at most; in no order themselves."""
    hashed = df.withColumn(ROW_HASH, fingerprint(df))
    return _cut(hashed, [*order_by, ROW_HASH], offset, None if limit is None else offset + limit).drop(ROW_HASH)


def _cut(df: DataFrame, cols: list[str], lo: int, hi: int | None) -> DataFrame:
    """Rows of ranks lo + 1 to hi."""
    if hi is not None and hi <= lo:
        return df.limit(0)
    if not cols:
        return df.limit((df.count() if hi is None else hi) - lo)
    name, rest = cols[0], cols[1:]
    dtype, c = df.schema[name].dataType, F.col(name)
    stats = OrderStatistics(df.select(name), name)
    nulls = df.count() - stats.total_rows()
    hi = min(x for x in (hi, nulls + stats.total_rows()) if x is not None)
    if hi <= lo:
        return df.limit(0)
    texts = stats.texts_at([r - nulls for r in (lo + 1, hi) if r > nulls])
    a, b = (None if r <= nulls else texts[r - nulls] for r in (lo + 1, hi))

    def at(value) -> Column:
        return c.isNull() if value is None else c == literal(value, dtype)

    def before(value) -> Column:
        return F.lit(False) if value is None else c.isNull() | (c < literal(value, dtype))

    below_a, with_a, below_b, with_b = df.agg(*[F.count(F.when(x, 1)) for x in (before(a), before(a) | at(a), before(b), before(b) | at(b))]).first()
    if a == b:
        same = df.where(at(a))
        return same if (lo, hi) == (below_a, with_a) else _cut(same, rest, lo - below_a, hi - below_a)
    middle = ~(before(a) | at(a)) & before(b)
    whole = middle
    parts = []
    if lo == below_a:
        whole = whole | at(a)
    else:
        parts.append(_cut(df.where(at(a)), rest, lo - below_a, None))
    if hi == with_b:
        whole = whole | at(b)
    else:
        parts.append(_cut(df.where(at(b)), rest, 0, hi - below_b))
    out = df.where(whole)
    for p in parts:
        out = out.unionByName(p)
    return out
