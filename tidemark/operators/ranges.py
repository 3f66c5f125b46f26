"""Range planning for parallel, resumable reads.

``NTILE(k) OVER (ORDER BY c)`` has no PARTITION BY, so Spark would run it in a single
task. Tile bounds only depend on the multiset of sorted values, so we compute them as
exact order statistics instead, without moving the column:

1. approximate quantiles (``percentile_approx``, one pass, partial aggregates; a seeded
   sample for text and binary) become boundaries: two about every wanted rank, as far apart
   as the sketch may err, or evenly spread ones where many ranks are wanted. Every boundary is
   a bucket of its own, what lies between two boundaries is another: a value held by a third
   of all rows is a boundary and never has to be ranked;
2. exact row counts per bucket (one small aggregate);
3. a wanted rank in a boundary's bucket is that boundary. Only buckets between boundaries
   that hold a wanted rank are ranked, by a running sum over their values; one that still
   holds more than ``max_bucket_values`` rows is split again. A column of no more rows than
   that is one bucket from the start.

The column is read three times per level, so the input must not change meanwhile: stage
the key column of a database first. Only control values reach the driver, as lossless
text (see ``control``).
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.buckets import floor_div
from tidemark.operators.control import Bounds, from_text, literal, to_text

_QUANTILE_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                   T.DoubleType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)


#: The sketch errs by at most one part in so many of the rows.
ACCURACY = 10_000


class OrderStatistics:
    """Exact values at global ranks of one column, computed without a global sort."""

    def __init__(self, df: DataFrame, col: str, *, max_bucket_values: int = 500_000, max_fanout: int = 512):
        self.spark: SparkSession = df.sparkSession
        self.dtype = df.schema[col].dataType
        self.max_bucket_values = max(1, max_bucket_values)
        self.max_fanout = max(2, max_fanout)
        self.v = F.col("_v")
        self.values = df.select(F.col(col).alias("_v")).where(self.v.isNotNull())
        self.n_rows = self.values.count()

    def total_rows(self) -> int:
        return self.n_rows

    def _brackets(self, ranks: list[int]) -> list[float]:
        """Shares just below and above each rank, by twice the sketch's error."""
        err = 2.0 / ACCURACY
        return sorted({min(1.0, max(0.0, r / self.n_rows + e)) for r in ranks for e in (-err, err)})

    def _boundaries(self, sub: DataFrame, sizes: list[int], level: int, ranks: list[int]) -> list[list[str]]:
        """Sorted boundaries inside every open interval of a level, as control text."""
        fanout = max(2, self.max_fanout // len(sizes))
        out: list[list[str]] = [[] for _ in sizes]
        if isinstance(self.dtype, _QUANTILE_TYPES):
            few = level == 0 and 2 * len(ranks) < fanout
            cuts = self._brackets(ranks) if few else [i / fanout for i in range(1, fanout)]
            at = F.percentile_approx(self.v, cuts, ACCURACY if few else 20 * fanout)
            for i, b in sub.groupBy("_iid").agg(F.transform(at, lambda x: to_text(x, self.dtype))).collect():
                out[i] = list(dict.fromkeys(b))
            return out
        # text and binary: about 20 samples per wanted boundary; the least value makes sure of progress
        shares = {i: min(1.0, 20.0 * fanout / max(1, n)) for i, n in enumerate(sizes)}
        picked = sub.sampleBy("_iid", shares, seed=17 + level).select("_iid", to_text(self.v, self.dtype).alias("b")).collect()
        least = sub.groupBy("_iid").agg(to_text(F.min("_v"), self.dtype).alias("b")).collect()
        per: dict[int, list[str]] = {}
        for i, b in picked:
            per.setdefault(i, []).append(b)
        for i, low in least:
            some = sorted(per.get(i, []), key=lambda x: x.encode())   # byte order is Spark's order
            out[i] = list(dict.fromkeys([low, *some[max(0, len(some) // fanout - 1)::max(1, len(some) // fanout)]]))
        return out

    def texts_at(self, ranks: list[int]) -> dict[int, str]:
        """Map each 1-based global rank (among non-null values) to its value as control text.

        A level costs three passes, however many intervals it refines.
        """
        ranks = sorted({int(r) for r in ranks if 1 <= r <= self.n_rows})
        result: dict[int, str] = {}
        if ranks and self.n_rows <= self.max_bucket_values:
            return self._ranked(self.values.withColumn("_b", F.lit(0).cast("long")), {0: [(r, r) for r in ranks]})
        # open intervals in value order: (bound below, bound above, rows up to its start, rows, ranks)
        todo = [(None, None, 0, self.n_rows, ranks)] if ranks else []
        level = 0
        while todo:
            lows = Bounds([t[0] for t in todo if t[0] is not None], self.dtype)
            highs = Bounds([t[1] for t in todo if t[1] is not None], self.dtype)
            iid = lows.count_below(self.v) + F.lit(int(todo[0][0] is None) - 1)
            sub = self.values.withColumn("_iid", iid).where(F.col("_iid") == highs.count_below(self.v, strict=False))
            inner = self._boundaries(sub, [t[3] for t in todo], level, ranks)
            first, every = [], []      # boundaries of interval i begin at first[i] in the list of all
            for b in inner:
                first.append(len(every))
                every += b
            bounds = Bounds(every, self.dtype)
            below = bounds.count_below(self.v)
            # odd: the boundary itself; even: between two boundaries, told apart by interval at the ends
            bucket = below * 2 + (bounds.count_below(self.v, strict=False) > below).cast("int")
            sub = sub.withColumn("_b", F.col("_iid").cast("long") * (4 * len(every) + 4) + bucket)
            counts = {(i, b): (k, n) for i, b, k, n in sub.groupBy("_iid", bucket.alias("x"), F.col("_b").alias("k")).count()
                      .select("_iid", "x", "k", "count").collect()}
            buckets: dict[int, list[int]] = {}
            for i, b in sorted(counts):
                buckets.setdefault(i, []).append(b)
            small: dict[int, list[tuple[int, int]]] = {}
            after = []
            for i, (low, high, start, _, wanted) in enumerate(todo):
                mine = buckets.get(i, [])
                ends, acc = [], start
                for b in mine:
                    acc += counts[i, b][1]
                    ends.append(acc)
                per: dict[int, list[int]] = {}
                for r in wanted:
                    per.setdefault(bisect.bisect_left(ends, r), []).append(r)
                for k, rs in per.items():
                    b = mine[k]
                    key, n = counts[i, b]
                    if b % 2:
                        result.update((r, every[b // 2]) for r in rs)
                    elif n <= self.max_bucket_values:
                        small[key] = [(r, r - (ends[k] - n)) for r in rs]
                    else:
                        c = b // 2
                        lo = every[c - 1] if c > first[i] else low
                        hi = every[c] if c < first[i] + len(inner[i]) else high
                        after.append((lo, hi, ends[k] - n, n, rs))
            if small:
                result.update(self._ranked(sub, small))
            todo, level = after, level + 1
        return result

    def _ranked(self, sub: DataFrame, small: dict[int, list[tuple[int, int]]]) -> dict[int, str]:
        """Values at local ranks of buckets that hold at most ``max_bucket_values`` rows each."""
        want = self.spark.createDataFrame([(b, r, at) for b, rs in small.items() for r, at in rs], "_b long, _rank long, _at long")
        kept = sub.where(F.col("_b").isin(list(small))) if len(small) <= 10_000 else sub
        runs = Window.partitionBy("_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = kept.groupBy("_b", "_v").agg(F.count("*").alias("_n")).withColumn("_end", F.sum("_n").over(runs))
        hits = (sums.join(F.broadcast(want), "_b")     # as many rows as ranks were asked for
                .where((F.col("_end") - F.col("_n") < F.col("_at")) & (F.col("_at") <= F.col("_end"))))
        return dict(hits.select("_rank", to_text(self.v, self.dtype)).collect())

    def values_at(self, ranks: list[int]) -> dict[int, object]:
        """Map each rank to its value as a Python object (timestamps in the process's zone)."""
        texts = list(self.texts_at(ranks).items())
        df = self.spark.createDataFrame(texts, "r long, t string")
        return dict(df.select("r", from_text(F.col("t"), self.dtype)).collect())


def tile_ranks(n: int, k: int) -> list[tuple[int, int, int]]:
    """(tile, first rank, last rank) of ``NTILE(k)`` over ``n`` rows, 1-based.

    The first ``n mod k`` tiles hold ``n div k + 1`` rows, the rest ``n div k``; with
    fewer rows than tiles there are ``n`` tiles of one row.
    """
    if n <= 0 or k <= 0:
        return []
    q, r = divmod(n, k)
    out, start = [], 1
    for t in range(1, min(k, n) + 1):
        size = q + 1 if t <= r else q
        out.append((t, start, start + size - 1))
        start += size
    return out


def ntile_ranges(df: DataFrame, col: str, k: int, **kw) -> DataFrame:
    """Tile plan ``(part, begin_part, end_part, n_rows)`` equal to
    ``SELECT part, min(c), max(c), count(*) FROM (SELECT NTILE(k) OVER (ORDER BY c) part ...)
    GROUP BY part`` over non-null values; a value tied across a tile edge is the end
    of one tile and the begin of the next."""
    stats = OrderStatistics(df.select(col), col, **kw)
    plan = tile_ranks(stats.total_rows(), k)
    texts = stats.texts_at(sorted({r for _, a, b in plan for r in (a, b)}))
    out = df.sparkSession.createDataFrame([(t, texts[a], texts[b], b - a + 1) for t, a, b in plan],
                                          "part long, b string, e string, n_rows long")
    return out.select("part", from_text(F.col("b"), stats.dtype).alias("begin_part"),
                      from_text(F.col("e"), stats.dtype).alias("end_part"), "n_rows")


def range_begins(plan: DataFrame) -> list[str]:
    """Tile begin values from a plan (k rows), in tile order, as control text."""
    dtype = plan.schema["begin_part"].dataType
    return [r[0] for r in plan.orderBy("part").select(to_text(F.col("begin_part"), dtype)).collect()]


def assign_ranges(df: DataFrame, col: str, begins: list, *, range_col: str = "range_id") -> DataFrame:
    """Tag each row with its half-open range: the last range whose begin <= value.

    Ranges are ``[begin_i, begin_{i+1})`` with the last one closed, so a value tied
    across two tiles is read once (D1). One pass over ``df``, no shuffle; a null value
    gets a null range id so no row is lost.
    """
    rid = Bounds(begins, df.schema[col].dataType).count_below(F.col(col), strict=False)
    return df.withColumn(range_col, F.when(F.col(col).isNotNull(), F.greatest(rid, F.lit(1))).cast("long"))


def range_predicates(col: str, begins: list, quote=repr) -> list[str]:
    """Half-open SQL predicates for pushdown to a database, one per range, plus one
    for null values. Together they cover every row exactly once (D1)."""
    if not begins:
        return [f"{col} IS NOT NULL", f"{col} IS NULL"]
    preds = []
    for i in range(len(begins)):
        parts = []
        if i > 0:
            parts.append(f"{col} >= {quote(begins[i])}")
        if i + 1 < len(begins):
            parts.append(f"{col} < {quote(begins[i + 1])}")
        preds.append(" AND ".join(parts) if parts else f"{col} IS NOT NULL")
    preds.append(f"{col} IS NULL")
    return preds


def keyset_page(df: DataFrame, col: str, last, limit: int, **kw) -> DataFrame:
    """Resumable keyset page: the first ``limit`` rows with ``col > last`` in ``col``
    order, closed on ties (every row equal to the page's last key is included, so
    the next page can resume with ``> last key`` without losing rows).

    The cut-off key is found as an exact order statistic instead of a global sort
    with a limit, so large pages do not funnel through one task. ``last`` is a value
    or control text.
    """
    dtype = df.schema[col].dataType
    rest = df if last is None else df.where(F.col(col) > literal(last, dtype))
    stats = OrderStatistics(rest.select(col), col, **kw)
    n = min(limit, stats.total_rows())
    return rest.where(F.col(col) <= literal(stats.texts_at([n])[n], dtype)) if n else rest.limit(0)


def fixed_chunks(df: DataFrame, key: str, width: int) -> DataFrame:
    """Fixed-width half-open chunks from the minimum key (S6):
    ``(chunk_id, chunk_lo, chunk_hi, n_rows)``; null keys are not in any chunk."""
    mn = df.select(F.min(key)).scalar()
    k = F.col(key)
    chunk = floor_div(k - mn, width)
    return (df.where(k.isNotNull())
              .groupBy(chunk.alias("chunk_id"))
              .agg(F.count(F.lit(1)).alias("n_rows"))
              .withColumn("chunk_lo", mn + F.col("chunk_id") * F.lit(width))
              .withColumn("chunk_hi", F.col("chunk_lo") + F.lit(width)))


def page_plan(source: DataFrame, order_col: str, page_rows: int, last=None) -> list[str]:
    """Page end keys for paged reads: the keys at ranks page_rows, 2*page_rows, ...
    and the last rank (after ``last`` when given), from one order-statistics pass
    instead of one pass per page, as control text."""
    rest = source if last is None else source.where(F.col(order_col) > literal(last, source.schema[order_col].dataType))
    st = OrderStatistics(rest.select(order_col), order_col)
    n = st.total_rows()
    ranks = [*range(page_rows, n, page_rows), n] if n else []
    ends = st.texts_at(ranks)
    return list(dict.fromkeys(ends[r] for r in ranks))      # ties can make neighbouring ends equal


def iter_pages(df: DataFrame, col: str, page_rows: int, last=None):
    """Keyset pages as ``(last_key_text, page)`` pairs (S5), about ``page_rows`` rows
    each and closed on ties, in key order; resume with ``last=<last_key>``. The page
    ends are planned once; each page is a range filter that reaches the scan (or the
    database query) as pushed predicates."""
    dtype = df.schema[col].dataType
    prev = last
    for end in page_plan(df, col, page_rows, last):
        cond = F.col(col) <= literal(end, dtype)
        if prev is not None:
            cond = cond & (F.col(col) > literal(prev, dtype))
        yield end, df.where(cond)
        prev = end


def assign_pages(df: DataFrame, col: str, ends: list, *, page_col: str = "page_id") -> DataFrame:
    """Tag every row with its keyset page (1-based) from a page plan: the number of
    page ends strictly below the value, plus one (pages are closed on ties). One pass,
    no shuffle; null keys get a null page."""
    below = Bounds(ends, df.schema[col].dataType).count_below(F.col(col))
    return df.withColumn(page_col, (below + 1).cast("long"))
