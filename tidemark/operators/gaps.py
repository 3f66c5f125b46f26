"""History ids that were not seen yet, as a short list of stretches (M1: late commits).

Ids are given out in order but rows become visible in another one. A reader that has seen
ids up to a watermark keeps the stretches of ids below it that it has not seen and asks for
these again, instead of reading a tail of guessed length twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.control import Bounds

CELL = 16   # ids are ordered within cells of 2^16, and cells by their ends


def stretches(ids: DataFrame, col: str) -> DataFrame:
    """(lo, hi): the ids between the least and the greatest of ``col`` that do not occur.

    No task sorts more than a cell of ids; the last step has one row per cell.
    """
    x = ids.select(F.col(col).cast("long").alias("id")).where(F.col("id").isNotNull()).distinct()
    x = x.withColumn("cell", F.shiftright("id", CELL))
    before = F.lag("id").over(Window.partitionBy("cell").orderBy("id"))
    inside = x.withColumn("b", before).where(F.col("id") - F.col("b") > 1).select((F.col("b") + 1).alias("lo"), (F.col("id") - 1).alias("hi"))
    ends = x.groupBy("cell").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    last = F.lag("last").over(Window.orderBy("cell"))
    between = ends.withColumn("b", last).where(F.col("first") - F.col("b") > 1).select(
        (F.col("b") + 1).alias("lo"), (F.col("first") - 1).alias("hi"))
    return inside.unionByName(between)


def bounded(gaps: DataFrame, most: int) -> list[list[int]]:
    """The stretches in order; if there are more than ``most``, neighbours are joined, with what was seen between them."""
    n = gaps.limit(most + 1).count()
    shift = 0
    while n > most:
        shift += 4
        n = gaps.select(F.shiftright("lo", shift)).distinct().limit(most + 1).count()
    if shift:
        gaps = gaps.groupBy(F.shiftright("lo", shift)).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    out: list[list[int]] = []
    for lo, hi in sorted(tuple(r) for r in gaps.select("lo", "hi").collect()):     # at most ``most``
        if out and lo <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def within(c: Column, gaps: list[list[int]]) -> Column:
    """True for ids in one of the stretches. A few become ranges that reach the scan; many a binary search behind one range."""
    if not gaps:
        return F.lit(False)
    if len(gaps) <= 32:
        out = F.lit(False)
        for lo, hi in gaps:
            out = out | ((c >= lo) & (c <= hi))
        return out
    lows, highs = (Bounds([str(g[i]) for g in gaps], T.LongType()) for i in (0, 1))
    begun, ended = lows.count_below(c, strict=False), highs.count_below(c)
    return (c >= gaps[0][0]) & (c <= gaps[-1][1]) & (begun > ended)


def still_open(ids: DataFrame, col: str, gaps: list[list[int]], watermark: int | None, horizon: int | None, most: int) -> list[list[int]]:
    """The stretches left when ``ids`` have been seen as well, all of which lay in ``gaps`` or above ``watermark``.

    ``horizon``: ids that far below the newest are given up.
    """
    spark = ids.sparkSession
    seen = ids.select(F.col(col).cast("long").alias("id"))
    if watermark is not None:
        seen = seen.unionByName(spark.createDataFrame([(watermark,)], "id long"))
    newest = seen.agg(F.max("id")).first()[0]
    if newest is None:
        return gaps
    # the edges of an old stretch count as seen, so that what is new are parts of old stretches
    edges = [(x,) for lo, hi in gaps for x in (lo - 1, hi + 1)]
    if edges:
        seen = seen.unionByName(spark.createDataFrame(edges, "id long"))
    found = stretches(seen, "id")
    if gaps and watermark is not None:
        # between two old stretches all has been seen
        found = found.where((F.col("lo") > watermark) | within(F.col("lo"), gaps))
    elif watermark is not None:
        found = found.where(F.col("lo") > watermark)
    if horizon is not None:
        found = found.where(F.col("hi") > newest - horizon)
    return bounded(found, most)
