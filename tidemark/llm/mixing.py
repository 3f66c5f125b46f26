"""Operator 2: mix sources to target weights by hash-threshold histograms.

Targets: sources in code-point order (null last) weigh ``weights`` in turn and share the
budget; a target stops at ``max_repeat`` times its source's size and the excess goes to
the others by weight, which is one water level over the sources.

A source's target is a number of whole passes over its documents and a rest below one
pass. The rest is taken by hash: tokens are summed by (source, top 10 bits of the row
hash), a running sum finds the bucket in which the rest ends, and only that bucket is
summed again by the next 10 bits, until it holds one hash value. Documents below that
value are taken once more; the one at it gives the words still missing. No row is sorted;
what is shuffled are histogram rows.

Defined results: a null or empty text has size 0 and gives 0 words; identical rows share
a hash and give equal parts of what is missing; an empty table gives an empty result; a
source of size 0 has target 0; equal sizes and hashes are not told apart; other columns,
whatever their names, are carried along by the mix of documents and not read by the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, stage

STEP = 10


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights=(5, 2, 1), max_repeat: float = 3, share: float = 1.0) -> DataFrame:
    """(source, source_size) -> with target. One row per source; order-dependent, so one small task."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    s = sizes.withColumn("_n", F.row_number().over(order) - 1)
    s = s.withColumn("_w", F.array(*[F.lit(float(w)) for w in weights])[(F.col("_n") % len(weights)).cast("int")])
    s = s.withColumn("_cap", F.col("source_size") * float(max_repeat)).withColumn("_level", F.col("_cap") / F.col("_w"))
    earlier = Window.orderBy("_level", "_n").rowsBetween(Window.unboundedPreceding, -1)
    # level if all sources that fill up before this one are full
    lam = ((F.sum("source_size").over(everything) * share - F.coalesce(F.sum("_cap").over(earlier), F.lit(0.0)))
           / (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(earlier), F.lit(0.0))))
    s = s.withColumn("_lam", lam)
    water = F.max(F.when(F.col("_level") >= F.col("_lam"), F.col("_lam"))).over(everything)
    s = s.withColumn("target", F.least(F.col("_cap"), F.coalesce(water * F.col("_w"), F.col("_cap"))))
    return s.select("source", "source_size", "target")


def thresholds(rows: DataFrame, weights=(5, 2, 1), max_repeat: float = 3, share: float = 1.0) -> DataFrame:
    """rows: (source, size, h). One row per source: source_size, target, passes, edge, part.

    ``edge`` is the hash value up to which documents are taken once more, ``part`` the
    share of a document at the edge itself.
    """
    spark = rows.sparkSession
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    t = source_targets(sizes, weights, max_repeat, share)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    t = t.withColumn("passes", passes.cast("long"))
    t = stage(t.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
              .withColumn("bits", F.lit(0)).withColumn("prefix", F.lit(0).cast("long"))
              .withColumn("held", F.col("source_size")).withColumn("single", F.col("source_size") <= 0)
              .withColumn("edge", F.lit(None).cast("long")), "mix-targets")
    done: list[DataFrame] = []
    for bits in range(STEP, 64 + STEP, STEP):
        bits = min(bits, 64)
        done.append(t.where("single"))
        t = t.where(~F.col("single"))
        if t.isEmpty():
            break
        was = t.select(F.col("source").alias("_s"), "prefix", "bits", "rest")
        inside = (F.col("bits") == 0) | (F.shiftright("h", 64 - (bits - STEP if bits < 64 else 60)) == F.col("prefix"))
        hist = (rows.join(was, F.col("source").eqNullSafe(F.col("_s"))).where(inside)
                .withColumn("_b", F.shiftright("h", 64 - bits) if bits < 64 else F.col("h"))
                .groupBy("source", "_b").agg(F.sum("size").alias("_t"), F.min("h").alias("_lo"), F.max("h").alias("_hi"),
                                             F.first("rest").alias("rest")))
        run = Window.partitionBy("source").orderBy("_b")
        before = F.coalesce(F.sum("_t").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        # the bucket in which the rest ends; the last one where rounding leaves it at the very end
        hist = (hist.withColumn("_before", before).where((F.col("_before") <= F.col("rest")) & (F.col("_t") > 0))
                .groupBy("source").agg(F.max_by(F.struct("_b", "_before", "_t", "_lo", "_hi"), "_b").alias("x")))
        t = (t.drop("prefix", "bits", "held", "single", "edge")
             .join(hist.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
             .select("source", "source_size", "target", "passes", (F.col("rest") - F.col("x._before")).alias("rest"),
                     F.lit(bits).alias("bits"), F.col("x._b").alias("prefix"), F.col("x._t").alias("held"),
                     (F.col("x._lo") == F.col("x._hi")).alias("single"), F.col("x._lo").alias("edge")))
        t = stage(t, "mix-edges")
        if bits == 64:
            done.append(t)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    part = F.when(F.col("held") > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("rest") / F.col("held")))).otherwise(0.0)
    return stage(out.select("source", "source_size", "target", "passes", "edge", part.alias("part")), "mix-thresholds")


def _measured(docs: DataFrame, text: str, key: list[str]) -> tuple[DataFrame, str, str]:
    size, h = fresh(docs, "_size", "_h")
    return (docs.withColumn(size, word_count(F.col(text))).withColumn(h, F.xxhash64(F.lit(7), *key)), size, h)


def take(docs: DataFrame, limits: DataFrame, source: str, size: str, h: str) -> DataFrame:
    """``docs`` with source_size, target and taken (words) by the thresholds of their source."""
    lim = limits.select(F.col("source").alias("_src"), "source_size", "target", "passes", "edge", "part")
    extra = (F.when(F.col("edge").isNull() | (F.col(h) > F.col("edge")), F.lit(0).cast("long"))
             .when(F.col(h) < F.col("edge"), F.col(size)).otherwise(F.floor(F.col(size) * F.col("part"))))
    return (docs.join(lim, F.col(source).eqNullSafe(F.col("_src")))
            .withColumn("taken", (F.col("passes") * F.col(size) + extra).cast("long"))
            .drop("_src", "passes", "edge", "part"))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights=(5, 2, 1), max_repeat: float = 3, share: float = 1.0) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                    word_count(F.col(text_col)).alias("size"), F.xxhash64(F.lit(7), F.col(id_col), F.col(text_col)).alias("h"))
    rows = stage(d, "mix-rows")
    limits = thresholds(rows.select("source", "size", "h"), weights, max_repeat, share)
    return take(rows, limits, "source", "size", "h").select("doc_id", "size", "source_size", "target", "taken")


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  weights=(5, 2, 1), max_repeat: float = 3, share: float = 1.0) -> DataFrame:
    """The mix itself: every document as often as it is taken, in whole copies.

    A document at the edge appears once more if at least half of it is taken. A document
    of no words is taken in whole passes over its source. Columns are those of ``docs``.
    """
    d, size, h = _measured(docs, text_col, [id_col, text_col])
    rows = stage(d.select(F.col(source_col).alias("source"), F.col(size).alias("size"), F.col(h).alias("h")), "mix-rows")
    limits = thresholds(rows, weights, max_repeat, share)
    src, passes, edge, part, copies = fresh(d, "_src", "_passes", "_edge", "_part", "_copies")
    lim = limits.select(F.col("source").alias(src), F.col("passes").alias(passes), F.col("edge").alias(edge), F.col("part").alias(part))
    once = F.when((F.col(h) < F.col(edge)) | ((F.col(h) == F.col(edge)) & (F.col(part) >= 0.5)), 1).otherwise(0)
    out = d.join(lim, F.col(source_col).eqNullSafe(F.col(src))).withColumn(copies, F.col(passes) + once)
    return (out.where(F.col(copies) > 0).withColumn(copies, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
            .select(*docs.columns))
