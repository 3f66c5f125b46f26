"""Operator 1: uniform shuffle into shards of exact size by a communication matrix.

Rows are staged with a physical row number, which divides the input into blocks of at
most ``rows_per_block`` consecutive rows. How many rows block *b* sends to shard *s* is
drawn exactly: the rows of a uniform permutation that fall from one block into the shards
follow a multivariate hypergeometric law over the shards' remaining capacities. Each
block is permuted locally (rank by a seeded hash), cut at the drawn counts, exchanged,
and each shard is permuted again (rank by a second hash). The result is a uniform
shuffle in which shard sizes differ by at most one row.

All row work is DataFrame expressions; the driver sees one count per block and draws the
matrix (blocks x shards integers).

Defined results: null columns travel like values; repeated rows are separate rows; an
empty table gives an empty result; extra columns are carried along.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, stage


def hypergeometric(rng: np.random.Generator, good: int, total: int, draws: int) -> int:
    """Number of good items in ``draws`` draws without replacement from ``total`` items.

    Inverse transform over the support within 40 standard deviations of the mode, where
    all mass representable in doubles lies; populations may exceed 10**9.
    """
    lo, hi = max(0, draws - (total - good)), min(good, draws)
    if lo == hi:
        return lo
    mean = draws * (good / total)
    width = 40.0 * np.sqrt(max(mean * (1 - good / total) * (total - draws) / max(total - 1, 1), 1.0)) + 40
    a, b = max(lo, int(mean - width)), min(hi, int(mean + width) + 1)
    k = np.arange(a, b, dtype=np.float64)
    # log p(k+1) - log p(k), summed from the low end
    step = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(total - good - draws + k + 1)
    logp = np.concatenate([[0.0], np.cumsum(step)])
    cdf = np.cumsum(np.exp(logp - logp.max()))
    return a + int(np.searchsorted(cdf, rng.random() * cdf[-1], side="right").clip(0, b - a))


def communication_matrix(block_rows: list[int], shard_rows: list[int], seed: int) -> list[list[int]]:
    """Rows that each block sends to each shard; row sums and column sums are exact."""
    rng = np.random.default_rng(seed)
    room = list(shard_rows)
    out = []
    for n in block_rows:
        left, pool, sent = n, sum(room), []
        for s, cap in enumerate(room):
            k = hypergeometric(rng, cap, pool, left) if pool else 0
            sent.append(k)
            left -= k
            pool -= cap
            room[s] -= k
        out.append(sent)
    return out


def shuffle_to_shards(df: DataFrame, n_shards: int, seed: int = 1, rows_per_block: int = 500_000) -> DataFrame:
    """``df`` with columns ``shard`` (int) and ``slot`` (long, gapless from 0 in a shard).

    Clashing input columns named shard or slot are replaced.
    """
    spark = df.sparkSession
    df = df.drop("shard", "slot")
    row, block, rank, bounds, cell, mix, before = fresh(
        df, "_row", "_block", "_rank", "_bounds", "_cell", "_mix", "_before")
    # row id = partition in the upper bits, position in the lower 33; fixed by staging
    rows = stage(df.withColumn(row, F.monotonically_increasing_id()), "shard-rows")
    per = 1 << (rows_per_block - 1).bit_length()
    rows = rows.withColumn(block, F.shiftright(row, per.bit_length() - 1))
    sizes = [(r[0], r[1]) for r in rows.groupBy(block).count().sort(block).collect()]
    total = sum(n for _, n in sizes)
    capacity = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    matrix = communication_matrix([n for _, n in sizes], capacity, seed)
    plan = json.dumps([{"b": b, "c": np.cumsum(m).tolist()} for (b, _), m in zip(sizes, matrix)])
    cuts = spark.range(1).select(F.inline(F.from_json(F.lit(plan), "array<struct<b:bigint,c:array<bigint>>>")))
    # blocks x shards longs: its size is known on the driver; large plans join by shuffle
    cuts = F.broadcast(cuts) if len(sizes) * n_shards * 8 <= 64 << 20 else cuts

    local = Window.partitionBy(block).orderBy(F.xxhash64(F.lit(seed), row), row)
    ranked = rows.withColumn(rank, F.row_number().over(local) - 1)
    placed = (ranked.join(cuts.select(F.col("b").alias(block), F.col("c").alias(bounds)), block)
              .withColumn("shard", F.size(F.filter(bounds, lambda x: x <= F.col(rank))))
              .drop(block, rank, bounds))

    # second permutation: a shard is cut into hash cells of bounded size, each ranked alone
    bits = max(0, (max(capacity, default=0) // per).bit_length())
    placed = placed.withColumn(mix, F.xxhash64(F.lit(seed), F.lit("shard"), row))
    placed = placed.withColumn(cell, F.shiftrightunsigned(mix, 64 - bits) if bits else F.lit(0).cast("long"))
    inside = F.row_number().over(Window.partitionBy("shard", cell).orderBy(mix, row)) - 1
    if bits:
        counts = placed.groupBy("shard", cell).agg(F.count("*").alias(before))
        first = counts.withColumn(before, F.coalesce(F.sum(before).over(
            Window.partitionBy("shard").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        out = placed.join(first, ["shard", cell]).withColumn("slot", (F.col(before) + inside).cast("long"))
    else:
        out = placed.withColumn("slot", inside.cast("long"))
    return out.select(*df.columns, F.col("shard").cast("int").alias("shard"), "slot")
