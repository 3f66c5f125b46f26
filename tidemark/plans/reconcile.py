"""Bring a drifted target back in step with its source, part by part (2.12 delete_missing).

Both sides are reduced to one small digest per key-range part: a count and two sums of row
fingerprints that do not depend on order. Only parts whose digests differ are compared row by row
and rewritten; the others are neither shuffled nor written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators._util import as_list
from tidemark.operators.buckets import bucket_id
from tidemark.operators.changes import fingerprint
from tidemark.operators.merge import align_to_schema
from tidemark.sinks.store import VersionedStore


#: Rows without a key lie in this part.
NULL_BUCKET = 0


def part_digests(df: DataFrame, part_col: str) -> DataFrame:
    """(part, n, total, mixed): one row per part, by partial aggregation; equal for equal rows in any order."""
    f = fingerprint(df, [part_col])
    rows = df.select(F.col(part_col).alias("part"), f.alias("f"))
    return rows.groupBy("part").agg(F.count("*").alias("n"), F.sum(F.col("f").cast("decimal(38,0)")).alias("total"),
                                    F.bit_xor(F.xxhash64("f")).alias("mixed"))


def differing_parts(left: DataFrame, right: DataFrame, part_col: str) -> list:
    """Parts whose rows are not the same on both sides (as a manifest, one value per part)."""
    a, b = part_digests(left, part_col), part_digests(right, part_col)
    b = b.select(*[F.col(c).alias(f"r_{c}") for c in b.columns])
    both = a.join(b, F.col("part").eqNullSafe(F.col("r_part")), "full_outer")
    same = F.lit(True)
    for c in ("n", "total", "mixed"):
        same = same & F.col(c).eqNullSafe(F.col(f"r_{c}"))
    # every part has rows, so the side that lacks it has a null count
    return [r[0] for r in both.where(~same).select(F.when(F.col("n").isNotNull(), F.col("part")).otherwise(F.col("r_part"))).collect()]


def in_parts(key: str, parts: list, width: int) -> Column:
    """Rows of some key-range parts (as ``bucket_id`` makes them), as key ranges that reach the scan; neighbouring parts are one range."""
    out, runs = F.lit(False), []
    for p in sorted(parts):
        if runs and runs[-1][1] == p:
            runs[-1][1] = p + 1
        else:
            runs.append([p, p + 1])
    if len(runs) > 64:       # one range about all, and the parts among it
        k = F.col(key)
        out = (k >= runs[0][0] * width) & (k < runs[-1][1] * width) & bucket_id(key, width).isin(list(parts))
    else:
        for lo, hi in runs:
            out = out | ((F.col(key) >= lo * width) & (F.col(key) < hi * width))
    return out | F.col(key).isNull() if NULL_BUCKET in parts else out


@dataclass
class Reconciled:
    """What a comparison found: parts that differ, and their rows that the target lacked, had too many, had with other content."""
    parts: list
    missing: int = 0
    extra: int = 0
    changed: int = 0


def compare_rows(source: DataFrame, target: DataFrame, keys: list[str], part_col: str) -> tuple[int, int, int]:
    """(missing, extra, changed) rows by key. Rows without a key are told apart by their content."""
    def side(df, name):
        f = fingerprint(df, [part_col])
        none = F.lit(False)
        for k in keys:
            none = none | F.col(k).isNull()
        return df.select(*[F.col(k).alias(f"{name}_{k}") for k in keys], F.when(none, f).alias(f"{name}_none"), f.alias(f"{name}_f"))

    a, b = side(source, "s"), side(target, "t")
    on = F.col("s_none").eqNullSafe(F.col("t_none"))
    for k in keys:
        on = on & F.col(f"s_{k}").eqNullSafe(F.col(f"t_{k}"))
    both = a.join(b, on, "full_outer")
    found, kept = F.col("s_f"), F.col("t_f")
    return tuple(both.agg(F.count(F.when(kept.isNull(), 1)), F.count(F.when(found.isNull(), 1)),
                          F.count(F.when(found.isNotNull() & kept.isNotNull() & (found != kept), 1))).first())


def reconcile(store: VersionedStore, source: DataFrame, key, *, bucket_width: int, repair: bool = True) -> Reconciled:
    """Compare a bucketed store with its source; with ``repair`` the differing parts become the source's rows."""
    keys = as_list(key)
    with store.pinned():
        part_col, schema = store.manifest()["part_col"], store.schema()
        if not part_col:
            raise ValueError("reconcile compares by key-range parts: the store has none")
        rows = align_to_schema(source.withColumn(part_col, bucket_id(keys[0], bucket_width)), schema)
        parts = differing_parts(rows, store.read(), part_col)
        if not parts:
            return Reconciled([])
        wanted = rows.where(in_parts(keys[0], parts, bucket_width))
        if repair:
            wanted = store.stage(wanted, "reconcile")
        out = Reconciled(parts, *compare_rows(wanted, store.read(parts=parts), keys, part_col))
        if repair:
            store.replace_parts(wanted, parts, key=keys, tasks=store.write_tasks(parts))
            store.retain(2)
            store.drop_staging()
        return out
