"""Row-version / timestamp incremental upsert into key-range buckets.

The checkpoint (last applied version) is kept in the store manifest and published
together with the data, so data and checkpoint commit at once. A run pulls rows with
``version > checkpoint`` (pushed to the source as a literal), reduces them to the
newest row per key, stages them in the shared folder, rewrites only the touched
buckets (pruned read of exactly those part directories) and publishes.
Inserts and updates only; deletes are not visible through a version column.

Versions are read with ``>=``, for several rows may share the checkpoint's value (or differ
below the microsecond kept in it) and come later; binary row versions, which a database
gives once only, with ``>``. What is read again is compared with the table: a row of an older
version is left out, one of the same version is a no-op if it is the same in all columns and a
correction if not. A run without any effect publishes no data. Rows without a key are left out
and counted (see ``increment``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.encode import (
    DEFAULT_TIMESTAMP_CHECKPOINT, ZERO_ROWVERSION, parse_rowversion_hex,
)
from tidemark.operators._util import as_list
from tidemark.operators.buckets import bucket_id
from tidemark.operators.changes import effective
from tidemark.operators.control import literal, max_text
from tidemark.operators.merge import align_to_schema, merge_upsert
from tidemark.plans.increment import Increment
from tidemark.sinks.store import VersionedStore


def encode_checkpoint(value, dtype: T.DataType) -> str | None:
    """Checkpoint text of a Python value; jobs take theirs from Spark (``control.max_text``)."""
    if value is None:
        return None
    if isinstance(dtype, T.BinaryType):
        return "0x" + bytes(value).hex()
    if isinstance(value, dt.datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return str(value)


def checkpoint_literal(text: str | None, dtype: T.DataType):
    """Typed literal Column for a stored checkpoint (default when none stored)."""
    if text is None:
        if isinstance(dtype, T.BinaryType):
            return F.lit(bytearray(parse_rowversion_hex(ZERO_ROWVERSION)))
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return F.lit(DEFAULT_TIMESTAMP_CHECKPOINT).cast(dtype)
        return None
    return literal(text, dtype)


class VersionUpsert:
    def __init__(self, spark: SparkSession, store: VersionedStore | str, key, version_col: str,
                 *, bucket_width: int = 1_000_000, part_col: str = "part_id",
                 max_broadcast_keys: int = 10_000_000, inclusive: bool | None = None):
        self.spark = spark
        self.store = store if isinstance(store, VersionedStore) else VersionedStore(spark, store)
        self.key = as_list(key)
        self.version_col = version_col
        self.bucket_width = bucket_width
        self.part_col = part_col
        self.max_broadcast_keys = max_broadcast_keys
        self.inclusive = inclusive

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.part_col, bucket_id(self.key[0], self.bucket_width))

    def init(self, source: DataFrame) -> dict:
        """Full load, bucketed per row (D5), with the checkpoint taken before the load
        so the first sync continues from it (D8)."""
        cp = max_text(source, self.version_col)
        m = self.store.replace(self._bucketed(source), part_col=self.part_col, key=self.key, fresh=True, state={"checkpoint": cp})
        self.store.retain(2)
        return m

    def sync(self, source: DataFrame) -> bool:
        """Upsert what is newer than the checkpoint; without a table yet, everything from the default checkpoint."""
        with self.store.pinned():
            done = self._sync(source)
            if done:
                self.store.retain(2)      # the live table and one generation before it
            return done

    def _sync(self, source: DataFrame) -> bool:
        dtype = source.schema[self.version_col].dataType
        checkpoint = self.store.state().get("checkpoint")
        lit = checkpoint_literal(checkpoint, dtype)
        inclusive = not isinstance(dtype, T.BinaryType) if self.inclusive is None else self.inclusive
        v = F.col(self.version_col)
        newer = source if lit is None else source.where(v >= lit if inclusive and checkpoint is not None else v > lit)
        read = Increment.read(self.store, newer, self.key, self.version_col, checkpoint, "upsert")
        state = {"checkpoint": read.newest if read.newest is not None else checkpoint,
                 **read.rejected(self.store.state(), newer, self.key, self.version_col, checkpoint)}
        # what the table holds is no newer than the checkpoint, but for what streams have brought
        known = checkpoint is not None and not self.store.state().get("batches")
        return self._apply(read.rows, state, v > lit if known else F.lit(False))

    def sync_batch(self, changes: DataFrame, batch_id: int, stream: str = "default") -> bool:
        """Upsert a micro-batch of ``stream``; one that was applied before is skipped.

        Rows may come in any order and more than once: versions are compared per key, then content.
        """
        with self.store.pinned():
            before = self.store.state()
            batches = dict(before.get("batches") or {})
            if batch_id <= batches.get(stream, -1):
                return False
            read = Increment.read(self.store, changes, self.key, self.version_col, name="upsert")
            n = before.get("rejected_null_keys", 0) + read.above
            state = {"batches": {**batches, stream: batch_id}, **({"rejected_null_keys": n} if n else {})}
            done = self._apply(read.rows, state, F.lit(False))
            if done:
                self.store.retain(2)
            return done

    def _apply(self, rows: DataFrame, state: dict, surely_new: Column) -> bool:
        """Upsert one row per key. Only parts with a row that alters them are rewritten; rows known to be
        new are not compared with the table."""
        staged = self._bucketed(rows)
        new, part = F.coalesce(surely_new, F.lit(False)), F.col(self.part_col)
        per_part = staged.groupBy(part).agg(F.count(F.when(new, 1)).alias("new"), F.count(F.when(~new, 1)).alias("again")).collect()
        touched = [r[0] for r in per_part]
        if not self.store.exists():
            if touched:
                self.store.replace(staged, part_col=self.part_col, key=self.key, fresh=True, state=state)
            self.store.drop_staging()
            return bool(touched)
        if touched:
            fresh = align_to_schema(staged, self.store.schema())
            doubtful = [r[0] for r in per_part if r["again"]]
            if doubtful:
                altering = self.store.stage(effective(fresh.where(~new), self.store.read(parts=doubtful), self.key, self.version_col,
                                                      self.max_broadcast_keys), "effective")
                touched = sorted({*[r[0] for r in per_part if r["new"]], *self._parts(altering)}, key=repr)
                fresh = fresh.where(new).unionByName(altering)
        if touched:
            merged = merge_upsert(self.store.read(parts=touched), fresh, self.key, [self.version_col],
                                  max_broadcast_rows=self.max_broadcast_keys, source_reduced=True)
            staged_dir = staged.inputFiles()[0].rsplit("/", 1)[0]
            tasks = self.store.write_tasks(touched, self.store.fs.size_bytes(staged_dir))
            self.store.replace_parts(merged, touched, key=self.key, tasks=tasks, state=state)
        elif any(self.store.state().get(k) != x for k, x in state.items()):
            self.store.set_state(state)
        self.store.drop_staging()
        return bool(touched)

    def _parts(self, staged: DataFrame) -> list:
        return [r[0] for r in staged.select(self.part_col).distinct().collect()]
