"""Snapshot/change merges: CDC (M1), initial snapshot (M2), MERGE forms (M5-M7),
append-only increments (M8).

Every merge is keep-last over the change set, plus a left-anti join of the target
against the *set of changed keys*, and a union. The key set is a pre-aggregated
``distinct`` of the change keys (partial aggregation before its shuffle), so a key
changed a million times costs one row per map task. The target is not shuffled when
the key set is small: jobs pass ``max_broadcast_rows`` and the key set is broadcast
after an exact row-count check; above the bound (or without it) Spark plans a
sort-merge anti join, and adaptive execution may still switch to a broadcast when the
measured key-set shuffle is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators._util import as_list, as_value_col
from tidemark.operators.joins import join_small
from tidemark.operators.latest import keep_latest

AUTO = "auto"


def widened_schema(target: DataFrame, source: DataFrame) -> StructType:
    """adjust_column_type: the target schema with each column widened to the common
    type of target and source (int + long -> long, float + double -> double), as
    UNION's type coercion decides."""
    common = [c for c in target.columns if c in source.columns]
    u = target.select(*common).limit(0).unionByName(source.select(*common).limit(0))
    widened = {f.name: f for f in u.schema.fields}
    return StructType([widened.get(f.name, f) for f in target.schema.fields])


def align_to_schema(df: DataFrame, schema: StructType, *, add_new_columns: bool = False,
                    allow_missing: bool = False) -> DataFrame:
    """Cast ``df`` to ``schema`` by name.

    A column of ``schema`` missing from ``df`` is an error unless ``allow_missing``
    (then it is null). Extra columns of ``df`` are dropped unless ``add_new_columns``.
    """
    have = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = have.get(f.name.lower())
        if src is None:
            if not allow_missing:
                raise ValueError(f"column {f.name!r} missing from change set")
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(src).cast(f.dataType).alias(f.name))
    if add_new_columns:
        known = {f.name.lower() for f in schema.fields}
        cols += [F.col(c) for c in df.columns if c.lower() not in known]
    return df.select(*cols)


def without_keys(target: DataFrame, changes: DataFrame, keys: list[str],
                 max_broadcast_rows: int | None = None, unique: bool = False, known: tuple[int, int] | None = None) -> DataFrame:
    """Target rows whose key is not among the changed keys (J1). Null target keys
    never match, so they survive. ``unique``: the changes hold one row per key
    already, so no ``distinct`` is needed."""
    changed = changes.select(*keys) if unique else changes.select(*keys).distinct()
    if max_broadcast_rows is not None:
        return join_small(target, changed, keys, "left_anti", max_rows=max_broadcast_rows, known=known)
    return target.join(changed, on=keys, how="left_anti")


def drop_stale(latest: DataFrame, snapshot: DataFrame, keys: list[str], hist_id: str,
               max_broadcast_rows: int | None = None, known: tuple[int, int] | None = None) -> DataFrame:
    """Changes that are not newer than the snapshot row of their key are dropped.

    Makes re-reading a tail of the history safe: a re-delivered or late-seen older
    change can never override a newer snapshot row. The (small) reduced change set
    is joined to the snapshot's (key, version) columns; the snapshot is only scanned.
    """
    snap = snapshot.select(*keys, F.col(hist_id).alias("__snap_ver"))
    cur = latest.select(*keys, F.col(hist_id).alias("__chg_ver"))
    if max_broadcast_rows is not None:
        both = join_small(snap, cur, keys, "inner", max_rows=max_broadcast_rows, known=known)
    else:
        both = snap.join(cur, keys, "inner")
    stale = both.where(F.col("__snap_ver") >= F.col("__chg_ver")).select(*keys)
    return latest.join(stale, keys, "left_anti")


def init_snapshot(main: DataFrame, watermark, *, columns=None, hist_id: str = "hist_id",
                  op: str = "op") -> DataFrame:
    """Stamp every row of ``main`` with the load watermark and ``op = 1``.

    ``watermark`` must be captured *before* ``main`` is read (a value, or a Column
    such as a scalar subquery). Changes committed during the load are then replayed
    by the next sync, which is harmless because the merge is idempotent.
    """
    cols = as_list(columns)
    out = main.select(*cols) if cols else main
    return out.withColumns({hist_id: as_value_col(watermark).cast("long"),
                            op: F.lit(1).cast("int")})


def changes_after(changes: DataFrame, hist_id: str, watermark) -> DataFrame:
    """History rows strictly after the watermark; a null watermark means all."""
    if watermark is None:
        return changes
    wm = as_value_col(watermark)
    return changes.where(wm.isNull() | (F.col(hist_id) > wm))


def cdc_merge(snapshot: DataFrame, changes: DataFrame, key, *, hist_id: str = "hist_id",
              op: str = "op", watermark=AUTO, order=None, add_new_columns: bool = False,
              max_broadcast_rows: int | None = None, changes_reduced: bool = False,
              guard_versions: bool = False) -> DataFrame:
    """Apply a history batch to a snapshot (M1).

    ``watermark``: ``"auto"`` takes ``max(hist_id)`` of the snapshot (as a lazy scalar
    subquery); a value or Column is used as given; ``None`` applies every change.
    Keep-last per key by ``order`` (default ``hist_id``); the newest change decides:
    ``op > 0`` upserts the row, ``op = 0`` deletes it. Delete-only batches are
    applied (D2). Untouched snapshot rows survive, including null and duplicate keys.
    Changes without a key are left out (jobs count them).
    ``changes_reduced``: the changes are already one row per key (a staged, reduced
    change set), so keep-last and the key ``distinct`` are skipped.
    ``guard_versions``: a change only applies when it is newer than the snapshot row
    of its key (needed when a tail of the history is re-read, see ``drop_stale``).
    """
    keys = as_list(key)
    if isinstance(watermark, str) and watermark == AUTO:
        watermark = snapshot.select(F.max(hist_id)).scalar()
    ch = changes_after(changes, hist_id, watermark)
    ch = align_to_schema(ch, snapshot.schema, add_new_columns=add_new_columns).dropna(subset=keys)
    latest = ch if changes_reduced else keep_latest(ch, keys, order if order is not None else [hist_id])
    if guard_versions:
        latest = drop_stale(latest, snapshot, keys, hist_id, max_broadcast_rows)
        ch, changes_reduced = latest, True
    active = latest.where(F.col(op) > 0)
    survivors = without_keys(snapshot, ch, keys, max_broadcast_rows, unique=changes_reduced)
    return active.unionByName(survivors, allowMissingColumns=add_new_columns)


def merge_upsert(target: DataFrame, source: DataFrame, key, order, *,
                 max_broadcast_rows: int | None = None, source_reduced: bool = False) -> DataFrame:
    """MERGE: matched -> update all, not matched -> insert all.

    Duplicate source keys are reduced to the newest row first (the reference's
    max-over-key filter keeps ties and feeds several rows per key to MERGE, D9).
    """
    keys = as_list(key)
    src = align_to_schema(source, target.schema)
    latest = src if source_reduced else keep_latest(src, keys, order)
    return latest.unionByName(without_keys(target, src, keys, max_broadcast_rows,
                                           unique=source_reduced))


def merge_three_clause(target: DataFrame, source: DataFrame, key, *, op: str = "op",
                       order=None, part_col: str = "part_id") -> DataFrame:
    """MERGE on (partition, key) (M6).

    matched and op = 0 -> delete; matched and op > 0 -> update; not matched and
    op > 0 -> insert. The result is the whole table, so the target is scanned once; jobs
    that rewrite touched partitions only read just those (``VersionedStore.read(parts=)``).
    ``order`` defaults to ``op``-free ``hist_id``.
    """
    keys = [part_col, *as_list(key)]
    latest = keep_latest(align_to_schema(source, target.schema), keys, order if order is not None else ["hist_id"])
    return latest.where(F.col(op) > 0).unionByName(without_keys(target, latest, keys, unique=True))


def purge_tombstones(df: DataFrame, op: str = "op") -> DataFrame:
    """``DELETE WHERE op = 0`` after a merge that kept tombstones (M7)."""
    return df.where(F.col(op).isNull() | (F.col(op) != 0))


def merge_keep_tombstones(snapshot: DataFrame, changes: DataFrame, key, *, hist_id: str = "hist_id",
                          watermark=None) -> DataFrame:
    """Like ``cdc_merge`` but the newest delete stays as a row with ``op = 0``."""
    keys = as_list(key)
    ch = align_to_schema(changes_after(changes, hist_id, watermark), snapshot.schema)
    latest = keep_latest(ch, keys, [hist_id])
    return latest.unionByName(without_keys(snapshot, ch, keys))


def append_incremental(target: DataFrame, source: DataFrame, order_col: str,
                       last: Column | None = None) -> DataFrame:
    """Append-only increment (M8): source rows with ``order_col`` above the target max."""
    if last is None:
        last = target.select(F.max(order_col)).scalar()
    newer = source.where(last.isNull() | (F.col(order_col) > last))
    return target.unionByName(align_to_schema(newer, target.schema))
