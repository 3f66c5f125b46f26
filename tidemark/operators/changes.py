"""What of a change set alters a table (M4, M5, M14): by version, then by content.

A change whose key the table holds with a newer version is stale. One with the same version
is a repetition if the whole row is the same, null for null, and a correction if not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators._util import as_list
from tidemark.operators.joins import join_small


def comparable(name: str, dtype: T.DataType) -> Column:
    """A column that ``<=>`` takes; maps become their entries in order of the keys."""
    c = F.col(f"`{name}`")
    return F.array_sort(F.map_entries(c)) if isinstance(dtype, T.MapType) else c


def fingerprint(df: DataFrame, leave_out=()) -> Column:
    """64-bit hash of a row's columns, in the order of their names."""
    fields = sorted((f for f in df.schema.fields if f.name not in leave_out), key=lambda f: f.name)
    # nulls are skipped by the hash: their places are hashed too
    cols = [c for f in fields for c in (comparable(f.name, f.dataType), F.col(f"`{f.name}`").isNull())]
    return F.xxhash64(*cols) if cols else F.lit(0).cast("long")


def effective(changes: DataFrame, current: DataFrame, key, version: str, max_broadcast_rows: int | None = None) -> DataFrame:
    """The rows of ``changes`` (one per key, same columns as ``current``) that alter ``current``.

    A null version is older than any other. The table's rows are only scanned when the
    changes are few enough to be broadcast.
    """
    keys = as_list(key)
    own = [f for f in changes.schema.fields if f.name not in keys]
    new = changes.select(*[F.col(f"`{k}`") for k in keys], *[comparable(f.name, f.dataType).alias(f"new {f.name}") for f in own])
    old = current.select(*[F.col(f"`{k}`") for k in keys], *[comparable(f.name, f.dataType).alias(f"old {f.name}") for f in own])
    both = old.join(new, keys) if max_broadcast_rows is None else join_small(old, new, keys, max_rows=max_broadcast_rows)
    held, sent = F.col(f"`old {version}`"), F.col(f"`new {version}`")
    stale = F.coalesce(held > sent, held.isNotNull() & sent.isNull())
    same = reduce(Column.__and__, [F.col(f"`old {f.name}`").eqNullSafe(F.col(f"`new {f.name}`")) for f in own], F.lit(True))
    settled = both.where(stale | same).select(*keys).distinct()
    return changes.join(settled, keys, "left_anti")
