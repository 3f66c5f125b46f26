"""An increment of a keyed job: staged as one row per key, rows without a key counted.

Rows without a key can be neither matched nor told apart, so they are left out and counted
in the store's state as ``rejected_null_keys``. Increments read the checkpoint's value again;
``rejected_at`` says how many of the counted rows have that value, so none counts twice.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators._util import as_list
from tidemark.operators.control import literal, to_text
from tidemark.operators.latest import keep_latest
from tidemark.operators.observed import metrics
from tidemark.sinks.store import VersionedStore


def lacks_key(keys: list[str]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in keys])


@dataclass
class Increment:
    rows: DataFrame         # one row per key, staged
    newest: str | None      # greatest version read, as control text, also of rows without a key
    above: int              # rows without a key beyond the checkpoint
    at: int                 # rows without a key that have the checkpoint's value

    @classmethod
    def read(cls, store: VersionedStore, source: DataFrame, key, version: str, checkpoint: str | None = None,
             name: str = "changes") -> Increment:
        keys, dtype = as_list(key), source.schema[version].dataType
        none, v, seen = lacks_key(keys), F.col(version), Observation()
        at = F.lit(False) if checkpoint is None else F.coalesce(v == literal(checkpoint, dtype), F.lit(False))
        watched = source.observe(seen, to_text(F.max(v), dtype).alias("newest"),
                                 F.count(F.when(none & ~at, 1)).alias("above"), F.count(F.when(none & at, 1)).alias("at"))
        rows = store.stage(keep_latest(watched.where(~none), keys, [version]), name)
        return cls(rows, **metrics(seen, newest=None, above=0, at=0))

    def rejected(self, state: dict, source: DataFrame, key, version: str, checkpoint: str | None) -> dict:
        """State of the counts after this increment; empty while there was never such a row."""
        total, before = state.get("rejected_null_keys", 0), state.get("rejected_at", 0)
        total += self.above + max(0, self.at - before)
        if not total:
            return {}
        now = max(self.at, before)
        if self.newest is not None and self.newest != checkpoint:
            here = F.col(version) == literal(self.newest, source.schema[version].dataType)
            now = source.where(lacks_key(as_list(key)) & here).count() if self.above else 0
        return {"rejected_null_keys": total, "rejected_at": now}
