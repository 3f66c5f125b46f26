"""Keep-last per key (A6) and max-per-key keeping ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators._util import as_list


def _newest_first(order) -> list[Column]:
    out = []
    for c in as_list(order):
        out.append(F.col(c).desc_nulls_last() if isinstance(c, str) else c)
    return out


def _row_hash(df: DataFrame) -> Column:
    """A hash of the row's hashable columns: a last, deterministic tie-breaker."""
    cols = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return F.xxhash64(*cols) if cols else F.lit(0)


def keep_latest(df: DataFrame, keys, order, *, rank_col: str = "__tm_rank",
                deterministic: bool = True) -> DataFrame:
    """One row per key: the newest by ``order`` (names sort descending, Columns as given).

    Planned as ``row_number() = 1``: Spark inserts a partial WindowGroupLimit *before*
    the shuffle, so every map task forwards at most one row per key. A key that holds
    a third of all rows therefore moves one row per task, not a third of the data.
    Rows tied on ``order`` are decided by a hash of the whole row, so a task that is
    recomputed after an executor loss picks the same row (``deterministic=False``
    leaves ties to Spark). Null keys form one group, as a sort-then-unique does.
    """
    keys = as_list(keys)
    ordering = _newest_first(order)
    if deterministic:
        ordering.append(_row_hash(df).desc())
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return (df.withColumn(rank_col, F.row_number().over(w))
              .where(F.col(rank_col) == 1)
              .drop(rank_col))


def keep_max_ties(df: DataFrame, keys, col: str) -> DataFrame:
    """Rows whose ``col`` equals the maximum of ``col`` within their key; ties all kept.

    Expressed as a pre-aggregated max per key (partial aggregation before the
    shuffle) and a left-semi join back on (key, max). The source rows are only
    shuffled on the composite (key, value), so a hot key spreads over many tasks,
    and AQE may broadcast the per-key maxima when they turn out small.
    """
    keys = as_list(keys)
    mx = df.groupBy(*keys).agg(F.max(col).alias("__tm_max"))
    cond = [df[k].eqNullSafe(mx[k]) for k in keys] + [df[col] == mx["__tm_max"]]
    return df.join(mx, on=cond, how="left_semi")
