"""Scalar and profile aggregates (A1, A2, A4, A5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators._util import as_list


def watermark(df: DataFrame, col: str, alias: str = "watermark") -> DataFrame:
    """One row: ``max(col)``; null on an empty input. Only ``col`` is read."""
    return df.select(F.max(col).alias(alias))


def watermark_value(df: DataFrame, col: str):
    """The watermark as a driver-side value (a single scalar)."""
    return df.select(F.max(col)).first()[0]


def watermark_subquery(df: DataFrame, col: str) -> Column:
    """The watermark as a lazy scalar subquery, evaluated once inside the plan."""
    return df.select(F.max(col)).scalar()


def key_bounds(df: DataFrame, col: str) -> DataFrame:
    """One row: ``min_id``, ``max_id`` (both null when the table is empty)."""
    return df.select(F.min(col).alias("min_id"), F.max(col).alias("max_id"))


def table_profile(df: DataFrame, cols) -> DataFrame:
    """One row: row count, and non-null count / min / max for each column in ``cols``."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in as_list(cols):
        aggs += [F.count(c).alias(f"{c}_count"), F.min(c).alias(f"{c}_min"),
                 F.max(c).alias(f"{c}_max")]
    return df.agg(*aggs)


def shape(df: DataFrame) -> DataFrame:
    """One row: ``n_rows`` and ``n_cols`` of a result."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)).cast("long"))
