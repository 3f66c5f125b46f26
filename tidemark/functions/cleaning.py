"""Declared source/target options as column transforms."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, StringType


def clean_strings(df: DataFrame, *, trim_space: bool = True, empty_as_null: bool = True,
                  null_if: str | None = None, columns=None) -> DataFrame:
    """trim_space / empty_as_null / null_if over string columns (others untouched)."""
    targets = set(columns) if columns else {f.name for f in df.schema.fields
                                            if isinstance(f.dataType, StringType)}
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in targets:
            if trim_space:
                c = F.trim(c)
            if empty_as_null:
                c = F.nullif(c, F.lit(""))
            if null_if is not None:
                c = F.nullif(c, F.lit(null_if))
        out.append(c.alias(f.name))
    return df.select(*out)


def round_fractional(df: DataFrame, decimals: int) -> DataFrame:
    """max_decimals: round float, double and decimal columns to ``decimals`` places. Decimals keep their type."""
    def rounded(f):
        if isinstance(f.dataType, (DoubleType, FloatType)):
            return F.round(F.col(f"`{f.name}`"), decimals).alias(f.name)
        if isinstance(f.dataType, DecimalType) and f.dataType.scale > decimals:
            return F.round(F.col(f"`{f.name}`"), decimals).cast(f.dataType).alias(f.name)
        return F.col(f"`{f.name}`")
    return df.select(*[rounded(f) for f in df.schema.fields])


def cast_columns(df: DataFrame, types: dict[str, str], *, safe: bool = True) -> DataFrame:
    """columns option: cast named columns (``try_cast`` when ``safe``: bad text -> null)."""
    missing = [c for c in types if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns in cast map: {missing}")
    return df.select(*[
        (F.col(c).try_cast(types[c]) if safe else F.col(c).cast(types[c])).alias(c)
        if c in types else F.col(c) for c in df.columns])


def _snake(name: str) -> str:
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    return re.sub(r"[^0-9A-Za-z]+", "_", s).strip("_").lower()


def apply_casing(df: DataFrame, casing: str | None) -> DataFrame:
    """column_casing: ``lower`` / ``upper`` / ``snake`` / None."""
    if not casing:
        return df
    fn = {"lower": str.lower, "upper": str.upper, "snake": _snake}[casing]
    names = [fn(c) for c in df.columns]
    if len(set(n.lower() for n in names)) != len(names):
        raise ValueError("column casing makes two names equal")
    return df.toDF(*names)
