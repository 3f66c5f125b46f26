"""Rows that cannot be read as their schema says, kept and counted (S16, 2.12 columns).

One pass reads the input, counts and writes: rows that are whole go to one folder of a staged
table, the others, with what they held, to another that stays as the side table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.observed import metrics
from tidemark.sources.files import apply_source_options
from tidemark.specs import FileFormat, SourceOptions

CORRUPT, BAD = "_corrupt_record", "tm_bad"


@dataclass
class Checked:
    good: DataFrame     # rows that could be read whole
    bad: DataFrame      # the others, as they were
    n_good: int
    n_bad: int


def _split(df: DataFrame, bad: Column, path: str, drop: list[str], raw: list[str]) -> Checked:
    spark, seen = df.sparkSession, Observation()
    flagged = df.withColumn(BAD, F.coalesce(bad, F.lit(False)).cast("int"))
    flagged = flagged.observe(seen, F.count(F.when(F.col(BAD) == 0, 1)).alias("good"), F.count(F.when(F.col(BAD) == 1, 1)).alias("bad"))
    flagged.write.mode("errorifexists").partitionBy(BAD).parquet(path)
    whole = T.StructType([*df.schema.fields, T.StructField(BAD, T.IntegerType())])
    rows = spark.read.schema(whole).parquet(path)
    n = metrics(seen, good=0, bad=0)
    return Checked(rows.where(F.col(BAD) == 0).drop(BAD, *drop), rows.where(F.col(BAD) == 1).select(*raw), n["good"], n["bad"])


def read_checked(spark: SparkSession, path: str, fmt: str, quarantine: str, opts: SourceOptions) -> Checked:
    """csv, json or jsonlines by ``opts.schema``; records that do not fit are kept whole as text in ``quarantine``."""
    if not opts.schema:
        raise ValueError("a checked read needs a schema: without one nothing can be malformed")
    kind = FileFormat(fmt)
    if kind not in (FileFormat.CSV, FileFormat.JSON, FileFormat.JSONLINES):
        raise ValueError(f"{fmt} has no malformed records: they are errors of the file")
    r = spark.read.schema(f"{opts.schema}, {CORRUPT} string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if kind == FileFormat.CSV:
        # column pruning would leave columns unread, and what is wrong with them
        r = r.option("header", str(opts.header).lower()).option("sep", opts.delimiter).option("enforceSchema", "true")
    if kind == FileFormat.JSON:
        r = r.option("multiLine", "true")
    if opts.datetime_format:
        r = r.option("timestampFormat", opts.datetime_format)
    df = r.format("csv" if kind == FileFormat.CSV else "json").load(path)
    out = _split(df, F.col(CORRUPT).isNotNull(), quarantine, [CORRUPT], [CORRUPT])
    out.good = apply_source_options(out.good, opts)
    return out


def cast_checked(df: DataFrame, types: dict[str, str], quarantine: str) -> Checked:
    """The columns option with rows whose text is no value of the type kept aside as they came."""
    missing = [c for c in types if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns in cast map: {missing}")
    bad = F.lit(False)
    for c, t in types.items():
        bad = bad | (F.col(c).isNotNull() & F.col(c).try_cast(t).isNull())
    out = _split(df, bad, quarantine, [], df.columns)
    out.good = out.good.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])
    return out
