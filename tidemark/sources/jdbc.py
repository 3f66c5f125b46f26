"""Database sources and sinks through Spark's JDBC data source.

No database ships with this repository; these readers only build Spark JDBC reads.
Parallelism comes from Spark, not from a driver-side cursor loop: either one
partition per predicate (range plans) or Spark's stride partitioning on bounds.
"""

from __future__ import annotations

import datetime as dt
import decimal

from pyspark.sql import DataFrame, SparkSession


def read_query(spark: SparkSession, url: str, query: str, *, fetchsize: int = 100_000,
               properties: dict | None = None) -> DataFrame:
    """One SQL query on one database (S1, S2: ``fetchsize`` rows per round trip)."""
    r = (spark.read.format("jdbc").option("url", url).option("query", query)
         .option("fetchsize", str(fetchsize)))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()


def read_ranges(spark: SparkSession, url: str, table: str, predicates: list[str], *,
                fetchsize: int = 100_000, properties: dict | None = None) -> DataFrame:
    """Many range reads in parallel, one partition per predicate (S3).

    Use ``ranges.range_predicates`` for half-open ranges that read each row once.
    """
    props = {"fetchsize": str(fetchsize), **(properties or {})}
    return spark.read.jdbc(url, table, predicates=predicates, properties=props)


def sql_literal(v) -> str:
    """A value as an ANSI SQL literal for a pushed-down predicate."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "1" if v else "0"
    if isinstance(v, (int, float, decimal.Decimal)):
        return repr(v) if isinstance(v, float) else str(v)
    if isinstance(v, (bytes, bytearray)):
        return "0x" + bytes(v).hex()
    if isinstance(v, dt.datetime):
        return "'" + v.strftime("%Y-%m-%d %H:%M:%S.%f") + "'"
    if isinstance(v, dt.date):
        return "'" + v.isoformat() + "'"
    return "'" + str(v).replace("'", "''") + "'"


def control_sql(text: str, dtype) -> str:
    """Control text (see ``operators.control``) as a SQL literal: numbers as they are, ``0x...`` for
    binary, ISO text otherwise, with three fractional digits where no more are needed."""
    from pyspark.sql import types as T
    if isinstance(dtype, (T.BinaryType, T.NumericType)):
        return text
    if isinstance(dtype, T.TimestampType):
        micros = int(text)
        at = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=micros)
        return "'" + at.strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3 if micros % 1000 == 0 else None] + "Z'"
    if isinstance(dtype, T.TimestampNTZType):
        text, _, fraction = text.partition(".")
        return f"'{text}.{fraction.ljust(3, '0')}'" if fraction else f"'{text}'"
    return sql_literal(text)


def plan_range_predicates(keys: DataFrame, column: str, k: int) -> list[str]:
    """Balanced, half-open predicates for ``k`` parallel reads (S3 + S4).

    ``keys`` is the key column as a DataFrame (for a database: a one-column JDBC
    query); tile bounds are exact NTILE bounds computed by Spark, and the predicates
    cover every row exactly once, nulls included (D1).
    """
    from pyspark.sql import types as T

    from tidemark.operators.ranges import ntile_ranges, range_begins, range_predicates
    dtype = keys.schema[column].dataType
    if isinstance(dtype, T.StringType):
        raise ValueError("text keys: the database's collation may order otherwise than Spark; use a numeric, date or binary key")
    begins = range_begins(ntile_ranges(keys.select(column), column, k))
    return range_predicates(column, begins, quote=lambda t: control_sql(t, dtype))


def tile_sql(table: str, column: str, k: int) -> str:
    """The tile plan as a query for the source database: k rows come back instead of the key column."""
    return (f"SELECT part, MIN({column}) AS begin_part, MAX({column}) AS end_part, COUNT(*) AS n_rows FROM "
            f"(SELECT {column}, NTILE({k}) OVER (ORDER BY {column}) AS part FROM {table} WHERE {column} IS NOT NULL) t GROUP BY part")


def read_balanced(spark: SparkSession, url: str, table: str, column: str, k: int, *,
                  fetchsize: int = 100_000, properties: dict | None = None) -> DataFrame:
    """Read ``table`` as ``k`` key ranges of about equal row counts, in parallel. The database
    computes the tile plan and orders by its own collation, so any key type is safe."""
    from tidemark.operators.ranges import range_begins, range_predicates
    plan = read_query(spark, url, tile_sql(table, column, k), properties=properties)
    dtype = plan.schema["begin_part"].dataType
    preds = range_predicates(column, range_begins(plan), quote=lambda t: control_sql(t, dtype))
    return read_ranges(spark, url, table, preds, fetchsize=fetchsize, properties=properties)


def read_bounded(spark: SparkSession, url: str, table: str, column: str, lower, upper,
                 num_partitions: int, *, fetchsize: int = 100_000,
                 properties: dict | None = None) -> DataFrame:
    """Min/max bounds then fixed-width chunks (S6). Bounds only set the stride, they
    do not filter; rows with a null key are dropped like the reference does."""
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
         .option("partitionColumn", column).option("lowerBound", str(lower))
         .option("upperBound", str(upper)).option("numPartitions", str(num_partitions))
         .option("fetchsize", str(fetchsize)))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load().where(f"{column} IS NOT NULL")


def scalar(spark: SparkSession, url: str, sql: str, properties: dict | None = None):
    """A scalar computed by the database (S9), e.g. ``SELECT max(Hist_ID) FROM t``."""
    return read_query(spark, url, sql, properties=properties).first()[0]


def write_table(df: DataFrame, url: str, table: str, *, mode: str = "append",
                batchsize: int = 10_000, num_partitions: int | None = None,
                column_types: str | None = None, properties: dict | None = None) -> None:
    """Write to a database table (K5); ``num_partitions`` caps concurrent connections."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table) \
        .option("batchsize", str(batchsize)).mode(mode)
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
