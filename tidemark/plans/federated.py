"""Federated SQL over named datasets from many sources, exported as Parquet.

A request is ``{connection -> {dataset name -> query}}`` plus one final SQL query.
Each dataset becomes a temporary view; the final query runs as ordinary Spark SQL,
so joins, pushdown into JDBC scans and adaptive planning are Spark's. Nothing is
collected: the result is written by the executors.

Connection kinds:
* ``jdbc:...``  - the dataset query runs on that database (its own dialect);
* ``spark``     - the dataset query is Spark SQL (for example over
  ``parquet.`/path```), so file datasets need no extra reader code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.sinks.parquet import export_parquet
from tidemark.sources.jdbc import read_query

SPARK_CONNECTION = "spark"


@dataclass
class ExportRequest:
    datasets: dict[str, dict[str, str]]
    query: str
    connections: dict[str, str] = field(default_factory=dict)


def resolve_connection(name: str, request_conns: dict[str, str], configured: dict[str, str] | None) -> str:
    """Request first, then configuration, else an error (F1)."""
    if name in request_conns:
        return request_conns[name]
    if configured and name in configured:
        return configured[name]
    if name == SPARK_CONNECTION:
        return SPARK_CONNECTION
    raise KeyError(f"connection {name!r} is neither in the request nor configured")


def load_dataset(spark: SparkSession, conn: str, query: str) -> DataFrame:
    if conn == SPARK_CONNECTION:
        return spark.sql(query)
    if conn.startswith("jdbc:"):
        return read_query(spark, conn, query)
    raise ValueError(f"unsupported connection {conn!r}")


def register_datasets(spark: SparkSession, request: ExportRequest,
                      configured: dict[str, str] | None = None) -> list[str]:
    """Register every dataset as a temp view; a duplicate name is an error."""
    seen: dict[str, str] = {}
    for conn_name, queries in request.datasets.items():
        conn = resolve_connection(conn_name, request.connections, configured)
        for name, q in queries.items():
            if name.lower() in seen:
                raise ValueError(f"dataset {name!r} defined twice ({seen[name.lower()]}, {conn_name})")
            seen[name.lower()] = conn_name
            load_dataset(spark, conn, q).createOrReplaceTempView(name)
    return list(seen)


def federated_query(spark: SparkSession, request: ExportRequest,
                    configured: dict[str, str] | None = None, *, isolate: bool = True) -> DataFrame:
    """The final query over the registered datasets.

    With ``isolate`` the datasets are registered in ``spark.newSession()``: same
    cluster, cache and settings, separate temporary views, so concurrent requests cannot
    see or replace each other's dataset names, and the caller's session is untouched.
    """
    session = spark
    if isolate:
        session = spark.newSession()
        # a new session starts from the cluster's settings: take over the caller's
        for row in spark.sql("SET").collect():
            if session.conf.isModifiable(row["key"]) and session.conf.get(row["key"], None) != row["value"]:
                session.conf.set(row["key"], row["value"])
    register_datasets(session, request, configured)
    return session.sql(request.query)


def federated_export(spark: SparkSession, request: ExportRequest, path: str,
                     configured: dict[str, str] | None = None) -> str:
    """F1 end to end: datasets -> Spark SQL -> Parquet at ``path``."""
    return export_parquet(federated_query(spark, request, configured), path)


def single_export(spark: SparkSession, conn: str, query: str, path: str) -> str:
    """One query on one source -> Parquet (F2)."""
    return export_parquet(load_dataset(spark, conn, query), path)


def frame_sql(df: DataFrame, query: str, name: str = "frame") -> DataFrame:
    """SQL over one DataFrame: ``{frame}`` in ``query`` names it (F3). Named
    arguments avoid a session-wide view; do not call the argument ``self``."""
    return df.sparkSession.sql(query, **{name: df})
