"""Catalog tables (K8, and the catalog table the reference kept in an embedded
catalog): create-table-as-select, then INSERT ... SELECT batches.

Tables are external: their data lives at an explicit path in shared storage, the
catalog only names them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def create_table_as(df: DataFrame, name: str, path: str, *, partition_by=None,
                    fmt: str = "parquet") -> None:
    """CTAS: a new catalog table ``name`` stored at ``path``."""
    w = df.write.format(fmt).option("path", path).option("compression", "zstd").mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.saveAsTable(name)


def insert_select(df: DataFrame, name: str) -> None:
    """INSERT INTO name SELECT ... (columns matched by position, as SQL does)."""
    df.write.insertInto(name)


def read_catalog_table(spark: SparkSession, name: str, columns=None) -> DataFrame:
    df = spark.table(name)
    return df.select(*columns) if columns else df
