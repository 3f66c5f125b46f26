"""Test relations over the driver tables.

main    = customer (id = c_custkey, bal = c_acctbal)
history = orders   (id = o_custkey, bal = o_totalprice, hist_id = o_orderkey,
                    op = 0 when o_orderstatus = 'F' else 1)
The snapshot is taken at WM = max(o_orderkey) * 9 div 10.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed parameters of the test relations.
SNAPSHOT_NUM, SNAPSHOT_DEN = 9, 10      # WM = max(o_orderkey) * 9 div 10
SECOND_NUM, SECOND_DEN = 19, 20         # second batch boundary for the two-batch replay
BUCKET_WIDTH = 100                      # key-range bucket width for customer-keyed tables
SHIFT = 700                             # key shift that makes some bucket keys negative


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def main_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("bal"),
        F.col("o_orderkey").alias("hist_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit(0)).otherwise(F.lit(1)).alias("op"))


def fraction_of_max(spark: SparkSession, sf_dir: str, num: int, den: int) -> Column:
    """``max(o_orderkey) * num div den`` as a literal.

    The value is one small aggregate evaluated on the driver side (the way a job reads
    its watermark from the manifest), so the filter ``hist_id > WM`` is pushed into
    the Parquet scan, where row-group statistics skip old history.
    """
    o = table(spark, sf_dir, "orders")
    v = o.select(F.call_function("div", F.max("o_orderkey") * F.lit(num), F.lit(den))).first()[0]
    return F.lit(v).cast("long")


def snapshot_watermark(spark: SparkSession, sf_dir: str) -> Column:
    return fraction_of_max(spark, sf_dir, SNAPSHOT_NUM, SNAPSHOT_DEN)


# DuckDB spellings of the same relations, used by the oracle SQL.
SQL_WM = "(SELECT max(o_orderkey) * 9 // 10 FROM orders)"
SQL_WM2 = "(SELECT max(o_orderkey) * 19 // 20 FROM orders)"
SQL_HIST = ("(SELECT o_custkey AS id, o_totalprice AS bal, o_orderkey AS hist_id, "
            "CAST(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS INTEGER) AS op FROM orders)")
SQL_SNAPSHOT = (f"(SELECT c_custkey AS id, c_acctbal AS bal, CAST({SQL_WM} AS BIGINT) AS hist_id, "
                "CAST(1 AS INTEGER) AS op FROM customer)")
