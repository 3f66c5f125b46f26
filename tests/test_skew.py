"""One key holding a third of all rows: results stay exact and the heavy reduction
happens before the shuffle."""

import duckdb

from conftest import SF01, rows
from pyspark.sql import functions as F
from tidemark.operators.latest import keep_latest, keep_max_ties
from tidemark.operators.merge import cdc_merge, init_snapshot
from tidemark.operators.ranges import ntile_ranges

HOT = ("CASE WHEN o_orderkey < (SELECT max(o_orderkey) FROM orders) / 3 THEN 0 ELSE o_custkey END")


def skewed_history(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    third = o.select(F.max("o_orderkey")).first()[0] / 3
    return o.select(F.when(F.col("o_orderkey") < third, F.lit(0)).otherwise(F.col("o_custkey")).alias("id"),
                    F.col("o_totalprice").alias("bal"), F.col("o_orderkey").alias("hist_id"),
                    F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("op"))


def duck(sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{SF01}/orders.parquet'")
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{SF01}/customer.parquet'")
    return sorted(con.execute(sql).fetchall(), key=repr)


def test_hot_key_cdc_merge_matches_duckdb(spark):
    hist = skewed_history(spark)
    assert hist.where("id = 0").count() * 3 >= hist.count() - 3
    main = spark.read.parquet(f"{SF01}/customer.parquet").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal"))
    out = cdc_merge(init_snapshot(main, 0), hist, "id", watermark=0)
    expected = duck(f"""
      WITH h AS (SELECT {HOT} AS id, o_totalprice AS bal, o_orderkey AS hist_id,
                        CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS op FROM orders WHERE o_orderkey > 0),
      lat AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY id ORDER BY hist_id DESC) = 1)
      SELECT id, bal, hist_id, op FROM lat WHERE op > 0
      UNION ALL SELECT c_custkey, c_acctbal, 0, 1 FROM customer WHERE c_custkey NOT IN (SELECT id FROM lat)""")
    assert rows(out, "id", "bal", "hist_id", "op") == expected


def test_hot_key_reduced_before_shuffle(spark):
    hist = skewed_history(spark)
    plan = keep_latest(hist, "id", ["hist_id"])._jdf.queryExecution().executedPlan().toString()
    # a Partial WindowGroupLimit sits below the exchange: map tasks forward <= 1 row per key
    below_exchange = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange
    ties = keep_max_ties(hist, "id", "hist_id")
    tplan = ties._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in tplan
    assert ties.count() == hist.select("id").distinct().count()


def test_hot_value_ntile_matches_duckdb(spark):
    hist = skewed_history(spark)
    got = [tuple(r) for r in ntile_ranges(hist, "id", 8, max_bucket_values=50).orderBy("part").collect()]
    expected = duck(f"""SELECT CAST(part AS BIGINT), min(id), max(id), count(*) FROM
        (SELECT ntile(8) OVER (ORDER BY id) AS part, id FROM (SELECT {HOT} AS id FROM orders)) GROUP BY part""")
    assert got == sorted(expected)
