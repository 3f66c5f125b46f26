"""Range planning against brute force (pandas ranks) and DuckDB NTILE."""

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF01, rows
from tidemark.operators.ranges import (
    OrderStatistics, assign_ranges, keyset_page, ntile_ranges, range_begins, range_predicates,
    tile_ranks,
)
from pyspark.sql import functions as F


def duck_ntile(col, k, table="orders"):
    con = duckdb.connect()
    return con.execute(
        f"SELECT CAST(part AS BIGINT), min({col}), max({col}), count(*) FROM "
        f"(SELECT ntile({k}) OVER (ORDER BY {col}) AS part, {col} FROM '{SF01}/{table}.parquet') "
        f"GROUP BY part ORDER BY part").fetchall()


@pytest.mark.parametrize("col,k,maxv", [("o_orderdate", 8, 50), ("o_orderkey", 7, 100),
                                        ("o_custkey", 13, 40), ("o_orderdate", 1, 10**6),
                                        ("o_totalprice", 50, 300)])
def test_ntile_equals_duckdb_with_refinement(spark, col, k, maxv):
    # A small max_bucket_values forces several refinement levels of the planner.
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    got = ntile_ranges(o, col, k, max_bucket_values=maxv, max_fanout=8).orderBy("part").collect()
    assert [tuple(r) for r in got] == duck_ntile(col, k)


def test_ntile_on_strings_uses_sampled_boundaries(spark):
    c = spark.read.parquet(f"{SF01}/customer.parquet")
    got = ntile_ranges(c, "c_name", 6, max_bucket_values=100).orderBy("part").collect()
    assert [tuple(r) for r in got] == duck_ntile("c_name", 6, "customer")


def test_fewer_rows_than_tiles_and_nulls(spark):
    df = spark.createDataFrame([(3,), (1,), (None,), (2,)], "v long")
    got = [tuple(r) for r in ntile_ranges(df, "v", 5).orderBy("part").collect()]
    assert got == [(1, 1, 1, 1), (2, 2, 2, 1), (3, 3, 3, 1)]
    assert tile_ranks(10, 4) == [(1, 1, 3), (2, 4, 6), (3, 7, 8), (4, 9, 10)]


def test_hot_value_spanning_tiles(spark):
    # one value holds most rows: it ends one tile and begins the next ones
    df = spark.createDataFrame([(1,)] * 3 + [(5,)] * 20 + [(9,)] * 2, "v long")
    got = [tuple(r) for r in ntile_ranges(df, "v", 4, max_bucket_values=2).orderBy("part").collect()]
    assert got == [(1, 1, 5, 7), (2, 5, 5, 6), (3, 5, 5, 6), (4, 5, 9, 6)]


def test_order_statistics_brute_force(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    vals = sorted(r[0] for r in o.select("o_custkey").collect())
    st_ = OrderStatistics(o.select("o_custkey"), "o_custkey", max_bucket_values=30, max_fanout=4)
    ranks = [1, 2, 777, 7500, 14999, 15000]
    got = st_.values_at(ranks)
    assert got == {r: vals[r - 1] for r in ranks}


def test_assign_ranges_reads_each_row_once(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    begins = range_begins(ntile_ranges(o, "o_orderdate", 8))
    tagged = assign_ranges(o, "o_orderdate", begins)
    assert tagged.count() == o.count()
    assert tagged.where("range_id IS NULL").count() == 0
    # half-open: a value never appears in two ranges
    assert tagged.groupBy("o_orderdate").agg(F.countDistinct("range_id").alias("n")).where("n > 1").count() == 0


@settings(max_examples=20, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=0, max_size=30),
       st.lists(st.integers(-6, 6), min_size=1, max_size=5, unique=True))
def test_range_predicates_cover_each_row_once(vals, begins):
    begins = sorted(begins)
    con = duckdb.connect()
    con.execute("CREATE TABLE t (v INTEGER)")
    if vals:
        con.executemany("INSERT INTO t VALUES (?)", [(v,) for v in vals])
    total = sum(con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0]
                for p in range_predicates("v", begins))
    assert total == len(vals)


def test_keyset_page_closed_on_ties(spark):
    df = spark.createDataFrame([(k,) for k in [1, 2, 2, 2, 3, 4, 4, 5]], "k long")
    page = keyset_page(df, "k", 1, 2)
    assert rows(page) == [(2,), (2,), (2,)]
    nxt = keyset_page(df, "k", 2, 3)
    assert rows(nxt) == [(3,), (4,), (4,)]
    assert keyset_page(df, "k", 5, 3).count() == 0


def test_jdbc_range_predicates_plan_is_balanced_and_exact(spark):
    from tidemark.sources.jdbc import plan_range_predicates, sql_literal
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    assert sql_literal("O'Brien") == "'O''Brien'"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{SF01}/orders.parquet'")
    with pytest.raises(ValueError, match="collation"):
        plan_range_predicates(o, "o_orderpriority", 6)
    for col in ("o_orderdate", "o_orderkey", "o_totalprice"):
        preds = plan_range_predicates(o, col, 6)
        counts = [con.execute(f"SELECT count(*) FROM orders WHERE {p}").fetchone()[0] for p in preds]
        assert sum(counts) == 15000, col
        assert max(counts[:-1]) <= 2 * (15000 // 6) + 1, (col, counts)


def brute_ntile(values, k):
    vals = sorted(v for v in values if v is not None)
    out = []
    for t, a, b in tile_ranks(len(vals), k):
        out.append((t, vals[a - 1], vals[b - 1], b - a + 1))
    return out


@settings(max_examples=12, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-20, 20)), min_size=0, max_size=60),
       st.integers(1, 9), st.integers(2, 12))
def test_ntile_property_matches_brute_force(spark, values, k, maxv):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = [tuple(r) for r in ntile_ranges(df, "v", k, max_bucket_values=maxv, max_fanout=4)
           .orderBy("part").collect()]
    assert got == brute_ntile(values, k)


def test_ntile_on_binary_rowversions(spark):
    from tidemark.functions.encode import long_to_rowversion
    e = spark.read.parquet(f"{SF01}/events.parquet").select(long_to_rowversion("event_id").alias("rv"))
    vals = sorted(bytes(r[0]) for r in e.collect())
    got = [tuple(r) for r in ntile_ranges(e, "rv", 5, max_bucket_values=300, max_fanout=4)
           .orderBy("part").collect()]
    want = [(t, vals[a - 1], vals[b - 1], b - a + 1) for t, a, b in tile_ranks(len(vals), 5)]
    assert [(t, bytes(x), bytes(y), n) for t, x, y, n in got] == want


def test_iter_pages_cover_table_in_key_order(spark):
    from tidemark.operators.ranges import iter_pages
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    pages = list(iter_pages(o, "o_orderdate", 4000))
    counts = [p.count() for _, p in pages]
    assert sum(counts) == o.count() and len(pages) >= 3
    # closed on ties: no date appears in two pages
    seen = set()
    for _, p in pages:
        dates = {r[0] for r in p.select("o_orderdate").distinct().collect()}
        assert not (dates & seen)
        seen |= dates
    # resuming after the first page gives the remaining pages
    rest = list(iter_pages(o, "o_orderdate", 4000, last=pages[0][0]))
    assert sum(p.count() for _, p in rest) == o.count() - counts[0]


def test_assign_pages_ties_and_nulls(spark):
    from tidemark.operators.ranges import assign_pages, page_plan
    df = spark.createDataFrame([(k,) for k in [1, 2, 2, 2, 3, None, 4, 5, 5]], "k long")
    ends = page_plan(df, "k", 2)
    assert ends == ["2", "4", "5"]          # ranks 2, 4, 6, 8 of 1,2,2,2,3,4,5,5
    got = rows(assign_pages(df, "k", ends), "k", "page_id")
    assert got == sorted([(1, 1), (2, 1), (2, 1), (2, 1), (3, 2), (None, None), (4, 2), (5, 3), (5, 3)],
                         key=repr)


def test_control_values_with_another_process_zone(spark, monkeypatch):
    import time
    from pyspark.sql import types as T
    from tidemark.operators.ranges import assign_pages, iter_pages, page_plan
    from tidemark.sources.jdbc import control_sql
    monkeypatch.setenv("TZ", "Europe/Istanbul")
    time.tzset()
    try:
        for expr in ("timestamp_micros(id * 3600000001)", "unhex(lpad(hex(id), 16, '0'))", "date_add(date'2024-01-01', int(id))",
                     "cast(id as decimal(20,3)) / 8", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, int(id), 0, 0.000001)"):
            df = spark.range(10).selectExpr("id", f"{expr} AS v")
            assert keyset_page(df, "v", None, 3).count() == 3
            pages = [p.count() for _, p in iter_pages(df, "v", 4)]
            assert pages == [4, 4, 2], (expr, pages)
            tagged = assign_pages(df, "v", page_plan(df, "v", 4)).orderBy("id").collect()
            assert [r.page_id for r in tagged] == [1] * 4 + [2] * 4 + [3] * 2
            first = next(iter(iter_pages(df, "v", 4)))[0]
            assert keyset_page(df, "v", first, 3).count() == 3
            ranges = assign_ranges(df, "v", range_begins(ntile_ranges(df, "v", 5))).groupBy("range_id").count().collect()
            assert sorted(tuple(r) for r in ranges) == [(i, 2) for i in range(1, 6)]
        assert control_sql("1704067200000000", T.TimestampType()) == "'2024-01-01T00:00:00.000Z'"
        assert control_sql("2024-01-01 00:00:00.5", T.TimestampNTZType()) == "'2024-01-01 00:00:00.500'"
        assert control_sql("0x00ff", T.BinaryType()) == "0x00ff" and control_sql("12", T.LongType()) == "12"
    finally:
        monkeypatch.undo()
        time.tzset()


def test_ten_thousand_pages(spark):
    import time
    from tidemark.operators.ranges import assign_pages, page_plan
    df = spark.range(200_000).repartition(4)
    t = time.time()
    ends = page_plan(df, "id", 20)
    assert len(ends) == 10_000 and assign_pages(df, "id", ends).groupBy("page_id").count().where("count = 20").count() == 10_000
    assert time.time() - t < 60      # on a busy machine; some seconds on an idle one


def test_tile_plan_of_the_database(spark):
    from tidemark.sources.jdbc import tile_sql
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{SF01}/orders.parquet'")
    assert sorted((a, b, c, n) for a, b, c, n in con.execute(tile_sql("orders", "o_custkey", 6)).fetchall()) == duck_ntile("o_custkey", 6)
