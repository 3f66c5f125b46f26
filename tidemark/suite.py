"""Registered queries (Spark) and their DuckDB oracle SQL, one per operator family.

Every query reads the driver tables under ``sf_dir`` whole; nothing is sampled,
capped or filtered by id to keep checks cheap. Column names are aliased identically
on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixtures as fx
from tidemark.functions.encode import checkpoint_text, long_to_rowversion, rowversion_hex
from tidemark.operators.aggregates import key_bounds, shape, table_profile, watermark
from tidemark.operators.buckets import bucket_id
from tidemark.operators.latest import keep_latest, keep_max_ties
from tidemark.operators.merge import (
    append_incremental, cdc_merge, init_snapshot, merge_keep_tombstones, merge_three_clause,
    merge_upsert, purge_tombstones,
)

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------- CDC merge family
def snapshot(spark, d):
    return init_snapshot(fx.main_table(spark, d), fx.snapshot_watermark(spark, d))


_SQL_LATEST = f"""
ch AS (SELECT * FROM {fx.SQL_HIST} h WHERE hist_id > {fx.SQL_WM}),
lat AS (SELECT * FROM ch QUALIFY row_number() OVER (PARTITION BY id ORDER BY hist_id DESC) = 1)"""

SQL_CDC = f"""
WITH {_SQL_LATEST}
SELECT id, bal, hist_id, op FROM lat WHERE op > 0
UNION ALL
SELECT s.* FROM {fx.SQL_SNAPSHOT} s WHERE NOT EXISTS (SELECT 1 FROM lat WHERE lat.id = s.id)"""


@register("cdc_merge", SQL_CDC)
def q_cdc_merge(spark, d):
    wm = fx.snapshot_watermark(spark, d)
    return cdc_merge(snapshot(spark, d), fx.history(spark, d), "id", watermark=wm)


@register("cdc_merge_delete_only", f"""
WITH ch AS (SELECT * FROM {fx.SQL_HIST} h WHERE hist_id > {fx.SQL_WM} AND op = 0),
lat AS (SELECT * FROM ch QUALIFY row_number() OVER (PARTITION BY id ORDER BY hist_id DESC) = 1)
SELECT id, bal, hist_id, op FROM lat WHERE op > 0
UNION ALL
SELECT s.* FROM {fx.SQL_SNAPSHOT} s WHERE NOT EXISTS (SELECT 1 FROM lat WHERE lat.id = s.id)""")
def q_cdc_merge_delete_only(spark, d):
    wm = fx.snapshot_watermark(spark, d)
    deletes = fx.history(spark, d).where(F.col("op") == 0)
    return cdc_merge(snapshot(spark, d), deletes, "id", watermark=wm)


@register("cdc_merge_two_batches", SQL_CDC)
def q_cdc_merge_two_batches(spark, d):
    """Replaying the log in two batches equals one batch. The second batch starts at
    the watermark recorded from the first batch (max over all its changes, deletes
    included, D3), not at the max of surviving rows."""
    wm = fx.snapshot_watermark(spark, d)
    wm2 = fx.fraction_of_max(spark, d, fx.SECOND_NUM, fx.SECOND_DEN)
    hist = fx.history(spark, d)
    batch1 = hist.where((F.col("hist_id") > wm) & (F.col("hist_id") <= wm2))
    first = cdc_merge(snapshot(spark, d), batch1, "id", watermark=wm)
    recorded = batch1.select(F.max("hist_id")).scalar()
    return cdc_merge(first, hist, "id", watermark=recorded)


@register("init_snapshot", """
SELECT c_custkey, c_name, c_acctbal, CAST((SELECT max(o_orderkey) FROM orders) AS BIGINT) AS hist_id,
       CAST(1 AS INTEGER) AS op FROM customer""")
def q_init_snapshot(spark, d):
    wm = fx.table(spark, d, "orders").select(F.max("o_orderkey")).scalar()
    return init_snapshot(fx.table(spark, d, "customer"), wm,
                         columns=["c_custkey", "c_name", "c_acctbal"])


@register("changelog_scan", f"SELECT * FROM {fx.SQL_HIST} h WHERE hist_id > {fx.SQL_WM}")
def q_changelog_scan(spark, d):
    return fx.history(spark, d).where(F.col("hist_id") > fx.snapshot_watermark(spark, d))


@register("tombstones", f"SELECT * FROM {fx.SQL_HIST} h WHERE hist_id > {fx.SQL_WM} AND op = 0")
def q_tombstones(spark, d):
    return q_changelog_scan(spark, d).where(F.col("op") == 0)


@register("anti_survivors", f"""
SELECT * FROM customer c WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_orderkey > {fx.SQL_WM} AND o.o_custkey = c.c_custkey)""")
def q_anti_survivors(spark, d):
    changed = q_changelog_scan(spark, d).select(F.col("id").alias("c_custkey"))
    return fx.table(spark, d, "customer").join(changed, "c_custkey", "left_anti")


@register("merge_upsert", f"""
WITH {_SQL_LATEST}
SELECT id, bal, hist_id FROM lat
UNION ALL
SELECT s.id, s.bal, s.hist_id FROM {fx.SQL_SNAPSHOT} s WHERE NOT EXISTS (SELECT 1 FROM lat WHERE lat.id = s.id)""")
def q_merge_upsert(spark, d):
    target = snapshot(spark, d).select("id", "bal", "hist_id")
    return merge_upsert(target, q_changelog_scan(spark, d), "id", ["hist_id"])


@register("merge_three_clause", f"""
SELECT *, CAST(floor(id / {fx.BUCKET_WIDTH}) AS BIGINT) AS part_id FROM ({SQL_CDC}) m""")
def q_merge_three_clause(spark, d):
    part = bucket_id("id", fx.BUCKET_WIDTH)
    target = snapshot(spark, d).withColumn("part_id", part)
    source = q_changelog_scan(spark, d).withColumn("part_id", part)
    return merge_three_clause(target, source, "id", op="op", order=["hist_id"])


@register("purge_tombstones", SQL_CDC)
def q_purge_tombstones(spark, d):
    kept = merge_keep_tombstones(snapshot(spark, d), fx.history(spark, d), "id",
                                 watermark=fx.snapshot_watermark(spark, d))
    return purge_tombstones(kept)


@register("append_incremental", f"""
SELECT * FROM orders WHERE o_orderkey <= {fx.SQL_WM}
UNION ALL
SELECT * FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) FROM orders WHERE o_orderkey <= {fx.SQL_WM})""")
def q_append_incremental(spark, d):
    orders = fx.table(spark, d, "orders")
    target = orders.where(F.col("o_orderkey") <= fx.snapshot_watermark(spark, d))
    return append_incremental(target, orders, "o_orderkey")


# ---------------------------------------------------------------- keep-last, windows
@register("keep_latest", """
SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def q_keep_latest(spark, d):
    return keep_latest(fx.table(spark, d, "events"), "user_id", ["event_id"])


@register("keep_latest_tiebreak", """
SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def q_keep_latest_tiebreak(spark, d):
    """Newest order per customer by date, ties broken by order key: one row per key,
    where the max-over-key filter keeps every tied row (D9)."""
    return keep_latest(fx.table(spark, d, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"])


@register("max_over_keep_ties", """
SELECT * FROM orders QUALIFY o_orderdate = max(o_orderdate) OVER (PARTITION BY o_custkey)""")
def q_max_over_keep_ties(spark, d):
    return keep_max_ties(fx.table(spark, d, "orders"), "o_custkey", "o_orderdate")


# ---------------------------------------------------------------- aggregates
@register("watermark_max", "SELECT max(o_orderkey) AS watermark FROM orders")
def q_watermark_max(spark, d):
    return watermark(fx.table(spark, d, "orders"), "o_orderkey")


@register("key_bounds", "SELECT min(c_custkey) AS min_id, max(c_custkey) AS max_id FROM customer")
def q_key_bounds(spark, d):
    return key_bounds(fx.table(spark, d, "customer"), "c_custkey")


@register("table_profile", """
SELECT count(*) AS n_rows,
  count(o_orderkey) AS o_orderkey_count, min(o_orderkey) AS o_orderkey_min, max(o_orderkey) AS o_orderkey_max,
  count(o_orderdate) AS o_orderdate_count, min(o_orderdate) AS o_orderdate_min, max(o_orderdate) AS o_orderdate_max,
  count(o_totalprice) AS o_totalprice_count, min(o_totalprice) AS o_totalprice_min, max(o_totalprice) AS o_totalprice_max
FROM orders""")
def q_table_profile(spark, d):
    return table_profile(fx.table(spark, d, "orders"), ["o_orderkey", "o_orderdate", "o_totalprice"])


@register("export_shape", "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_cols FROM lineitem")
def q_export_shape(spark, d):
    return shape(fx.table(spark, d, "lineitem"))


# ---------------------------------------------------------------- buckets, encodings
@register("bucket_assign", f"""
SELECT c_custkey, c_custkey - {fx.SHIFT} AS id,
       CAST(floor((c_custkey - {fx.SHIFT}) / {fx.BUCKET_WIDTH}) AS BIGINT) AS bucket FROM customer""")
def q_bucket_assign(spark, d):
    c = fx.table(spark, d, "customer").select(
        "c_custkey", (F.col("c_custkey") - F.lit(fx.SHIFT)).alias("id"))
    return c.withColumn("bucket", bucket_id("id", fx.BUCKET_WIDTH))


@register("rowversion_hex", """
SELECT event_id, '0x' || lower(lpad(hex(event_id), 16, '0')) AS rv_hex FROM events""")
def q_rowversion_hex(spark, d):
    e = fx.table(spark, d, "events")
    return e.select("event_id", rowversion_hex(long_to_rowversion("event_id")).alias("rv_hex"))


@register("rowversion_checkpoint", """
SELECT '0x' || lower(lpad(hex(max(event_id)), 16, '0')) AS last_rowversion FROM events""")
def q_rowversion_checkpoint(spark, d):
    e = fx.table(spark, d, "events").select(long_to_rowversion("event_id").alias("rv"))
    return e.select(rowversion_hex(F.max("rv")).alias("last_rowversion"))


@register("checkpoint_text", "SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_update FROM events")
def q_checkpoint_text(spark, d):
    return fx.table(spark, d, "events").select(checkpoint_text(F.max("ts")).alias("last_update"))


# ---------------------------------------------------------------- set operations
@register("concat_parts", """
SELECT * FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT * FROM orders WHERE o_orderstatus <> 'F'""")
def q_concat_parts(spark, d):
    o = fx.table(spark, d, "orders")
    return o.where(F.col("o_orderstatus") == "F").unionByName(o.where(F.col("o_orderstatus") != "F"))


# ---------------------------------------------------------------- range planning
from tidemark.operators.ranges import (  # noqa: E402
    assign_ranges, fixed_chunks, keyset_page, ntile_ranges, range_begins,
)

_SQL_NTILE = """
SELECT CAST(part AS BIGINT) AS part, min({c}) AS begin_part, max({c}) AS end_part, count(*) AS n_rows
FROM (SELECT ntile({k}) OVER (ORDER BY {c}) AS part, {c} FROM orders) t GROUP BY part"""


@register("ntile_ranges", _SQL_NTILE.format(c="o_orderdate", k=8))
def q_ntile_ranges(spark, d):
    return ntile_ranges(fx.table(spark, d, "orders"), "o_orderdate", 8)


@register("ntile_ranges_key", _SQL_NTILE.format(c="o_orderkey", k=7))
def q_ntile_ranges_key(spark, d):
    return ntile_ranges(fx.table(spark, d, "orders"), "o_orderkey", 7)


@register("ntile_ranges_dense", _SQL_NTILE.format(c="o_custkey", k=8))
def q_ntile_ranges_dense(spark, d):
    return ntile_ranges(fx.table(spark, d, "orders"), "o_custkey", 8)


@register("range_read_once", """
WITH b AS (SELECT part, min(o_orderdate) AS begin_part
           FROM (SELECT ntile(8) OVER (ORDER BY o_orderdate) AS part, o_orderdate FROM orders) t GROUP BY part)
SELECT o.*, (SELECT CAST(max(part) AS BIGINT) FROM b WHERE b.begin_part <= o.o_orderdate) AS range_id
FROM orders o""")
def q_range_read_once(spark, d):
    orders = fx.table(spark, d, "orders")
    begins = range_begins(ntile_ranges(orders, "o_orderdate", 8))
    return assign_ranges(orders, "o_orderdate", begins)


@register("keyset_page", "SELECT * FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 5000")
def q_keyset_page(spark, d):
    return keyset_page(fx.table(spark, d, "orders"), "o_orderkey", 1000, 5000)


@register("keyset_page_ties", """
SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate <= (
  SELECT o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1996-01-01 00:00:00'
  ORDER BY o_orderdate LIMIT 1 OFFSET 4999)""")
def q_keyset_page_ties(spark, d):
    import datetime as dt
    return keyset_page(fx.table(spark, d, "orders"), "o_orderdate", dt.datetime(1996, 1, 1), 5000)


@register("keyset_pages_all", """
WITH r AS (SELECT o_orderdate, row_number() OVER (ORDER BY o_orderdate) AS rn FROM orders),
n AS (SELECT count(*) AS n FROM orders),
ends AS (SELECT DISTINCT o_orderdate AS e FROM r, n WHERE r.rn = n.n OR r.rn % 4000 = 0)
SELECT o.*, CAST((SELECT count(*) FROM ends WHERE ends.e < o.o_orderdate) + 1 AS BIGINT) AS page_id
FROM orders o""")
def q_keyset_pages_all(spark, d):
    """Every row tagged with its keyset page of about 4,000 rows (closed on ties), the
    page plan computed once from order statistics."""
    from tidemark.operators.ranges import assign_pages, page_plan
    orders = fx.table(spark, d, "orders")
    return assign_pages(orders, "o_orderdate", page_plan(orders, "o_orderdate", 4000))


@register("fixed_chunks", """
WITH m AS (SELECT min(o_orderkey) AS m FROM orders),
c AS (SELECT CAST(floor((o_orderkey - m.m) / 1000) AS BIGINT) AS chunk_id, m.m AS m FROM orders, m)
SELECT chunk_id, count(*) AS n_rows, any_value(m) + chunk_id * 1000 AS chunk_lo,
       any_value(m) + chunk_id * 1000 + 1000 AS chunk_hi FROM c GROUP BY chunk_id""")
def q_fixed_chunks(spark, d):
    return fixed_chunks(fx.table(spark, d, "orders"), "o_orderkey", 1000)


# ---------------------------------------------------------------- store-backed jobs
from tidemark.functions.cleaning import apply_casing, cast_columns, clean_strings  # noqa: E402
from tidemark.plans.cdc import SnapshotSync  # noqa: E402
from tidemark.plans.copy import CopyJob, resumable_load  # noqa: E402
from tidemark.plans.federated import ExportRequest, federated_query, frame_sql, single_export  # noqa: E402
from tidemark.plans.upsert import VersionUpsert  # noqa: E402
from tidemark.session import work_path  # noqa: E402
from tidemark.sinks.parquet import export_parquet  # noqa: E402
from tidemark.sinks.store import VersionedStore  # noqa: E402
from tidemark.sources.files import read_filtered, read_parquet_dir  # noqa: E402
from tidemark.sources.rates import lookup_rates, parse_rate_documents  # noqa: E402
from tidemark.specs import LoadMode, SourceOptions, TableSpec, TargetOptions  # noqa: E402
from tidemark.streaming.cdc_stream import start_cdc_stream  # noqa: E402


def _wm_value(spark, d, num=fx.SNAPSHOT_NUM, den=fx.SNAPSHOT_DEN) -> int:
    return spark.range(1).select(fx.fraction_of_max(spark, d, num, den)).first()[0]


def _cdc_job(spark, d, bucket_width=None, overlap=0) -> SnapshotSync:
    """Initial snapshot taken when the history ended at WM, then synced to the end."""
    wm = fx.snapshot_watermark(spark, d)
    spec = TableSpec(name="customer", key=["id"], bucket_width=bucket_width, overlap=overlap)
    early = fx.history(spark, d).where(F.col("hist_id") <= wm)
    job = SnapshotSync(spark, work_path(spark, "cdc"), spec,
                       main=lambda: fx.main_table(spark, d), history=early)
    assert job.run() == "init"
    job.history = lambda: fx.history(spark, d)
    return job


@register("cdc_sync_job", SQL_CDC)
def q_cdc_sync_job(spark, d):
    job = _cdc_job(spark, d)
    job.run()
    return job.store.read()


@register("cdc_sync_bucketed", f"""
WITH w AS (SELECT (max(c_custkey) - min(c_custkey)) // 16 + 1 AS w FROM customer)
SELECT m.*, CAST(floor(id / w.w) AS BIGINT) AS part_id FROM ({SQL_CDC}) m, w""")
def q_cdc_sync_bucketed(spark, d):
    job = _cdc_job(spark, d, bucket_width=_width(spark, d))
    job.run()
    return job.store.read()


@register("cdc_sync_overlap", SQL_CDC)
def q_cdc_sync_overlap(spark, d):
    """Sync to WM2, then sync to the end re-reading a tail of already applied history
    (overlap); version-guarded merges make the re-read harmless."""
    wm, wm2 = _wm_value(spark, d), _wm_value(spark, d, fx.SECOND_NUM, fx.SECOND_DEN)
    job = _cdc_job(spark, d, overlap=max(1, (wm2 - wm) // 2))
    hist = fx.history(spark, d)
    job.history = hist.where(F.col("hist_id") <= wm2)
    job.run()
    job.history = hist
    job.run()
    return job.store.read()


def _streamed_job(spark, d, shares) -> SnapshotSync:
    """The history after the snapshot landed in slices ``(from, to]`` of the ids, each as several
    files, consumed one file per micro-batch."""
    job = _cdc_job(spark, d, bucket_width=_width(spark, d))
    landing = work_path(spark, "landing")
    hist = fx.history(spark, d)
    for lo, hi in shares:
        (hist.where((F.col("hist_id") > fx.fraction_of_max(spark, d, lo, 60)) & (F.col("hist_id") <= fx.fraction_of_max(spark, d, hi, 60)))
             .repartition(2, "id").write.mode("append").parquet(landing))
    start_cdc_stream(spark, job, landing, hist.schema, max_files_per_trigger=1).awaitTermination()
    return job


def _width(spark, d, column: str = "c_custkey", table: str = "customer", parts: int = 16) -> int:
    """A bucket width that makes about ``parts`` buckets at any scale."""
    lo, hi = fx.table(spark, d, table).agg(F.min(column), F.max(column)).first()
    return max(1, (hi - lo) // parts + 1)


@register("stream_cdc", SQL_CDC)
def q_stream_cdc(spark, d):
    """History after WM landed in history order, consumed by foreachBatch into the store."""
    return _streamed_job(spark, d, ((54, 57), (57, 60))).read().drop("part_id")


@register("stream_cdc_unordered", SQL_CDC)
def q_stream_cdc_unordered(spark, d):
    """The same with the newest slice landed first: versions are compared per key."""
    return _streamed_job(spark, d, ((58, 60), (56, 58), (54, 56))).read().drop("part_id")


_SQL_LATEST_EVENTS = """
SELECT *, CAST(floor(user_id / 50) AS BIGINT) AS part_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY {o} DESC) = 1"""
EVENTS_CUTOFF = "2024-01-20 00:00:00"


@register("version_upsert", _SQL_LATEST_EVENTS.format(o="ts"))
def q_version_upsert(spark, d):
    """Keyed by user_id, versioned by ts: initial load of the state at a cut-off time,
    then one incremental upsert of every later event into 50-id buckets."""
    events = fx.table(spark, d, "events")
    job = VersionUpsert(spark, work_path(spark, "upsert"), "user_id", "ts", bucket_width=50)
    early = events.where(F.col("ts") <= F.lit(EVENTS_CUTOFF).cast("timestamp_ntz"))
    job.init(keep_latest(early, "user_id", ["ts"]))
    job.sync(events)
    return job.store.read()


@register("version_upsert_binary", _SQL_LATEST_EVENTS.format(o="event_id"))
def q_version_upsert_binary(spark, d):
    """Same with an 8-byte binary row version (byte-wise order, hex checkpoint)."""
    events = fx.table(spark, d, "events").withColumn("rv", long_to_rowversion("event_id"))
    job = VersionUpsert(spark, work_path(spark, "upsert_bin"), "user_id", "rv", bucket_width=50)
    half = events.select(F.call_function("div", F.max("event_id"), F.lit(2))).scalar()
    job.init(keep_latest(events.where(F.col("event_id") <= half), "user_id", ["rv"]))
    job.sync(events)
    return job.store.read().drop("rv")


# ---------------------------------------------------------------- federated export
def _lake_request(d: str, query: str) -> ExportRequest:
    ds = {n: f"SELECT * FROM parquet.`{d}/{n}.parquet`" for n in ("nation", "region", "customer", "orders")}
    return ExportRequest(datasets={"lake": ds}, query=query, connections={"lake": "spark"})


FED_JOIN = """
SELECT r.r_name, n.n_name, count(*) AS n_orders, round(sum(o.o_totalprice), 2) AS revenue
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name, n.n_name"""

FED_TOPN = """
SELECT c.c_custkey, c.c_name, n.n_name, round(sum(o.o_totalprice), 2) AS total
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY c.c_custkey, c.c_name, n.n_name
ORDER BY total DESC, c.c_custkey LIMIT 100"""


@register("federated_join", FED_JOIN)
def q_federated_join(spark, d):
    return federated_query(spark, _lake_request(d, FED_JOIN))


@register("federated_topn", FED_TOPN)
def q_federated_topn(spark, d):
    return federated_query(spark, _lake_request(d, FED_TOPN))


@register("single_export", "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'")
def q_single_export(spark, d):
    path = single_export(spark, "spark",
                         f"SELECT * FROM parquet.`{d}/customer.parquet` WHERE c_mktsegment = 'BUILDING'",
                         work_path(spark, "export"))
    return read_parquet_dir(spark, path)


@register("frame_sql", f"""
SELECT *, CAST(floor(c_custkey / {fx.BUCKET_WIDTH}) AS BIGINT) AS part_id FROM customer""")
def q_frame_sql(spark, d):
    return frame_sql(fx.table(spark, d, "customer"),
                     f"SELECT *, floor(c_custkey / {fx.BUCKET_WIDTH}) AS part_id FROM {{frame}}")


@register("where_filter", "SELECT * FROM lineitem WHERE l_quantity > 45 AND l_discount < 0.05")
def q_where_filter(spark, d):
    return read_filtered(fx.table(spark, d, "lineitem"), "l_quantity > 45 AND l_discount < 0.05")


# ---------------------------------------------------------------- round trips
@register("parquet_roundtrip", "SELECT * FROM lineitem")
def q_parquet_roundtrip(spark, d):
    path = export_parquet(fx.table(spark, d, "lineitem"), work_path(spark, "lineitem"))
    return read_parquet_dir(spark, path)


@register("partitioned_roundtrip", "SELECT *, CAST(o_orderkey // 1000 AS BIGINT) AS chunk FROM orders")
def q_partitioned_roundtrip(spark, d):
    o = fx.table(spark, d, "orders").withColumn("chunk", bucket_id("o_orderkey", 1000))
    path = export_parquet(o, work_path(spark, "orders_chunked"), partition_by="chunk",
                          sort_within=["chunk", "o_orderkey"])
    return read_parquet_dir(spark, path).withColumn("chunk", F.col("chunk").cast("long"))


_VERSION_OF_FILE = r"tm_version=([0-9]+)/"


@register("versioned_roundtrip", f"SELECT *, CASE WHEN o_orderkey <= {fx.SQL_WM} THEN '1' ELSE '2' END AS version FROM orders")
def q_versioned_roundtrip(spark, d):
    """Every row with the version whose files hold it."""
    o = fx.table(spark, d, "orders")
    wm = fx.snapshot_watermark(spark, d)
    store = VersionedStore(spark, work_path(spark, "versioned"))
    store.replace(o.where(F.col("o_orderkey") <= wm))
    store.append(o.where(F.col("o_orderkey") > wm))
    return store.read().withColumn("version", F.regexp_extract(F.input_file_name(), _VERSION_OF_FILE, 1))


@register("many_versions", """
SELECT o_orderkey, o_orderpriority, CASE o_orderkey % 4 WHEN 0 THEN 'a b' WHEN 1 THEN 'x:y' WHEN 2 THEN 'p%q' END AS part FROM orders""")
def q_many_versions(spark, d):
    """A table of 70 versions with null and special-character parts, read in one scan."""
    o = fx.table(spark, d, "orders").select("o_orderkey", "o_orderpriority", F.expr(
        "CASE o_orderkey % 4 WHEN 0 THEN 'a b' WHEN 1 THEN 'x:y' WHEN 2 THEN 'p%q' END").alias("part"))
    store = VersionedStore(spark, work_path(spark, "many"))
    store.replace(o.where("o_orderkey % 70 = 0"), part_col="part")
    for i in range(1, 70):
        store.append(o.where(f"o_orderkey % 70 = {i}"))
    return store.read()


@register("compacted_roundtrip", """
WITH w AS (SELECT (max(o_orderkey) - min(o_orderkey)) // 16 + 1 AS w FROM orders)
SELECT o.*, CAST(o_orderkey // w.w AS BIGINT) AS chunk, 1 AS n_versions FROM orders o, w""")
def q_compacted_roundtrip(spark, d):
    """Two versions compacted into one: every row with the number of versions its part has files in."""
    from pyspark.sql import Window
    o = fx.table(spark, d, "orders").withColumn("chunk", bucket_id("o_orderkey", _width(spark, d, "o_orderkey", "orders")))
    store = VersionedStore(spark, work_path(spark, "compact"))
    wm = fx.snapshot_watermark(spark, d)
    store.replace(o.where(F.col("o_orderkey") <= wm).repartition(16), part_col="chunk")
    store.append(o.where(F.col("o_orderkey") > wm).repartition(8))
    store.compact(key="o_orderkey")
    store.retain(2)
    file = F.regexp_extract(F.input_file_name(), _VERSION_OF_FILE, 1)
    tagged = store.read().withColumn("v", file)
    versions = tagged.groupBy("chunk").agg(F.countDistinct("v").cast("int").alias("n_versions"))
    return tagged.drop("v").join(versions, "chunk").select(*o.columns, "n_versions")


@register("bulk_resume", "SELECT * FROM orders")
def q_bulk_resume(spark, d):
    """Keyset-paged bulk load stopped after two pages (nothing visible), then resumed to the end."""
    orders = fx.table(spark, d, "orders")
    page = max(1, orders.count() // 4 + 1)
    store = VersionedStore(spark, work_path(spark, "bulk"))
    resumable_load(spark, store, orders, "o_orderkey", page, max_pages=2)
    assert store.read().isEmpty()
    resumable_load(spark, store, orders, "o_orderkey", page)
    return store.read()


@register("bulk_resume_growing", "SELECT * FROM orders")
def q_bulk_resume_growing(spark, d):
    """The source grows while the load is interrupted: it reads on past its first plan."""
    orders = fx.table(spark, d, "orders")
    page = max(1, orders.count() // 6 + 1)
    store = VersionedStore(spark, work_path(spark, "bulk_growing"))
    resumable_load(spark, store, orders.where(F.col("o_orderkey") <= fx.snapshot_watermark(spark, d)), "o_orderkey", page, max_pages=2)
    resumable_load(spark, store, orders, "o_orderkey", page)
    return store.read()


@register("bulk_resume_nulls", "SELECT nullif(o_custkey, 7) AS k, * FROM orders")
def q_bulk_resume_nulls(spark, d):
    """Rows without a key are one more page."""
    orders = fx.table(spark, d, "orders").select(F.nullif("o_custkey", F.lit(7)).alias("k"), "*")
    store = VersionedStore(spark, work_path(spark, "bulk_nulls"))
    resumable_load(spark, store, orders, "k", max(1, orders.count() // 5 + 1))
    return store.read()


@register("formats_roundtrip", "SELECT * FROM customer")
def q_formats_roundtrip(spark, d):
    from tidemark.sinks.parquet import write_files
    from tidemark.sources.files import read_files
    c = fx.table(spark, d, "customer")
    path = write_files(c, work_path(spark, "customer_json"), TargetOptions(format="jsonlines"))
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in c.schema.fields)
    return read_files(spark, path, "jsonlines", SourceOptions(schema=ddl))


@register("rows_capped_export", "SELECT *, TRUE AS file_within_cap FROM orders")
def q_rows_capped_export(spark, d):
    """Every row, and whether its file holds at most the cap of 1,000 rows."""
    path = export_parquet(fx.table(spark, d, "orders"), work_path(spark, "capped"),
                          max_records_per_file=1000)
    out = read_parquet_dir(spark, path).withColumn("file", F.input_file_name())
    sizes = out.groupBy("file").agg((F.count("*") <= 1000).alias("file_within_cap"))
    return out.join(sizes, "file").drop("file")


# ---------------------------------------------------------------- FX rates
_RATE_BASE_DATE = "2024-01-01"


def rate_documents(spark, d) -> DataFrame:
    """Rate documents built from supplier and nation rows: one document per day for
    every 20 suppliers; a negative balance leaves ForexBuying empty."""
    s = fx.table(spark, d, "supplier").join(
        fx.table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    day = F.call_function("div", F.col("s_suppkey"), F.lit(20))
    cur = F.concat(
        F.lit('<Currency Kod="'), F.lit("c"), F.col("s_suppkey").cast("string"), F.lit('">'),
        F.lit("<Isim>"), F.coalesce(F.col("n_name"), F.lit("")), F.lit(" "), F.col("s_name"), F.lit("</Isim>"),
        F.lit("<ForexBuying>"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal").cast("string")).otherwise(F.lit("")),
        F.lit("</ForexBuying><ForexSelling>"), (F.col("s_acctbal") + F.lit(1.0)).cast("string"),
        F.lit("</ForexSelling></Currency>"))
    per_day = (s.select(day.alias("day"), F.col("s_suppkey"), cur.alias("cur"))
                .groupBy("day").agg(F.array_join(F.transform(
                    F.sort_array(F.collect_list(F.struct("s_suppkey", "cur"))), lambda x: x["cur"]), "")
                    .alias("body")))
    rate_date = F.date_add(F.lit(_RATE_BASE_DATE).cast("date"), F.col("day").cast("int"))
    return per_day.select("day", F.concat(
        F.lit('<Tarih_Date Tarih="'), F.date_format(rate_date, "dd.MM.yyyy"), F.lit('">'),
        F.col("body"), F.lit("</Tarih_Date>")).alias("xml"))


SQL_RATES = f"""
SELECT DATE '{_RATE_BASE_DATE}' + CAST(s_suppkey // 20 AS INTEGER) AS rate_date, upper('c' || s_suppkey) AS code,
       coalesce(n_name, '') || ' ' || s_name AS name, s_acctbal AS buy, s_acctbal + 1.0 AS sell
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal >= 0"""


@register("rates_parse", SQL_RATES)
def q_rates_parse(spark, d):
    return parse_rate_documents(rate_documents(spark, d))


@register("rates_files", SQL_RATES)
def q_rates_files(spark, d):
    """The same documents landed as XML files, one document per file (one folder per
    day), read back with Spark's XML source."""
    from tidemark.sources.rates import read_rate_files
    path = work_path(spark, "rates_landed")
    rate_documents(spark, d).repartition("day").write.partitionBy("day").text(path)
    return read_rate_files(spark, path)


@register("rates_lookup", f"""
WITH r AS ({SQL_RATES}),
q AS (SELECT s_suppkey, 'c' || s_suppkey AS code,
             DATE '{_RATE_BASE_DATE}' + CAST(s_suppkey // 20 AS INTEGER) + CAST(k AS INTEGER) AS rate_date
      FROM supplier, (SELECT unnest([0, 1000]) AS k))
SELECT q.s_suppkey, q.code, q.rate_date, r.name AS rate_name, r.buy, r.sell
FROM q LEFT JOIN r ON q.rate_date = r.rate_date AND upper(q.code) = r.code""")
def q_rates_lookup(spark, d):
    """Lower-case codes (case-insensitive match) on each supplier's day and on a day
    with no document (null rates)."""
    req = (fx.table(spark, d, "supplier")
             .select("s_suppkey", F.concat(F.lit("c"), F.col("s_suppkey").cast("string")).alias("code"),
                     F.explode(F.array(F.lit(0), F.lit(1000))).alias("k"))
             .withColumn("rate_date", F.date_add(
                 F.lit(_RATE_BASE_DATE).cast("date"),
                 (F.call_function("div", F.col("s_suppkey"), F.lit(20)) + F.col("k")).cast("int")))
             .drop("k"))
    return lookup_rates(req, parse_rate_documents(rate_documents(spark, d)))


# ---------------------------------------------------------------- load modes
@register("mode_full_refresh", "SELECT * FROM orders")
def q_mode_full_refresh(spark, d):
    o = fx.table(spark, d, "orders")
    path = work_path(spark, "full")
    CopyJob(target_object=path, source=o.where(F.col("o_orderkey") <= fx.snapshot_watermark(spark, d)),
            mode=LoadMode.FULL_REFRESH).run(spark)
    CopyJob(target_object=path, source=o, mode=LoadMode.FULL_REFRESH).run(spark)
    return VersionedStore(spark, path).read()


@register("mode_truncate", "SELECT * FROM orders")
def q_mode_truncate(spark, d):
    o = fx.table(spark, d, "orders")
    path = work_path(spark, "truncate")
    CopyJob(target_object=path, source=o.limit(0), mode=LoadMode.FULL_REFRESH).run(spark)
    wider = o.select(*reversed(o.columns), F.lit("x").alias("extra"))
    CopyJob(target_object=path, source=wider, mode=LoadMode.TRUNCATE).run(spark)
    return VersionedStore(spark, path).read()


_SQL_UPSERT = """
WITH ch AS (SELECT * FROM {hist} h WHERE {cond}),
lat AS (SELECT * FROM ch QUALIFY row_number() OVER (PARTITION BY id ORDER BY hist_id DESC) = 1)
SELECT id, bal, hist_id FROM lat
UNION ALL
SELECT s.id, s.bal, s.hist_id FROM {snap} s WHERE NOT EXISTS (SELECT 1 FROM lat WHERE lat.id = s.id)"""


def _snapshot_target(spark, d, path):
    CopyJob(target_object=path, source=snapshot(spark, d).select("id", "bal", "hist_id"),
            mode=LoadMode.FULL_REFRESH).run(spark)


@register("mode_incremental", _SQL_UPSERT.format(hist=fx.SQL_HIST, snap=fx.SQL_SNAPSHOT,
                                                 cond=f"hist_id > {fx.SQL_WM}"))
def q_mode_incremental(spark, d):
    path = work_path(spark, "incremental")
    _snapshot_target(spark, d, path)
    CopyJob(target_object=path, source=fx.history(spark, d).select("id", "bal", "hist_id"),
            mode=LoadMode.INCREMENTAL, primary_key=["id"], update_key="hist_id").run(spark)
    return VersionedStore(spark, path).read()


@register("mode_backfill", _SQL_UPSERT.format(
    hist=fx.SQL_HIST, snap=fx.SQL_SNAPSHOT, cond=f"hist_id >= {fx.SQL_WM} AND hist_id < {fx.SQL_WM2}"))
def q_mode_backfill(spark, d):
    path = work_path(spark, "backfill")
    _snapshot_target(spark, d, path)
    rng = (_wm_value(spark, d), _wm_value(spark, d, fx.SECOND_NUM, fx.SECOND_DEN))
    CopyJob(target_object=path, source=fx.history(spark, d).select("id", "bal", "hist_id"),
            mode=LoadMode.BACKFILL, primary_key=["id"], update_key="hist_id",
            backfill_range=rng).run(spark)
    return VersionedStore(spark, path).read()


@register("mode_snapshot", """
SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS loaded_at FROM nation
UNION ALL SELECT *, TIMESTAMP '2024-01-02 00:00:00' AS loaded_at FROM nation""")
def q_mode_snapshot(spark, d):
    import datetime as dt
    path = work_path(spark, "snapshot")
    n = fx.table(spark, d, "nation")
    for day in (1, 2):
        CopyJob(target_object=path, source=n, mode=LoadMode.SNAPSHOT,
                loaded_at=dt.datetime(2024, 1, day)).run(spark)
    return VersionedStore(spark, path).read()


@register("delete_missing", "SELECT * FROM (" + _SQL_UPSERT.format(
    hist=fx.SQL_HIST, snap=fx.SQL_SNAPSHOT, cond=f"hist_id > {fx.SQL_WM}")
    + ") m WHERE id IN (SELECT o_custkey FROM orders)")
def q_delete_missing(spark, d):
    path = work_path(spark, "delete_missing")
    _snapshot_target(spark, d, path)
    CopyJob(target_object=path, source=fx.history(spark, d).select("id", "bal", "hist_id"),
            mode=LoadMode.INCREMENTAL, primary_key=["id"], update_key="hist_id",
            target_options=TargetOptions(delete_missing=True)).run(spark)
    return VersionedStore(spark, path).read()


# ---------------------------------------------------------------- declared options
@register("clean_strings", """
SELECT conv_id, turn, nullif(trim(role), '') AS role, nullif(trim(text), '') AS text FROM conversations""")
def q_clean_strings(spark, d):
    return clean_strings(fx.table(spark, d, "conversations"), trim_space=True, empty_as_null=True)


@register("cast_columns", """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""")
def q_cast_columns(spark, d):
    return cast_columns(fx.table(spark, d, "customer"),
                        {"c_custkey": "int", "c_nationkey": "bigint", "c_acctbal": "string"})


@register("json_extract", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def q_json_extract(spark, d):
    from tidemark.sources.files import apply_source_options
    e = fx.table(spark, d, "events")
    return apply_source_options(e, SourceOptions(jmespath={"k": ("props", "$.k")})).select("event_id", "k")


@register("column_casing", """
SELECT n_nationkey AS N_NATIONKEY, n_name AS N_NAME, n_regionkey AS N_REGIONKEY FROM nation""")
def q_column_casing(spark, d):
    return apply_casing(fx.table(spark, d, "nation"), "upper")


# ---------------------------------------------------------------- catalog, ad-hoc SQL
@register("catalog_roundtrip", "SELECT * FROM orders")
def q_catalog_roundtrip(spark, d):
    """CTAS with the rows up to WM, then INSERT ... SELECT of the rest (K8)."""
    import uuid
    from tidemark.sinks.catalog import create_table_as, insert_select, read_catalog_table
    o = fx.table(spark, d, "orders")
    wm = fx.snapshot_watermark(spark, d)
    name = f"tidemark_orders_{uuid.uuid4().hex[:10]}"
    create_table_as(o.where(F.col("o_orderkey") <= wm), name, work_path(spark, "catalog"))
    insert_select(o.where(F.col("o_orderkey") > wm), name)
    return read_catalog_table(spark, name)


@register("adhoc_sql", """
SELECT o_orderstatus, count(*) AS n_orders, min(o_orderdate) AS first_order, max(o_totalprice) AS max_total
FROM orders GROUP BY o_orderstatus""")
def q_adhoc_sql(spark, d):
    """Every Parquet file of a folder registered as a view, then ad-hoc SQL."""
    from tidemark.sinks.fs import HadoopFS
    from tidemark.sources.files import register_parquet_views
    names = [n.removesuffix(".parquet") for n in HadoopFS(spark).list_names(d) if n.endswith(".parquet")]
    register_parquet_views(spark, d, names)
    return spark.sql("""SELECT o_orderstatus, count(*) AS n_orders, min(o_orderdate) AS first_order,
                        max(o_totalprice) AS max_total FROM orders GROUP BY o_orderstatus""")


@register("mode_backfill_chunked", _SQL_UPSERT.format(
    hist=fx.SQL_HIST, snap=fx.SQL_SNAPSHOT, cond=f"hist_id >= {fx.SQL_WM} AND hist_id < {fx.SQL_WM2}"))
def q_mode_backfill_chunked(spark, d):
    """Backfill of [WM, WM2) in windows of a quarter of the range each."""
    path = work_path(spark, "backfill_chunked")
    _snapshot_target(spark, d, path)
    lo, hi = _wm_value(spark, d), _wm_value(spark, d, fx.SECOND_NUM, fx.SECOND_DEN)
    CopyJob(target_object=path, source=fx.history(spark, d).select("id", "bal", "hist_id"),
            mode=LoadMode.BACKFILL, primary_key=["id"], update_key="hist_id", backfill_range=(lo, hi),
            source_options=SourceOptions(chunk_size=max(1, (hi - lo) // 4 + 1))).run(spark)
    return VersionedStore(spark, path).read()


@register("json_flatten", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props__k FROM events""")
def q_json_flatten(spark, d):
    """JSON text parsed to a struct, then the flatten option (nested -> parent__child)."""
    from tidemark.sources.files import apply_source_options
    e = fx.table(spark, d, "events").select(
        "event_id", F.from_json("props", "k long").alias("props"))
    return apply_source_options(e, SourceOptions(flatten=True))


# ---------------------------------------------------------------- control values, modes and jobs
@register("version_upsert_ltz", _SQL_LATEST_EVENTS.format(o="ts"))
def q_version_upsert_ltz(spark, d):
    """Versioned by a timestamp with zone; the first sync finds no table yet."""
    events = fx.table(spark, d, "events")
    zoned = events.withColumn("ts", F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp"))))
    job = VersionUpsert(spark, work_path(spark, "upsert_ltz"), "user_id", "ts", bucket_width=50)
    job.sync(zoned.where(F.col("ts") <= F.lit(EVENTS_CUTOFF).cast("timestamp")))
    job.sync(zoned)
    out = job.store.read()
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("version_upsert_first_sync", _SQL_LATEST_EVENTS.format(o="event_id"))
def q_version_upsert_first_sync(spark, d):
    """No initial load: the first sync writes the buckets from the default checkpoint."""
    job = VersionUpsert(spark, work_path(spark, "upsert_first"), "user_id", "event_id", bucket_width=50)
    job.sync(fx.table(spark, d, "events"))
    return job.store.read()


@register("mode_incremental_binary", _SQL_UPSERT.format(hist=fx.SQL_HIST, snap=fx.SQL_SNAPSHOT, cond=f"hist_id > {fx.SQL_WM}"))
def q_mode_incremental_binary(spark, d):
    """Two increments on a binary row version: the watermark is kept byte for byte."""
    path = work_path(spark, "incremental_bin")

    def versioned(df):
        return df.select("id", "bal", "hist_id", long_to_rowversion("hist_id").alias("rv"))
    CopyJob(target_object=path, source=versioned(snapshot(spark, d))).run(spark)
    hist = versioned(fx.history(spark, d))
    for part in (hist.where(F.col("hist_id") <= fx.fraction_of_max(spark, d, fx.SECOND_NUM, fx.SECOND_DEN)), hist):
        CopyJob(target_object=path, source=part.where(F.col("hist_id") > fx.snapshot_watermark(spark, d)),
                mode=LoadMode.INCREMENTAL, primary_key=["id"], update_key="rv").run(spark)
    return VersionedStore(spark, path).read().drop("rv")


_SQL_PAGES = """
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)
SELECT o.*, CAST((r.rn - 1) // 4000 + 1 AS BIGINT) AS page_id FROM orders o JOIN r USING (o_orderkey)"""


@register("keyset_pages_binary", _SQL_PAGES)
def q_keyset_pages_binary(spark, d):
    from tidemark.operators.ranges import assign_pages, page_plan
    o = fx.table(spark, d, "orders").withColumn("rv", long_to_rowversion("o_orderkey"))
    return assign_pages(o, "rv", page_plan(o, "rv", 4000)).drop("rv")


@register("keyset_page_ltz", "SELECT * FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 5000")
def q_keyset_page_ltz(spark, d):
    o = fx.table(spark, d, "orders").withColumn("at", F.timestamp_micros(F.col("o_orderkey") * 3_600_000_001))
    return keyset_page(o, "at", str(1000 * 3_600_000_001), 5000).drop("at")


def _history_copy(spark, d, path, mode, **kw):
    CopyJob(target_object=path, source=fx.history(spark, d).select("id", "bal", "hist_id"), mode=mode,
            primary_key=["id"], update_key="hist_id", **kw).run(spark)


@register("mode_backfill_two_ranges", _SQL_UPSERT.format(hist=fx.SQL_HIST, snap=fx.SQL_SNAPSHOT, cond=f"hist_id >= {fx.SQL_WM}"))
def q_mode_backfill_two_ranges(spark, d):
    """The later range first, in windows; then the earlier one, which must not be taken as done and must not
    overwrite newer versions."""
    path = work_path(spark, "backfill_two")
    _snapshot_target(spark, d, path)
    lo, mid = _wm_value(spark, d), _wm_value(spark, d, fx.SECOND_NUM, fx.SECOND_DEN)
    hi = _wm_value(spark, d, 1, 1) + 1
    for a, b in ((mid, hi), (lo, mid)):
        _history_copy(spark, d, path, LoadMode.BACKFILL, backfill_range=(a, b), source_options=SourceOptions(chunk_size=max(1, (b - a) // 2 + 1)))
    return VersionedStore(spark, path).read()


@register("mode_backfill_absent_target", f"""
SELECT id, bal, hist_id FROM {fx.SQL_HIST} h WHERE hist_id >= {fx.SQL_WM} AND hist_id < {fx.SQL_WM2}
QUALIFY row_number() OVER (PARTITION BY id ORDER BY hist_id DESC) = 1""")
def q_mode_backfill_absent_target(spark, d):
    path = work_path(spark, "backfill_absent")
    rng = (_wm_value(spark, d), _wm_value(spark, d, fx.SECOND_NUM, fx.SECOND_DEN))
    _history_copy(spark, d, path, LoadMode.BACKFILL, backfill_range=rng)
    return VersionedStore(spark, path).read()


@register("mode_incremental_first_load", f"""
SELECT id, bal, hist_id FROM {fx.SQL_HIST} h QUALIFY row_number() OVER (PARTITION BY id ORDER BY hist_id DESC) = 1""")
def q_mode_incremental_first_load(spark, d):
    path = work_path(spark, "incremental_first")
    _history_copy(spark, d, path, LoadMode.INCREMENTAL)
    return VersionedStore(spark, path).read()


@register("mode_incremental_ties", "SELECT o_orderkey, o_orderdate FROM orders")
def q_mode_incremental_ties(spark, d):
    """Half the rows of every date first; the rows that share the watermark's date come later."""
    o = fx.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    path = work_path(spark, "incremental_ties")
    last = o.agg(F.max("o_orderdate").alias("m"))
    for part in (o.join(last, o.o_orderdate < last.m, "left_semi").unionByName(o.join(last, o.o_orderdate == last.m, "left_semi").where("o_orderkey % 2 = 0")), o):
        CopyJob(target_object=path, source=part, mode=LoadMode.INCREMENTAL, primary_key=["o_orderkey"], update_key="o_orderdate").run(spark)
    return VersionedStore(spark, path).read()


@register("mode_snapshot_new_column", """
SELECT n_nationkey, n_name, CAST(NULL AS BIGINT) AS n_regionkey, TIMESTAMP '2024-01-01 00:00:00' AS loaded_at FROM nation
UNION ALL SELECT n_nationkey, n_name, n_regionkey, TIMESTAMP '2024-01-02 00:00:00' AS loaded_at FROM nation""")
def q_mode_snapshot_new_column(spark, d):
    import datetime as dt
    path = work_path(spark, "snapshot_new")
    n = fx.table(spark, d, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").cast("long").alias("n_regionkey"))
    for day, df in ((1, n.drop("n_regionkey")), (2, n)):
        CopyJob(target_object=path, source=df, mode=LoadMode.SNAPSHOT, loaded_at=dt.datetime(2024, 1, day),
                target_options=TargetOptions(add_new_columns=True)).run(spark)
    return VersionedStore(spark, path).read()


@register("refresh_then_incremental", _SQL_UPSERT.format(hist=fx.SQL_HIST, snap=fx.SQL_SNAPSHOT, cond=f"hist_id > {fx.SQL_WM}"))
def q_refresh_then_incremental(spark, d):
    """A load up to the end, a full refresh with older rows, then an increment from the refreshed table."""
    path = work_path(spark, "refreshed")
    _history_copy(spark, d, path, LoadMode.INCREMENTAL)
    _snapshot_target(spark, d, path)
    _history_copy(spark, d, path, LoadMode.INCREMENTAL)
    return VersionedStore(spark, path).read()


@register("append_job", "SELECT * FROM orders")
def q_append_job(spark, d):
    from tidemark.plans.copy import append_job
    o = fx.table(spark, d, "orders")
    store = VersionedStore(spark, work_path(spark, "append_job"))
    for part in (o.where(F.col("o_orderkey") <= fx.snapshot_watermark(spark, d)), o, o):
        append_job(store, part, "o_orderkey")
    return store.read()


@register("merge_job", _SQL_UPSERT.format(hist=fx.SQL_HIST, snap=fx.SQL_SNAPSHOT, cond=f"hist_id > {fx.SQL_WM}"))
def q_merge_job(spark, d):
    from tidemark.plans.copy import merge_job
    store = VersionedStore(spark, work_path(spark, "merge_job"))
    _snapshot_target(spark, d, store.root)
    merge_job(store, fx.history(spark, d).select("id", "bal", "hist_id"), "id", "hist_id")
    return store.read()


@register("rates_malformed", """
SELECT count(DISTINCT s_suppkey // 20) AS n_documents, count(DISTINCT s_suppkey // 20) FILTER ((s_suppkey // 20) % 3 = 0) AS n_malformed
FROM supplier""")
def q_rates_malformed(spark, d):
    """Every third rate document cut short: counted, not silently empty."""
    from tidemark.sources.rates import count_malformed
    docs = rate_documents(spark, d)
    cut = F.when(F.col("day") % 3 == 0, F.expr("left(xml, length(xml) - 20)")).otherwise(F.col("xml"))
    return count_malformed(docs.withColumn("xml", cut))


from tidemark import suite_jobs  # noqa: E402,F401  (registers its queries here)
