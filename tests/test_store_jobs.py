"""Versioned store and jobs: control flow, state and failure behaviour."""

import pytest

from conftest import SF001, rows
from pyspark.sql import functions as F
from tidemark.plans.cdc import SnapshotSync, run_many
from tidemark.plans.copy import CopyJob, resumable_load
from tidemark.plans.upsert import VersionUpsert, checkpoint_literal, encode_checkpoint
from tidemark.sinks.store import ManifestError, VersionedStore
from tidemark.sources.files import read_files
from tidemark.specs import LoadMode, SourceOptions, TableSpec, TargetOptions

MAIN = "id long, bal double"
HIST = "id long, bal double, hist_id long, op int"


def test_store_replace_parts_drops_emptied_bucket(spark, tmp_root):
    s = VersionedStore(spark, tmp_root)
    df = spark.createDataFrame([(1, 0), (2, 0), (150, 1)], "id long, part_id long")
    s.replace(df, part_col="part_id")
    s.replace_parts(spark.createDataFrame([], "id long, part_id long"), [0])
    assert rows(s.read()) == [(150, 1)]
    assert set(s.manifest()["parts"]) == {"1"}


def test_data_column_named_like_layout_survives(spark, tmp_root):
    s = VersionedStore(spark, tmp_root)
    df = spark.createDataFrame([(1, 7, 0), (2, 8, 1)], "id long, v long, part_id long")
    s.replace(df, part_col="part_id")
    s.append(spark.createDataFrame([(3, 9, 1)], "id long, v long, part_id long"))
    assert rows(s.read(), "id", "v", "part_id") == [(1, 7, 0), (2, 8, 1), (3, 9, 1)]


def test_unreadable_manifest_is_an_error(spark, tmp_root):
    s = VersionedStore(spark, tmp_root)
    s.replace(spark.range(3))
    s.fs.write_text_atomic(f"{s.manifest_dir}/{2:012d}.json", "{not json")
    with pytest.raises(ManifestError):
        s.manifest()


def test_manifest_sequence_cannot_be_published_twice(spark, tmp_root):
    s = VersionedStore(spark, tmp_root)
    s.replace(spark.range(3))
    with pytest.raises(RuntimeError):
        s.fs.write_text_atomic(f"{s.manifest_dir}/{1:012d}.json", "{}")


def test_retain_keeps_backup_generation(spark, tmp_root):
    s = VersionedStore(spark, tmp_root)
    for i in range(4):
        s.replace(spark.range(i + 1))
    dropped = s.retain(2)
    assert dropped == ["tm_version=1", "tm_version=2"]
    assert s.read().count() == 4


def test_compaction_rewrites_small_files(spark, tmp_root):
    s = VersionedStore(spark, tmp_root)
    df = spark.range(0, 400).withColumn("part_id", F.col("id") % 3)
    s.replace(df.where("id < 100"), part_col="part_id")
    for i in range(1, 4):
        s.append(df.where(f"id >= {i * 100} AND id < {i * 100 + 100}"))
    assert len(s.read().inputFiles()) == 12
    s.compact(key="id")
    assert len(s.read().inputFiles()) == 3 and rows(s.read()) == rows(df)


def _job(spark, root, main_rows, hist_rows, **spec):
    return SnapshotSync(spark, root, TableSpec("t", ["id"], **spec),
                        main=spark.createDataFrame(main_rows, MAIN),
                        history=spark.createDataFrame(hist_rows, HIST))


def test_run_dispatches_init_then_sync(spark, tmp_root):
    job = _job(spark, tmp_root, [(1, 1.0), (2, 2.0)], [(1, 1.0, 5, 1)])
    assert job.run() == "init"
    assert job.store.state()["watermark"] == 5
    assert job.run() == "no-changes"
    job.history = spark.createDataFrame([(1, 1.0, 5, 1), (2, 0.0, 6, 0)], HIST)
    assert job.run() == "sync"
    assert rows(job.store.read(), "id") == [(1,)]
    # D3: the newest change was a delete; the watermark must still advance to 6
    assert job.store.state()["watermark"] == 6
    assert job.run(force_init=True) == "init"


def test_init_without_rows_publishes_nothing(spark, tmp_root):
    job = _job(spark, tmp_root, [], [])
    assert job.run() == "empty"
    assert not job.store.exists()


def test_empty_history_then_changes_are_all_applied(spark, tmp_root):
    # Null watermark at init must not block later changes
    job = _job(spark, tmp_root, [(1, 1.0)], [])
    job.run()
    assert job.store.state()["watermark"] is None
    job.history = spark.createDataFrame([(2, 2.0, 1, 1)], HIST)
    assert job.run() == "sync"
    assert rows(job.store.read(), "id") == [(1,), (2,)]


def test_replayed_batch_id_is_skipped(spark, tmp_root):
    job = _job(spark, tmp_root, [(1, 1.0)], [(1, 1.0, 1, 1)])
    job.run()
    b = spark.createDataFrame([(3, 3.0, 2, 1)], HIST)
    assert job.sync(changes=b, batch_id=0)
    assert not job.sync(changes=b, batch_id=0)
    assert job.store.state()["batches"] == {"default": 0}


def test_bucketed_sync_rewrites_only_touched_parts(spark, tmp_root):
    job = _job(spark, tmp_root, [(1, 1.0), (150, 2.0), (-5, 3.0)], [(1, 1.0, 1, 1)], bucket_width=100)
    job.run()
    m1 = job.store.manifest()
    assert set(m1["parts"]) == {"0", "1", "-1"}
    job.history = spark.createDataFrame([(1, 9.0, 2, 1), (-5, 0.0, 3, 0)], HIST)
    job.run()
    m2 = job.store.manifest()
    assert m2["parts"]["1"] == m1["parts"]["1"]       # untouched part not rewritten
    assert "-1" not in m2["parts"]                     # emptied by the delete
    assert rows(job.store.read(), "id", "bal") == [(1, 9.0), (150, 2.0)]


def test_run_many(spark, tmp_root):
    a = SnapshotSync(spark, tmp_root + "/a", TableSpec("a", ["id"]),
                     main=spark.createDataFrame([(1, 1.0)], MAIN), history=spark.createDataFrame([], HIST))
    b = SnapshotSync(spark, tmp_root + "/b", TableSpec("b", ["id"]),
                     main=spark.createDataFrame([], MAIN), history=spark.createDataFrame([], HIST))
    assert run_many([a, b]) == {"a": "init", "b": "empty"}
    assert a.store.exists() and not b.store.exists()


def test_version_upsert_checkpoint_defaults_and_bucket_per_row(spark, tmp_root):
    from pyspark.sql import types as T
    assert encode_checkpoint(bytes([0, 1]), T.BinaryType()) == "0x0001"
    lit = spark.range(1).select(checkpoint_literal(None, T.TimestampNTZType())).first()[0]
    assert str(lit) == "1900-01-01 00:00:00"
    src = spark.createDataFrame([(5, 1), (1_000_003, 2)], "id long, ver long")
    job = VersionUpsert(spark, tmp_root, "id", "ver", bucket_width=1_000_000)
    job.init(src)
    assert set(job.store.manifest()["parts"]) == {"0", "1"}   # D5: bucket per row
    assert job.store.state()["checkpoint"] == "2"             # D8: checkpoint at init
    newer = spark.createDataFrame([(5, 1), (1_000_003, 2), (5, 3), (7, 4)], "id long, ver long")
    assert job.sync(newer)
    assert rows(job.store.read(), "id", "ver") == sorted([(5, 3), (7, 4), (1_000_003, 2)], key=repr)
    assert not job.sync(newer)


def test_copy_job_validates_before_reading(spark):
    with pytest.raises(ValueError, match="target_object"):
        CopyJob(source=spark.range(1)).run(spark)
    with pytest.raises(ValueError, match="src_conn"):
        CopyJob(target_object="/nowhere").run(spark)
    with pytest.raises(ValueError, match="primary_key"):
        CopyJob(target_object="/nowhere", source=spark.range(1), mode=LoadMode.INCREMENTAL).run(spark)


def test_copy_job_options(spark, tmp_root):
    df = spark.createDataFrame([(1, "a")], "Id long, FirstName string")
    CopyJob(target_object=tmp_root, source=df,
            target_options=TargetOptions(column_casing="snake", file_max_rows=1)).run(spark)
    assert VersionedStore(spark, tmp_root).read().columns == ["id", "first_name"]
    m = CopyJob(target_object=tmp_root, source=spark.range(5),
                target_options=TargetOptions(ignore_existing=True)).run(spark)
    assert m["seq"] == 1


def test_resumable_load_restarts_after_last_page(spark, tmp_root):
    src = spark.read.parquet(f"{SF001}/orders.parquet")
    s = VersionedStore(spark, tmp_root)
    assert resumable_load(spark, s, src, "o_orderkey", 600, max_pages=1) == 1
    first = s.state()["last_key"]
    n = resumable_load(spark, s, src, "o_orderkey", 600)
    assert n >= 1 and s.read().count() == src.count()
    assert int(s.state()["last_key"]) > int(first)
    assert resumable_load(spark, s, src, "o_orderkey", 600) == 0     # nothing left


def test_resumable_load_pages_closed_on_ties(spark, tmp_root):
    from tidemark.operators.ranges import page_plan
    src = spark.createDataFrame([(k,) for k in [1, 2, 2, 2, 2, 3, 4, 5, 5]], "k long")
    assert page_plan(src, "k", 2) == ["2", "3", "5"]
    s = VersionedStore(spark, tmp_root)
    assert resumable_load(spark, s, src, "k", 2) == 3
    assert rows(s.read()) == rows(src)


def test_adjust_column_type_widens_target(spark, tmp_root):
    t = spark.createDataFrame([(1, 1)], "id long, v int")
    CopyJob(target_object=tmp_root, source=t).run(spark)
    src = spark.createDataFrame([(1, 5_000_000_000), (2, 7)], "id long, v long")
    CopyJob(target_object=tmp_root, source=src, mode=LoadMode.INCREMENTAL, primary_key=["id"],
            update_key="v", target_options=TargetOptions(adjust_column_type=True)).run(spark)
    out = VersionedStore(spark, tmp_root).read()
    assert out.schema["v"].dataType.simpleString() == "bigint"
    assert rows(out) == [(1, 5_000_000_000), (2, 7)]


def test_chunked_backfill_resumes_after_last_window(spark, tmp_root):
    from tidemark.specs import SourceOptions
    t = spark.createDataFrame([(k, 0) for k in range(10)], "id long, ver long")
    CopyJob(target_object=tmp_root, source=t).run(spark)
    src = spark.createDataFrame([(k, 10 + k) for k in range(10)], "id long, ver long")
    job = CopyJob(target_object=tmp_root, source=src, mode=LoadMode.BACKFILL, primary_key=["id"],
                  update_key="ver", backfill_range=(10, 16), source_options=SourceOptions(chunk_size=4))
    job.run(spark)
    s = VersionedStore(spark, tmp_root)
    assert not [k for k in s.state() if k.startswith("backfill")]      # a finished range leaves no mark
    assert rows(s.read()) == sorted([(k, 10 + k) for k in range(6)] + [(k, 0) for k in range(6, 10)])
    seq = s.manifest()["seq"]
    job.run(spark)          # nothing left in the range: no new version
    assert s.manifest()["seq"] == seq


@pytest.mark.parametrize("target", [None, "csv", "json"])
def test_file_max_bytes_bounds_files_of_any_frame(spark, tmp_root, target):
    """The frame is derived: no input file tells how large its rows are."""
    src = spark.read.parquet(f"{SF001}/lineitem.parquet").select("*", F.repeat(F.md5(F.col("l_orderkey").cast("string")), 6).alias("wide"))
    job = CopyJob(target_object=tmp_root, source=src.coalesce(1), tgt_conn=target,
                  target_options=TargetOptions(file_max_bytes=60_000, compression="zstd" if target is None else "none"))
    job.run(spark)
    fs = VersionedStore(spark, tmp_root).fs
    sizes = [n for f, n in fs.files(tmp_root) if "_manifest" not in f]
    assert len(sizes) > 3 and max(sizes) <= 60_000
    out = VersionedStore(spark, tmp_root).read() if target is None else read_files(spark, tmp_root, target, SourceOptions(
        schema=src.schema.simpleString()[7:-1].replace(":", " ")))
    assert out.count() == src.count()


def test_checkpoint_filter_reaches_the_scan(spark, tmp_root):
    from pyspark.sql import types as T
    src_path = tmp_root + "/src"
    spark.createDataFrame([(1, 5), (2, 9)], "id long, ver long").write.parquet(src_path)
    src = spark.read.parquet(src_path)
    lit = checkpoint_literal("7", T.LongType())
    plan = src.where(F.col("ver") > lit)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ver,7)" in plan


def test_overlap_rereads_tail_without_overriding_newer_rows(spark, tmp_root):
    # history ids 1..4 applied; id 3 for key 7 commits late (seen only on the next run)
    job = _job(spark, tmp_root, [(1, 1.0), (2, 2.0)], [], overlap=3)
    job.run()
    job.history = spark.createDataFrame([(1, 10.0, 1, 1), (2, 20.0, 2, 1), (1, 11.0, 4, 1)], HIST)
    job.run()
    assert job.store.state()["watermark"] == 4
    late = spark.createDataFrame([(1, 10.0, 1, 1), (2, 20.0, 2, 1), (7, 7.0, 3, 1), (1, 11.0, 4, 1)], HIST)
    job.history = late
    assert job.run() == "sync"
    # key 7 (id 3 < watermark 4) is caught by the overlap; keys 1, 2 are not overridden
    assert rows(job.store.read(), "id", "bal", "hist_id") == [(1, 11.0, 4), (2, 20.0, 2), (7, 7.0, 3)]
    assert job.store.state()["watermark"] == 4
    seq = job.store.manifest()["seq"]
    assert job.run() == "no-changes"   # re-reading the same tail again changes nothing
    assert job.store.manifest()["seq"] == seq
    assert rows(job.store.read(), "id", "bal", "hist_id") == [(1, 11.0, 4), (2, 20.0, 2), (7, 7.0, 3)]


def test_guard_versions_drops_stale_changes(spark):
    from tidemark.operators.merge import cdc_merge
    snap = spark.createDataFrame([(1, 1.0, 10, 1), (2, 2.0, 5, 1)], HIST)
    ch = spark.createDataFrame([(1, 9.0, 8, 1), (2, 0.0, 6, 0), (3, 3.0, 7, 1)], HIST)
    out = cdc_merge(snap, ch, "id", watermark=None, guard_versions=True)
    assert rows(out, "id", "bal") == [(1, 1.0), (3, 3.0)]


def test_timestamp_checkpoint_rereads_the_boundary_instant(spark, tmp_root):
    first = spark.sql("SELECT 1L AS id, TIMESTAMP_NTZ'2024-01-01 00:00:05' AS ts")
    job = VersionUpsert(spark, tmp_root, "id", "ts", bucket_width=100)
    job.init(first)
    seq = job.store.manifest()["seq"]
    assert not job.sync(first)                     # boundary row already applied
    assert job.store.manifest()["seq"] == seq
    # a second row with the same instant arrives late: ">=" still picks it up
    late = spark.sql("""SELECT * FROM VALUES (1L, TIMESTAMP_NTZ'2024-01-01 00:00:05'),
                        (2L, TIMESTAMP_NTZ'2024-01-01 00:00:05') AS t(id, ts)""")
    assert job.sync(late)
    assert rows(job.store.read(), "id") == [(1,), (2,)]


def test_overlap_on_bucketed_store(spark, tmp_root):
    job = _job(spark, tmp_root, [(1, 1.0), (150, 2.0)], [], overlap=5, bucket_width=100)
    job.run()
    job.history = spark.createDataFrame([(1, 10.0, 1, 1), (150, 0.0, 2, 0)], HIST)
    assert job.run() == "sync"
    seq = job.store.manifest()["seq"]
    assert job.run() == "no-changes"          # same tail re-read: nothing published
    assert job.store.manifest()["seq"] == seq
    job.history = spark.createDataFrame([(1, 10.0, 1, 1), (150, 0.0, 2, 0), (151, 5.0, 3, 1)], HIST)
    assert job.run() == "sync"
    assert rows(job.store.read(), "id", "bal") == [(1, 10.0), (151, 5.0)]


def test_many_versions_read_in_one_scan(spark, tmp_root):
    s = VersionedStore(spark, tmp_root)
    s.replace(spark.createDataFrame([(1, "a b"), (2, None)], "id long, part string"), part_col="part")
    for i in range(70):
        s.append(spark.createDataFrame([(10 + i, ["x:y", "a b", "p%q", None][i % 4])], "id long, part string"))
    want = [(1, "a b"), (2, None)] + [(10 + i, ["x:y", "a b", "p%q", None][i % 4]) for i in range(70)]
    assert rows(s.read()) == sorted(want, key=repr)
    plan = s.read().where("part = 'x:y'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(part" in plan
    assert rows(s.read(parts=["x:y", None])) == sorted([r for r in want if r[1] in ("x:y", None)], key=repr)
    assert s.paths()[1:] and all("part=" not in p for p in s.paths())      # whole versions are live


def _copy(root, src, mode, **kw):
    return CopyJob(target_object=root, source=src, mode=mode, primary_key=["id"], update_key="ver", **kw)


def test_backfill_two_ranges_later_first(spark, tmp_root):
    from tidemark.specs import SourceOptions
    src = spark.createDataFrame([(k, k * 10) for k in range(20)], "id long, ver long")
    for rng in ((100, 200), (0, 100)):
        _copy(tmp_root, src, LoadMode.BACKFILL, backfill_range=rng, source_options=SourceOptions(chunk_size=30)).run(spark)
    assert rows(VersionedStore(spark, tmp_root).read()) == rows(src)


def test_chunked_backfill_of_datetimes_resumes(spark, tmp_root, monkeypatch):
    import datetime as dt
    from tidemark.plans import copy
    from tidemark.specs import SourceOptions
    src = spark.range(40).selectExpr("id", "timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,id) AS ver")
    job = _copy(tmp_root, src, LoadMode.BACKFILL, backfill_range=(dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 30)),
                source_options=SourceOptions(chunk_size=dt.timedelta(days=10)))
    once, calls = copy._upsert, []

    def stops(*a, **k):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return once(*a, **k)
    monkeypatch.setattr(copy, "_upsert", stops)
    with pytest.raises(RuntimeError):
        job.run(spark)
    monkeypatch.setattr(copy, "_upsert", once)
    store = VersionedStore(spark, tmp_root)
    assert [v for k, v in store.state().items() if k.startswith("backfill")] == [1]
    job.run(spark)
    assert rows(store.read(), "id") == sorted([(i,) for i in range(2, 29)], key=repr)


def test_modes_on_an_absent_target(spark, tmp_root):
    src = spark.createDataFrame([(1, 5), (1, 7), (2, 250)], "id long, ver long")
    _copy(tmp_root + "/b", src, LoadMode.BACKFILL, backfill_range=(0, 100)).run(spark)
    _copy(tmp_root + "/i", src, LoadMode.INCREMENTAL).run(spark)
    assert rows(VersionedStore(spark, tmp_root + "/b").read()) == [(1, 7)]
    i = VersionedStore(spark, tmp_root + "/i")
    assert rows(i.read()) == [(1, 7), (2, 250)] and i.state()["incremental_watermark"] == "250"


def test_incremental_ties_and_empty_increment(spark, tmp_root):
    import datetime as dt
    day = lambda n: dt.date(2024, 1, n)
    first = spark.createDataFrame([(1, day(5)), (2, day(9))], "id long, ver date")
    _copy(tmp_root, first, LoadMode.INCREMENTAL).run(spark)
    _copy(tmp_root, first.union(spark.createDataFrame([(3, day(9))], first.schema)), LoadMode.INCREMENTAL).run(spark)
    store = VersionedStore(spark, tmp_root)
    assert rows(store.read()) == [(1, day(5)), (2, day(9)), (3, day(9))]
    seq = store.manifest()["seq"]
    _copy(tmp_root, store.read(), LoadMode.INCREMENTAL).run(spark)
    assert store.manifest()["seq"] == seq


def test_incremental_on_binary_and_zoned_timestamps(spark, tmp_root, monkeypatch):
    import time
    monkeypatch.setenv("TZ", "Europe/Istanbul")      # process zone; the session's is UTC
    time.tzset()
    try:
        for name, expr in (("bin", "unhex(lpad(hex(v), 16, '0'))"), ("ltz", "timestamp_micros(v * 3600000000)")):
            def frame(vals):
                return spark.createDataFrame(vals, "id long, v long").selectExpr("id", f"{expr} AS ver")
            a = [(1, 1), (2, 2)]
            for more in ([], [(3, 3)], [(4, 4)]):
                a = a + more
                _copy(f"{tmp_root}/{name}", frame(a), LoadMode.INCREMENTAL).run(spark)
            assert rows(VersionedStore(spark, f"{tmp_root}/{name}").read(), "id") == [(i,) for i, _ in a]
            up = VersionUpsert(spark, f"{tmp_root}/{name}-up", "id", "ver", bucket_width=10)
            up.init(frame(a))
            assert up.sync(frame([*a, (5, 5)])) and rows(up.store.read(), "id") == [(i,) for i in range(1, 6)]
            load = VersionedStore(spark, f"{tmp_root}/{name}-load")
            assert resumable_load(spark, load, frame(a), "ver", 2, max_pages=1) == 1
            assert load.read().count() == 0      # unfinished: invisible
            assert resumable_load(spark, load, frame(a), "ver", 2) == 1 and rows(load.read(), "id") == [(i,) for i, _ in a]
    finally:
        monkeypatch.undo()
        time.tzset()


def test_full_refresh_starts_a_fresh_state(spark, tmp_root):
    _copy(tmp_root, spark.createDataFrame([(1, 1000)], "id long, ver long"), LoadMode.INCREMENTAL).run(spark)
    _copy(tmp_root, spark.createDataFrame([(1, 10)], "id long, ver long"), LoadMode.FULL_REFRESH).run(spark)
    _copy(tmp_root, spark.createDataFrame([(2, 500)], "id long, ver long"), LoadMode.INCREMENTAL).run(spark)
    assert rows(VersionedStore(spark, tmp_root).read()) == [(1, 10), (2, 500)]


def test_bucketed_copy_rewrites_touched_parts_only(spark, tmp_root):
    src = spark.range(100).selectExpr("id", "id AS ver")
    _copy(tmp_root, src, LoadMode.FULL_REFRESH, bucket_width=10).run(spark)
    store = VersionedStore(spark, tmp_root)
    before = store.manifest()["parts"]
    _copy(tmp_root, spark.createDataFrame([(55, 700), (105, 701)], "id long, ver long"), LoadMode.INCREMENTAL, bucket_width=10).run(spark)
    after = store.manifest()["parts"]
    assert {p for p in after if after[p] != before.get(p)} == {"5", "10"} and store.read().count() == 101


def test_snapshot_adds_new_columns(spark, tmp_root):
    import datetime as dt
    for day, df in ((1, spark.createDataFrame([(1, 2)], "id long, ver long")), (2, spark.createDataFrame([(1, 3, "x")], "id long, ver long, more string"))):
        _copy(tmp_root, df, LoadMode.SNAPSHOT, loaded_at=dt.datetime(2024, 1, day), target_options=TargetOptions(add_new_columns=True)).run(spark)
    assert rows(VersionedStore(spark, tmp_root).read(), "id", "ver", "more") == [(1, 2, None), (1, 3, "x")]


def test_combinations_that_would_widen_a_load_are_rejected(spark, tmp_root):
    from tidemark.specs import SourceOptions
    df = spark.createDataFrame([(1, 2)], "id long, ver long")
    with pytest.raises(ValueError, match="delete_missing"):
        _copy(tmp_root, df, LoadMode.INCREMENTAL, source_options=SourceOptions(limit=1, order_by=["id"]),
              target_options=TargetOptions(delete_missing=True)).run(spark)
    with pytest.raises(ValueError, match="tgt_conn"):
        _copy("t", df, LoadMode.BACKFILL, backfill_range=(0, 1), tgt_conn="jdbc:none:").run(spark)


def test_database_target_gets_the_stamped_frame(spark, monkeypatch):
    from tidemark.plans import copy
    seen = []
    monkeypatch.setattr(copy, "write_table", lambda df, url, table, **kw: seen.append((df.columns, table, kw["mode"])))
    df = spark.createDataFrame([(1, 2)], "id long, ver long")
    _copy("t", df, LoadMode.SNAPSHOT, tgt_conn="jdbc:none:").run(spark)
    _copy("t", df, LoadMode.TRUNCATE, tgt_conn="jdbc:none:").run(spark)
    assert seen == [(["id", "ver", "loaded_at"], "t", "append"), (["id", "ver"], "t", "overwrite")]


def test_resumable_load_reads_on_and_loads_null_keys(spark, tmp_root):
    store = VersionedStore(spark, tmp_root)
    src = spark.createDataFrame([(k,) for k in [*range(8), None]], "k long")
    assert resumable_load(spark, store, src, "k", 3, max_pages=2, pages_per_job=1) == 2 and store.read().count() == 0
    grown = src.union(spark.createDataFrame([(k,) for k in range(8, 12)], "k long"))
    resumable_load(spark, store, grown, "k", 3)
    assert rows(store.read()) == rows(grown)
    assert "page_plan" not in store.state()
    more = grown.union(spark.createDataFrame([(99,)], "k long"))
    assert resumable_load(spark, store, more, "k", 3) == 1 and rows(store.read()) == rows(more)


def test_first_sync_append_and_merge_jobs(spark, tmp_root):
    from tidemark.plans.copy import append_job, merge_job
    src = spark.createDataFrame([(1, 3), (1, 5), (2, 4)], "id long, ver long")
    up = VersionUpsert(spark, tmp_root + "/u", "id", "ver", bucket_width=10)
    assert up.sync(src) and rows(up.store.read(), "id", "ver") == [(1, 5), (2, 4)] and not up.sync(src)
    a = VersionedStore(spark, tmp_root + "/a")
    assert append_job(a, src, "ver") == 3 and append_job(a, src, "ver") == 0
    assert append_job(a, src.union(spark.createDataFrame([(9, 9)], src.schema)), "ver") == 1 and a.read().count() == 4
    m = VersionedStore(spark, tmp_root + "/m")
    merge_job(m, src, "id", "ver")
    merge_job(m, src.union(spark.createDataFrame([(2, 8), (3, 1)], src.schema)), "id", "ver")
    assert rows(m.read()) == [(1, 5), (2, 8)]      # (3, 1) is older than the last key


def test_read_table_knows_its_own_store_and_refuses_bare_delta(spark, tmp_root):
    from tidemark.sources.files import read_table
    s = VersionedStore(spark, tmp_root + "/s")
    s.replace(spark.range(3))
    s.replace(spark.range(5))
    assert read_table(spark, tmp_root + "/s").count() == 5
    spark.range(4).write.parquet(tmp_root + "/d")
    s.fs.mkdirs(tmp_root + "/d/_delta_log")
    with pytest.raises(Exception, match="(?i)delta"):
        read_table(spark, tmp_root + "/d").count()
