"""Change detection by content, rows without a key, gaps of ids, floors of streams, many tables."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators.changes import effective, fingerprint
from tidemark.operators.gaps import bounded, still_open, stretches, within
from tidemark.plans.cdc import SnapshotSync, TablesFailed, run_many
from tidemark.plans.copy import CopyJob
from tidemark.plans.upsert import VersionUpsert
from tidemark.sinks.store import VersionedStore
from tidemark.specs import LoadMode, TableSpec


def test_effective(spark):
    cols = "k long, v long, a string, m map<string,int>"
    now = spark.createDataFrame([(1, 5, "a", {"x": 1, "y": 2}), (2, 5, None, None), (3, None, "a", None), (4, 5, "a", None), (5, 5, "a", None), (6, 5, None, {})], cols)
    new = spark.createDataFrame([(1, 5, "a", {"y": 2, "x": 1}), (2, 5, None, None), (3, None, "b", None), (4, 4, "z", None), (5, None, "z", None),
                                 (6, 5, None, {"x": 1}), (7, None, "n", None)], cols)
    for limit in (None, 100, 0):
        assert [r.k for r in effective(new, now, "k", "v", limit).sort("k").collect()] == [3, 6, 7]


def test_fingerprint_tells_nulls_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "a"), (None, None)], "x string, y string")
    assert df.select(fingerprint(df).alias("f")).distinct().count() == 4


def copy(spark, path, data, schema="id long, v long, x string", **kw):
    job = CopyJob(target_object=path, source=spark.createDataFrame(data, schema), primary_key=["id"], update_key="v", **kw)
    return job.run(spark)


@pytest.mark.parametrize("bucket", [None, 10])
def test_backfill_by_version_then_content(spark, tmp_root, bucket):
    kw = {"bucket_width": bucket, "part_col": "p"}
    copy(spark, tmp_root, [(1, 5, "a"), (2, 50, "b"), (3, 7, "c"), (30, 1, "k")], **kw)
    m = copy(spark, tmp_root, [(1, 5, "CORRECTED"), (2, 5, "old"), (3, 7, "c"), (4, 6, "new")], mode=LoadMode.BACKFILL, backfill_range=(0, 40), **kw)
    store = VersionedStore(spark, tmp_root)
    assert rows(store.read(), "id", "v", "x") == [(1, 5, "CORRECTED"), (2, 50, "b"), (3, 7, "c"), (30, 1, "k"), (4, 6, "new")]
    if bucket:
        assert m["parts"]["3"] == [1]       # untouched part
    again = copy(spark, tmp_root, [(1, 5, "CORRECTED")], mode=LoadMode.BACKFILL, backfill_range=(0, 40), **kw)
    assert again["parts"] == m["parts"]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "long"])
def test_null_keys_are_counted_not_multiplied(spark, tmp_root, kind):
    at = (lambda n: dt.datetime(2024, 1, n)) if kind == "timestamp_ntz" else (lambda n: n)
    schema = f"id long, v {kind}, x string"
    first = [(1, at(1), "a"), (None, at(1), "n"), (None, at(2), "n"), (2, at(2), "b"), (None, at(2), "m")]
    more = [*first, (None, at(2), "late"), (None, at(3), "x"), (3, at(3), "c"), (3, at(2), "older")]
    for data, n in ((first, 3), (first, 3), (more, 5), (more, 5), ([*more, (None, at(3), "y")], 6)):
        copy(spark, tmp_root, data, schema, mode=LoadMode.INCREMENTAL)
        store = VersionedStore(spark, tmp_root)
        assert store.state()["rejected_null_keys"] == n
        assert store.read().where("id is null").count() == 0
    assert rows(store.read(), "id", "x") == [(1, "a"), (2, "b"), (3, "c")]


def test_increment_on_a_number_takes_later_ties(spark, tmp_root):
    copy(spark, tmp_root, [(1, 5, "a")], mode=LoadMode.INCREMENTAL)
    copy(spark, tmp_root, [(1, 5, "a"), (2, 5, "b")], mode=LoadMode.INCREMENTAL)
    assert rows(VersionedStore(spark, tmp_root).read(), "id", "x") == [(1, "a"), (2, "b")]


def test_version_upsert_with_null_keys_and_corrections(spark, tmp_root):
    job = VersionUpsert(spark, tmp_root, "id", "v", bucket_width=10)
    t = dt.datetime(2024, 5, 1)
    schema = "id long, v timestamp, x string"
    data = [(1, t, "a"), (None, t, "n"), (None, t, "m"), (25, t, "b")]
    for _ in range(3):
        job.sync(spark.createDataFrame(data, schema))
    assert job.store.state()["rejected_null_keys"] == 2
    before = job.store.manifest()["parts"]
    assert job.sync(spark.createDataFrame([*data[1:], (1, t, "changed")], schema))
    after = job.store.manifest()["parts"]
    assert rows(job.store.read(), "id", "x") == [(1, "changed"), (25, "b")]
    assert after["2"] == before["2"] and after["0"] != before["0"]


def test_version_batches_in_any_order(spark, tmp_root):
    job = VersionUpsert(spark, tmp_root, "id", "v", bucket_width=10)
    new, old = [(1, 9, "new"), (2, 3, "x")], [(1, 4, "old"), (2, 3, "x"), (None, 1, "n")]

    def batch(data):
        return spark.createDataFrame(data, "id long, v long, x string")
    assert job.sync_batch(batch(new), 0) and not job.sync_batch(batch(old), 1) and not job.sync_batch(batch(new), 1)
    assert job.sync_batch(batch([(2, 3, "corrected")]), 0, "other")
    assert rows(job.store.read(), "id", "x") == [(1, "new"), (2, "corrected")]
    assert job.store.state()["rejected_null_keys"] == 1 and job.store.state()["batches"] == {"default": 1, "other": 0}


def test_sources_that_planning_finds_empty(spark, tmp_root):
    """A filter that contradicts the watermark's, or a source that is false throughout: no rows, no failure."""
    job = VersionUpsert(spark, tmp_root + "/u", "id", "v", bucket_width=10)
    data = spark.range(5).select("id", F.col("id").alias("v"))
    assert job.sync(data) and not job.sync(data.where("v < 3")) and not job.sync(data.where("false"))
    CopyJob(target_object=tmp_root + "/c", source=data.where("false"), mode=LoadMode.INCREMENTAL, primary_key=["id"], update_key="v").run(spark)
    hist = spark.range(9).select("id", F.col("id").alias("hist_id"), F.lit(1).alias("op"))
    for gaps in (0, 5):
        sync = SnapshotSync(spark, f"{tmp_root}/s{gaps}", TableSpec("t", "id", max_gaps=gaps), hist.select("id"), hist.where("hist_id <= 4"))
        assert (sync.run(), sync.run()) == ("init", "no-changes")


# ---------------------------------------------------------------- gaps
@settings(max_examples=12, deadline=None)
@given(st.sets(st.integers(0, 400), min_size=1), st.lists(st.integers(1, 5), min_size=1, max_size=3))
def test_gaps_name_what_was_not_seen(spark, ids, jumps):
    """Ids arrive in some order; after each step the stretches hold exactly the unseen ids below the watermark."""
    scale = 1 << 14     # spreads the ids over several cells
    left, seen, gaps, wm = sorted(i * scale for i in ids), set(), [], None
    for j in jumps:
        now = left[::j]
        left = [i for i in left if i not in set(now)]
        frame = spark.createDataFrame([(i,) for i in now], "h long")
        if now:
            gaps = still_open(frame, "h", gaps, wm, None, 10_000)
            wm = max([*now, *([wm] if wm is not None else [])])
            seen.update(now)
        inside = {i for lo, hi in gaps for i in range(lo - lo % scale, hi + 1, scale) if lo <= i <= hi}
        assert inside == {i for i in range(min(seen), wm, scale) if i not in seen}
        probe = spark.range(0, 401 * scale, scale)
        assert {r.id for r in probe.where(within(F.col("id"), gaps)).collect()} == inside


def test_many_gaps_are_joined_not_lost(spark):
    ids = spark.range(0, 3000, 3)
    found = stretches(ids, "id")
    assert found.count() == 999
    few = bounded(found, 20)
    assert len(few) <= 20
    assert not [r for r in found.collect() if not any(lo <= r.lo and r.hi <= hi for lo, hi in few)]
    assert still_open(ids, "id", [], None, 30, 100) == [[2968 + 3 * i, 2969 + 3 * i] for i in range(10)]


def test_late_commits_of_a_deleted_key(spark, tmp_root):
    """An older change that commits after the key's delete was applied does not bring the key back."""
    log = [(1, 10, 1, "a"), (2, 11, 1, "b"), (1, 12, 1, "late"), (1, 13, 0, None), (2, 14, 1, "late too"), (3, 15, 1, "c")]

    def history(*ids):
        return spark.createDataFrame([r for r in log if r[1] in ids], "id long, hist_id long, op int, x string")
    main = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    job = SnapshotSync(spark, tmp_root, TableSpec("t", "id", max_gaps=10), main, history(10, 11))
    assert job.run() == "init"
    for ids, result in (((10, 11, 13, 15), "sync"), ((10, 11, 12, 13, 15), "sync"), ((10, 11, 12, 13, 15), "no-changes"), ((10, 11, 12, 13, 14, 15), "sync")):
        job.history = history(*ids)
        assert job.run() == result
    assert rows(job.read(), "id", "x") == [(2, "late too"), (3, "c")]
    assert job.store.state()["gaps"] == [] and job.store.state()["rows_read"] == 4


# ---------------------------------------------------------------- floors and deletes of streams
def streamed(spark, root, **kw):
    main = spark.createDataFrame([(1, "a"), (2, "b"), (40, "z")], "id long, x string")
    hist = spark.createDataFrame([(9, 100, 1, "h")], "id long, hist_id long, op int, x string")
    job = SnapshotSync(spark, root, TableSpec("t", "id", bucket_width=10, **kw), main, hist)
    assert job.run() == "init"
    return job, lambda *r: spark.createDataFrame(list(r), "id long, hist_id long, op int, x string")


def test_stream_leaves_out_what_the_snapshot_holds(spark, tmp_root):
    job, batch = streamed(spark, tmp_root)
    assert not job.sync(batch((7, 10, 1, "deleted at 20, before the snapshot")), 0)
    assert job.sync(batch((7, 100, 1, "at the watermark"), (8, 101, 1, "new"), (None, 102, 1, "no key")), 1)
    assert rows(job.read(), "id") == [(1,), (2,), (40,), (8,)]
    assert job.store.state()["late_changes"] == 2 and job.store.state()["rejected_null_keys"] == 1


def test_stream_deletes_are_dropped_behind_the_slowest_stream(spark, tmp_root):
    job, batch = streamed(spark, tmp_root, lateness=10)
    job.sync(batch((1, 110, 0, None), (41, 111, 0, None)), 0, "x")
    job.sync(batch((2, 130, 0, None)), 0, "y")
    assert job.store.state()["floor"] == 101 and job.store.read().where("op = 0").count() == 3
    job.sync(batch((3, 150, 1, "c")), 1, "x")           # y is slower: the floor is 120
    assert job.store.state()["floor"] == 120
    assert rows(job.store.read().where("op = 0"), "id") == [(2,), (41,)]     # part 0 was rewritten, part 4 was not
    assert job.purge() == 1 and job.purge() == 0
    assert rows(job.store.read().where("op = 0"), "id") == [(2,)]
    assert not job.sync(batch((1, 115, 1, "too late")), 2, "x")
    assert rows(job.read(), "id") == [(3,), (40,)] and job.store.state()["late_changes"] == 1


# ---------------------------------------------------------------- many tables
def test_one_failing_table_does_not_stop_the_others(spark, tmp_root):
    main = spark.createDataFrame([(1, "a")], "id long, x string")
    hist = spark.createDataFrame([(1, 1, 1, "a")], "id long, hist_id long, op int, x string")

    def broken():
        raise OSError("source is away")
    jobs = [SnapshotSync(spark, f"{tmp_root}/{n}", TableSpec(n, "id"), broken if n == "b" else main, hist) for n in "abc"]
    with pytest.raises(TablesFailed, match="b: source is away") as e:
        run_many(jobs, at_once=2)
    assert e.value.done == {"a": "init", "c": "init"} and set(e.value.failed) == {"b"}
    assert run_many([jobs[0], jobs[2]]) == {"a": "no-changes", "c": "no-changes"}
