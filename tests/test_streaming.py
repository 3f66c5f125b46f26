"""CDC as Structured Streaming micro-batches (foreachBatch into the versioned store)."""

from conftest import rows
from tidemark.operators.merge import cdc_merge, init_snapshot
from tidemark.plans.cdc import SnapshotSync
from tidemark.specs import TableSpec
from tidemark.streaming.cdc_stream import start_cdc_stream

HIST = "id long, bal double, hist_id long, op int"


def test_stream_restart_processes_only_new_files(spark, tmp_root):
    main = spark.createDataFrame([(k, float(k)) for k in range(6)], "id long, bal double")
    job = SnapshotSync(spark, tmp_root + "/store", TableSpec("t", ["id"], bucket_width=4), main=main,
                       history=spark.createDataFrame([], HIST))
    assert job.run() == "init"
    landing = tmp_root + "/landing"
    b1 = spark.createDataFrame([(1, 10.0, 1, 1), (2, 0.0, 2, 0)], HIST)
    b2 = spark.createDataFrame([(1, 11.0, 3, 1), (9, 9.0, 4, 1)], HIST)
    b1.coalesce(1).write.mode("append").parquet(landing)
    start_cdc_stream(spark, job, landing, b1.schema, max_files_per_trigger=1).awaitTermination()
    seq_after_first = job.store.manifest()["seq"]
    b2.coalesce(1).write.mode("append").parquet(landing)
    start_cdc_stream(spark, job, landing, b1.schema, max_files_per_trigger=1).awaitTermination()
    assert job.store.manifest()["seq"] == seq_after_first + 1      # only the new file
    expected = cdc_merge(init_snapshot(main, None), b1.unionByName(b2), "id", watermark=None)
    assert rows(job.read(), "id", "bal") == rows(expected, "id", "bal")
    assert job.store.state()["watermark"] == 4


def _streamed(spark, root, batches, name="default"):
    main = spark.createDataFrame([(k, float(k)) for k in range(6)], "id long, bal double")
    job = SnapshotSync(spark, root + "/store", TableSpec("t", ["id"], bucket_width=4), main=main,
                       history=spark.createDataFrame([], HIST))
    if not job.store.exists():
        job.run()
    for i, b in enumerate(batches):
        job.sync(changes=spark.createDataFrame(b, HIST), batch_id=i, stream=name)
    return job


def test_batches_in_any_order(spark, tmp_root):
    late = [[(1, 11.0, 5, 1), (2, 0.0, 6, 0)], [(3, 30.0, 3, 1), (2, 20.0, 4, 1), (1, 10.0, 2, 1), (7, 7.0, 1, 1)]]
    job = _streamed(spark, tmp_root, late)
    # key 3 has a lower id than the first batch; key 2 stays deleted; key 1 keeps its newer row
    assert rows(job.read(), "id", "bal") == [(0, 0.0), (1, 11.0), (3, 30.0), (4, 4.0), (5, 5.0), (7, 7.0)]
    assert job.store.state()["watermark"] == 6


def test_force_init_starts_a_new_stream_state(spark, tmp_root):
    job = _streamed(spark, tmp_root, [[(1, 11.0, 5, 1)]])
    assert job.store.state()["batches"] == {"default": 0}
    job.run(force_init=True)
    assert job.sync(changes=spark.createDataFrame([(2, 22.0, 6, 1)], HIST), batch_id=0)
    assert (2, 22.0) in rows(job.read(), "id", "bal")


def test_changes_without_a_key_are_counted_and_left_out(spark, tmp_root):
    job = _streamed(spark, tmp_root, [[(None, 1.0, 5, 1), (1, 2.0, 6, 1), (None, 1.0, 7, 0)]])
    assert job.store.state()["rejected_null_keys"] == 2 and job.read().where("id IS NULL").count() == 0
    job.history = spark.createDataFrame([(None, 1.0, 8, 1), (4, 9.0, 9, 1)], HIST)
    assert job.run() == "sync"
    assert job.store.state()["rejected_null_keys"] == 3 and job.read().count() == 6
