"""Compaction of small files, reconciliation by digests, slices by rank, quarantine, JSON documents, ledgers."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tidemark.functions.cleaning import round_fractional
from tidemark.operators.slices import rank_slice
from tidemark.plans.copy import CopyJob, append_job, load_ledger, resumable_load
from tidemark.plans.reconcile import differing_parts, in_parts, reconcile
from tidemark.sinks.parquet import write_files
from tidemark.sinks.store import VersionedStore
from tidemark.sources.files import apply_source_options, read_files
from tidemark.sources.quarantine import cast_checked, read_checked
from tidemark.specs import LoadMode, SourceOptions, TargetOptions


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- compaction
def test_compaction_leaves_large_files_and_other_parts(spark, tmp_root):
    s = VersionedStore(spark, tmp_root)
    df = spark.range(4000).select("id", F.md5(F.col("id").cast("string")).alias("x"), F.when(F.col("id") % 5 < 4, F.concat(F.lit("p:"), F.col("id") % 5)).alias("part"))
    s.replace(df.where("id < 3600").coalesce(1), part_col="part")
    for i in range(4):
        s.append(df.where(f"id >= {3600 + 100 * i} AND id < {3700 + 100 * i} AND (id % 5 = 1 OR id % 5 = 4)").coalesce(1))
    before = s.manifest()["parts"]
    size = min(n for _, n in s.fs.files(s.vdir(1)))
    planned = s.compact_small(target_file_bytes=size, key="id")
    after = s.manifest()["parts"]
    assert set(planned) == {"p%3A1", "__HIVE_DEFAULT_PARTITION__"}
    for p in after:
        assert after[p] == ([1, 6] if p in planned else before[p])
    wanted = df.where("id < 3600 OR id % 5 IN (1, 4)")
    assert rows(s.read()) == rows(wanted)
    files = [f for f, _ in s.fs.files(s.vdir(6))]
    assert all(sum(f.startswith(f"part={p}/") for f in files) <= n for p, (_, n) in planned.items())
    assert s.compact_small(target_file_bytes=size, key="id") == {}
    s.retain(1)
    assert rows(s.read()) == rows(wanted)


def test_compaction_packs_a_part_into_several_files(spark, tmp_root):
    s = VersionedStore(spark, tmp_root)
    df = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"))
    s.replace(df.where("id % 20 = 0").coalesce(1))
    for i in range(1, 20):
        s.append(df.where(f"id % 20 = {i}").coalesce(1))
    total = sum(n for v in range(1, 21) for _, n in s.fs.files(s.vdir(v)))
    (versions, n), = s.compact_small(target_file_bytes=total // 4 + 1).values()
    assert len(versions) == 20 and n == 4
    assert len(s.read().inputFiles()) == 4 and s.read().agg(F.sum("id")).first()[0] == sum(range(20_000))


# ---------------------------------------------------------------- reconciliation
def test_differing_parts_by_digest(spark):
    a = spark.createDataFrame([(1, None, 0), (2, "x", 0), (2, "x", 0), (11, "y", 1), (None, "n", None)], "id long, x string, p long")
    same = spark.createDataFrame([(2, "x", 0), (None, "n", None), (2, "x", 0), (11, "y", 1), (1, None, 0)], "id long, x string, p long")
    assert differing_parts(a, same, "p") == []
    other = spark.createDataFrame([(1, "", 0), (2, "x", 0), (11, "y", 1), (21, "z", 2)], "id long, x string, p long")
    assert sorted(differing_parts(a, other, "p"), key=repr) == [0, 2, None]


@pytest.mark.parametrize("parts", [[0, 1, 5], [3, -2], list(range(-201, 200, 2)), list(range(-200, 200, 2))])
def test_part_ranges_are_key_ranges(spark, parts):
    from tidemark.operators.buckets import bucket_id
    df = spark.range(-2500, 2500).select(F.when(F.col("id") % 97 != 0, F.col("id")).alias("id"))
    got = df.where(in_parts("id", parts, 10))
    want = df.where(bucket_id("id", 10).isin(parts))
    assert rows(got) == rows(want)


def test_reconcile_counts_and_repairs(spark, tmp_root):
    src = spark.createDataFrame([(i, f"v{i}") for i in range(50)] + [(None, "a"), (None, "b")], "id long, x string")
    s = VersionedStore(spark, tmp_root)
    drift = [(i, f"v{i}" if i != 17 else "wrong") for i in range(50) if i not in (3, 4)] + [(99, "extra"), (None, "a"), (None, "c")]
    CopyJob(target_object=tmp_root, source=spark.createDataFrame(drift, "id long, x string"), primary_key=["id"], bucket_width=10).run(spark)
    before = s.manifest()["parts"]
    found = reconcile(s, src, "id", bucket_width=10)
    assert (sorted(found.parts, key=repr), found.missing, found.extra, found.changed) == ([0, 1, 9], 3, 2, 1)
    after = s.manifest()["parts"]
    assert rows(s.read(), "id", "x") == rows(src) and "9" not in after
    assert all(after[p] == before[p] for p in ("2", "3", "4"))
    assert reconcile(s, src, "id", bucket_width=10).parts == []


def test_delete_missing_rewrites_parts_that_lose_keys_only(spark, tmp_root):
    data = [(i, 1, "x") for i in range(40)]
    job = {"primary_key": ["id"], "update_key": "v", "bucket_width": 10, "mode": LoadMode.INCREMENTAL}
    CopyJob(target_object=tmp_root, source=spark.createDataFrame(data, "id long, v long, x string"), **job).run(spark)
    s = VersionedStore(spark, tmp_root)
    left = [r for r in data if r[0] not in (12, 13)] + [(35, 2, "newer")]
    src = spark.createDataFrame([r for r in left if not (r[0] == 35 and r[1] == 1)], "id long, v long, x string")
    CopyJob(target_object=tmp_root, source=src, target_options=TargetOptions(delete_missing=True), **job).run(spark)
    assert rows(s.read(), "id", "v", "x") == rows(src)
    assert {p: v[0] for p, v in s.manifest()["parts"].items()} == {"0": 1, "1": 2, "2": 1, "3": 2}
    m = CopyJob(target_object=tmp_root, source=src, target_options=TargetOptions(delete_missing=True), **job).run(spark)
    assert {p: v[0] for p, v in m["parts"].items()} == {"0": 1, "1": 2, "2": 1, "3": 2}


# ---------------------------------------------------------------- slices
@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.none() | st.integers(0, 4), st.none() | st.sampled_from("abc"), st.integers(0, 2)), max_size=40), st.integers(0, 45), st.none() | st.integers(0, 45))
def test_slice_is_that_of_the_sorted_table(spark, data, offset, limit):
    df = spark.createDataFrame(data, "a int, b string, c int")
    got = [tuple(r) for r in rank_slice(df, ["a", "b"], offset, limit).collect()]

    def key(r):
        return [(x is not None, x or (0 if i == 0 else "")) for i, x in enumerate(r[:2])]
    want = sorted(data, key=key)[offset:None if limit is None else offset + limit]
    assert sorted(map(key, got)) == sorted(map(key, want))
    # rows of a slice are rows of the table, none more often than there
    assert all(got.count(r) <= data.count(r) for r in got)


def test_slices_of_a_table_make_the_table(spark):
    rnd = random.Random(4)
    df = spark.createDataFrame([(rnd.randrange(30), "same") for _ in range(700)], "a int, b string")
    parts = [rank_slice(df, ["a"], at, 123) for at in range(0, 700, 123)]
    assert sorted((r for p in parts for r in rows(p)), key=repr) == rows(df)


def test_slice_needs_no_task_of_all_rows(spark):
    df = spark.range(200_000).select(F.xxhash64("id").alias("k"), "id")
    out = apply_source_options(df, SourceOptions(order_by=["k"], offset=50_000, limit=100_000))
    assert "SinglePartition" not in plan_of(out) and out.count() == 100_000


# ---------------------------------------------------------------- quarantine
def test_checked_csv_keeps_what_it_cannot_read(spark, tmp_root):
    lines = ["1,2024-01-01 00:00:00,x", "two,2024-01-01 00:00:00,y", "3,not a time,z", "4,2024-01-02 00:00:00,w", "5,2024-01-02 00:00:00,a,b"]
    spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(tmp_root)
    out = read_checked(spark, tmp_root, "csv", tmp_root + "-side", SourceOptions(schema="id long, at timestamp_ntz, x string", header=False, trim_space=True))
    assert rows(out.good, "id", "x") == [(1, "x"), (4, "w")] and (out.n_good, out.n_bad) == (2, 3)
    assert sorted(r[0] for r in out.bad.collect()) == sorted([lines[1], lines[2], lines[4]])
    # the side table stays where it was asked for
    assert spark.read.parquet(tmp_root + "-side").where("tm_bad = 1").count() == 3


def test_checked_json_documents_and_lines(spark, tmp_root):
    spark.createDataFrame([('[{"a": 1}, {"a": 2}]',), ('{"a": 3}',), ('{"a": ',)], "v string").repartition(3).write.option("maxRecordsPerFile", 1).text(tmp_root)
    out = read_checked(spark, tmp_root, "json", tmp_root + "-side", SourceOptions(schema="a long"))
    assert rows(out.good) == [(1,), (2,), (3,)] and out.n_bad == 1
    with pytest.raises(ValueError):
        read_checked(spark, tmp_root, "parquet", tmp_root + "-x", SourceOptions(schema="a long"))
    with pytest.raises(ValueError):
        read_checked(spark, tmp_root, "json", tmp_root + "-x", SourceOptions())


def test_checked_casts(spark, tmp_root):
    df = spark.createDataFrame([("1", "2.5", "k"), ("x", "2", "k"), (None, None, "n"), ("3", "y", "k")], "a string, b string, c string")
    out = cast_checked(df, {"a": "int", "b": "double"}, tmp_root)
    assert rows(out.good) == [(1, 2.5, "k"), (None, None, "n")] and (out.n_good, out.n_bad) == (2, 2)
    assert rows(out.bad) == [("3", "y", "k"), ("x", "2", "k")]


def test_decimals_are_rounded_too(spark):
    df = spark.sql("SELECT CAST(1.23456 AS DECIMAL(10, 5)) AS d, CAST(7.1 AS DECIMAL(5, 1)) AS e, 2.71828D AS f, 4 AS n")
    out = round_fractional(df, 2)
    assert out.schema == df.schema or [f.dataType for f in out.schema] == [f.dataType for f in df.schema]
    assert [str(x) for x in out.first()] == ["1.23000", "7.1", "2.72", "4"]


# ---------------------------------------------------------------- JSON documents
def test_json_target_reads_back_whole(spark, tmp_root):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit('q"\n'), F.col("id").cast("string"))).alias("x"),
                                  F.struct((F.col("id") * 2).alias("y")).alias("s"))
    CopyJob(target_object=tmp_root, source=df.repartition(2), tgt_conn="json", target_options=TargetOptions(compression="none")).run(spark)
    assert rows(read_files(spark, tmp_root, "json", SourceOptions(schema="id long, x string, s struct<y: long>"))) == rows(df)
    files = [f for f, _ in VersionedStore(spark, tmp_root).fs.files(tmp_root)]
    assert len(files) == 2
    text = "\n".join(r[0] for r in spark.read.text(f"{tmp_root}/{files[0]}").collect())
    assert all(set(r) == {"id", "x", "s"} for r in json.loads(text))


def test_json_documents_are_bounded_and_empty_frames_written(spark, tmp_root):
    write_files(spark.range(95).coalesce(1), tmp_root, TargetOptions(format="json", file_max_rows=10, compression="none"))
    assert len(VersionedStore(spark, tmp_root).fs.files(tmp_root)) == 10
    assert read_files(spark, tmp_root, "json", SourceOptions(schema="id long")).count() == 95
    write_files(spark.range(0), tmp_root + "-none", TargetOptions(format="json"))
    assert read_files(spark, tmp_root + "-none", "json", SourceOptions(schema="id long")).count() == 0


# ---------------------------------------------------------------- loads
def test_ledger_and_late_null_keys(spark, tmp_root):
    data = [(k, "a") for k in range(25)] + [(None, "n"), (None, "n")]

    def frame(more=()):
        return spark.createDataFrame([*data, *more], "k long, x string")
    s = VersionedStore(spark, tmp_root)
    assert resumable_load(spark, s, frame(), "k", 10, max_pages=1) == 1
    ledger = load_ledger(s)
    assert rows(ledger, "page", "after", "until", "n_rows", "state") == [(1, None, "9", 10, "loaded"), (2, "9", "19", 10, "planned"), (3, "19", "24", 5, "planned")]
    assert resumable_load(spark, s, frame(), "k", 10) == 3 and rows(s.read()) == rows(frame())
    assert resumable_load(spark, s, frame(), "k", 10) == 0
    late = [(None, "late"), (None, "n"), (30, "b")]
    assert resumable_load(spark, s, frame(late), "k", 10) == 2 and rows(s.read()) == rows(frame(late))
    assert rows(load_ledger(s).where("page = 0"), "n_rows", "state") == [(4, "loaded")]
    assert load_ledger(s).agg(F.sum("n_rows")).first()[0] == 30


def test_append_takes_rows_that_share_the_last_key(spark, tmp_root):
    s = VersionedStore(spark, tmp_root)

    def run(*data):
        return append_job(s, spark.createDataFrame(list(data), "k long, x string"), "k")
    first = [(1, "a"), (2, "b"), (2, "b"), (None, "n")]
    assert run(*first) == 4 and run(*first) == 0
    assert run(*first, (2, "b"), (2, "c"), (None, "n"), (None, "m"), (3, "d")) == 5
    assert rows(s.read()) == sorted([*first, (2, "b"), (2, "c"), (None, "n"), (None, "m"), (3, "d")], key=repr)
