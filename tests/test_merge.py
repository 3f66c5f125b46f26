"""Merge semantics on tiny hand-made frames (FIXTURES edge cases, SURVEY 2.13)."""

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import rows
from tidemark.operators.latest import keep_latest, keep_max_ties
from tidemark.operators.merge import (
    align_to_schema, cdc_merge, init_snapshot, merge_three_clause, merge_upsert, purge_tombstones,
    merge_keep_tombstones, append_incremental,
)
from pyspark.sql import functions as F

SNAP = "id long, bal double, hist_id long, op int"


def snap(spark, data):
    return spark.createDataFrame(data, SNAP)


def test_empty_history_keeps_snapshot(spark):
    s = snap(spark, [(1, 1.0, 10, 1), (2, 2.0, 10, 1)])
    out = cdc_merge(s, spark.createDataFrame([], SNAP), "id", watermark=10)
    assert rows(out) == rows(s)


def test_delete_only_batch_is_applied(spark):
    # The reference returned True without applying a delete-only batch.
    s = snap(spark, [(1, 1.0, 10, 1), (2, 2.0, 10, 1)])
    ch = snap(spark, [(1, 0.0, 11, 0)])
    assert rows(cdc_merge(s, ch, "id", watermark=10), "id") == [(2,)]


def test_several_changes_newest_wins_and_newest_delete_deletes(spark):
    s = snap(spark, [(1, 1.0, 10, 1), (2, 2.0, 10, 1), (3, 3.0, 10, 1)])
    ch = snap(spark, [(1, 5.0, 11, 1), (1, 6.0, 14, 1), (2, 7.0, 12, 1), (2, 0.0, 13, 0),
                      (4, 9.0, 15, 1)])
    out = cdc_merge(s, ch, "id", watermark=10)
    assert rows(out, "id", "bal", "hist_id") == [(1, 6.0, 14), (3, 3.0, 10), (4, 9.0, 15)]


def test_deleted_then_reinserted(spark):
    s = snap(spark, [(1, 1.0, 10, 1)])
    ch = snap(spark, [(1, 0.0, 11, 0), (1, 8.0, 12, 1)])
    assert rows(cdc_merge(s, ch, "id", watermark=10), "id", "bal") == [(1, 8.0)]


def test_changes_at_or_below_watermark_are_ignored(spark):
    s = snap(spark, [(1, 1.0, 10, 1)])
    ch = snap(spark, [(1, 0.0, 10, 0), (2, 2.0, 9, 1)])
    assert rows(cdc_merge(s, ch, "id", watermark=10)) == rows(s)


def test_null_watermark_applies_everything(spark):
    # A null watermark means "from the beginning", not "never".
    s = snap(spark, [])
    ch = snap(spark, [(1, 1.0, 3, 1)])
    assert rows(cdc_merge(s, ch, "id", watermark=None), "id") == [(1,)]


def test_auto_watermark_from_snapshot(spark):
    s = snap(spark, [(1, 1.0, 10, 1)])
    ch = snap(spark, [(1, 2.0, 9, 1), (2, 3.0, 11, 1)])
    assert rows(cdc_merge(s, ch, "id"), "id", "bal") == [(1, 1.0), (2, 3.0)]


def test_null_and_negative_keys(spark):
    s = snap(spark, [(None, 1.0, 10, 1), (-5, 2.0, 10, 1), (None, 3.0, 10, 1)])
    ch = snap(spark, [(-5, 7.0, 11, 1)])
    out = cdc_merge(s, ch, "id", watermark=10)
    # null snapshot keys never match a change and survive (twice)
    assert rows(out, "id", "bal") == sorted([(None, 1.0), (None, 3.0), (-5, 7.0)], key=repr)


def test_change_schema_wider_than_snapshot(spark):
    s = snap(spark, [(1, 1.0, 10, 1)])
    wide = spark.createDataFrame([(2, 2.0, 11, 1, "x")], SNAP + ", extra string")
    out = cdc_merge(s, wide, "id", watermark=10)
    assert out.columns == ["id", "bal", "hist_id", "op"]
    both = cdc_merge(s, wide, "id", watermark=10, add_new_columns=True)
    assert set(both.columns) == {"id", "bal", "hist_id", "op", "extra"}
    assert rows(both, "id", "extra") == sorted([(1, None), (2, "x")], key=repr)


def test_missing_column_is_an_error(spark):
    s = snap(spark, [(1, 1.0, 10, 1)])
    narrow = spark.createDataFrame([(2, 11, 1)], "id long, hist_id long, op int")
    try:
        align_to_schema(narrow, s.schema)
        assert False, "expected an error"
    except ValueError as e:
        assert "bal" in str(e)


def test_redelivery_is_idempotent(spark):
    s = snap(spark, [(1, 1.0, 10, 1), (2, 2.0, 10, 1)])
    ch = snap(spark, [(1, 0.0, 11, 0), (3, 3.0, 12, 1)])
    once = cdc_merge(s, ch, "id", watermark=10)
    twice = cdc_merge(once, ch, "id", watermark=None)
    assert rows(once) == rows(twice)


def test_merge_upsert_reduces_duplicate_source_keys(spark):
    # The max-over-key filter keeps ties; we reduce to one row per key first.
    t = spark.createDataFrame([(1, "a", 1)], "k long, v string, ver long")
    src = spark.createDataFrame([(1, "b", 5), (1, "c", 7), (2, "d", 3)], "k long, v string, ver long")
    assert rows(merge_upsert(t, src, "k", ["ver"])) == [(1, "c", 7), (2, "d", 3)]


def test_keep_max_ties_keeps_ties_and_null_keys(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (1, 3), (None, 2), (None, 1)], "k long, v long")
    assert rows(keep_max_ties(df, "k", "v")) == sorted([(1, 5), (1, 5), (None, 2)], key=repr)


def test_keep_latest_tie_breaker(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 5, 2), (2, 1, 1)], "k long, v long, t long")
    assert rows(keep_latest(df, "k", ["v", "t"])) == [(1, 5, 2), (2, 1, 1)]


def test_three_clause_merge_touched_parts_and_emptied_part(spark):
    t = spark.createDataFrame([(1, 1.0, 10, 1, 0), (2, 2.0, 10, 1, 0), (150, 3.0, 10, 1, 1)],
                              SNAP + ", part_id long")
    src = spark.createDataFrame([(1, 0.0, 11, 0, 0), (2, 0.0, 12, 0, 0), (230, 5.0, 13, 1, 2)],
                                SNAP + ", part_id long")
    out = merge_three_clause(t, src, "id", order=["hist_id"])
    assert rows(out, "id", "part_id") == [(150, 1), (230, 2)]


def test_purge_after_tombstone_merge(spark):
    s = snap(spark, [(1, 1.0, 10, 1), (2, 2.0, 10, 1)])
    ch = snap(spark, [(1, 0.0, 11, 0)])
    kept = merge_keep_tombstones(s, ch, "id", watermark=10)
    assert rows(kept, "id", "op") == [(1, 0), (2, 1)]
    assert rows(purge_tombstones(kept), "id") == [(2,)]


def test_init_snapshot_and_append(spark):
    m = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    s = init_snapshot(m, 42, columns=["id"])
    assert rows(s) == [(1, 42, 1), (2, 42, 1)]
    t = spark.createDataFrame([(1,), (2,)], "id long")
    src = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id long")
    assert rows(append_incremental(t, src, "id")) == [(1,), (2,), (3,), (4,)]


# -------------------------------------------------------------- properties
changes = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 1)), min_size=0, max_size=25)


@settings(max_examples=15, deadline=None)
@given(changes, st.integers(0, 25))
def test_replay_in_two_batches_equals_once(spark, log, cut):
    s = snap(spark, [(k, float(k), 0, 1) for k in range(4)])
    ch_rows = [(k, float(i), i + 1, op) for i, (k, op) in enumerate(log)]
    ch = snap(spark, ch_rows)
    once = cdc_merge(s, ch, "id", watermark=0)
    cut = min(cut, len(ch_rows))
    first = snap(spark, ch_rows[:cut])
    mid = cdc_merge(s, first, "id", watermark=0)
    recorded = cut  # max hist id of the first batch (ids are 1..n)
    two = cdc_merge(mid, ch, "id", watermark=recorded)
    assert rows(once) == rows(two)


@settings(max_examples=10, deadline=None)
@given(changes)
def test_merging_same_batch_twice_changes_nothing(spark, log):
    s = snap(spark, [(k, float(k), 0, 1) for k in range(4)])
    ch = snap(spark, [(k, float(i), i + 1, op) for i, (k, op) in enumerate(log)])
    once = cdc_merge(s, ch, "id", watermark=0)
    assert rows(cdc_merge(once, ch, "id", watermark=None)) == rows(once)
