"""Pure DataFrame operators (no I/O)."""

from tidemark.operators.latest import keep_latest, keep_max_ties
from tidemark.operators.merge import (
    append_incremental, cdc_merge, init_snapshot, merge_three_clause, merge_upsert,
    purge_tombstones, align_to_schema,
)
from tidemark.operators.aggregates import key_bounds, shape, table_profile, watermark
from tidemark.operators.buckets import bucket_id, floor_div

__all__ = [
    "keep_latest", "keep_max_ties", "append_incremental", "cdc_merge", "init_snapshot",
    "merge_three_clause", "merge_upsert", "purge_tombstones", "align_to_schema",
    "key_bounds", "shape", "table_profile", "watermark", "bucket_id", "floor_div",
]
