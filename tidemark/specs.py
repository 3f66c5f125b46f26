"""Job specifications: table specs, load modes and the declared source/target options
(SURVEY 2.12). Meanings of the declared options are ours (the reference only names them)."""

from __future__ import annotations

from dataclasses import dataclass, field
from enum import Enum


@dataclass
class TableSpec:
    """A main table kept in step from its history table."""
    name: str
    key: list[str]
    columns: list[str] | None = None      # empty = all columns
    hist_id: str = "hist_id"              # history id / load watermark column
    op: str = "op"                        # 1 = insert/update, 0 = delete
    bucket_width: int | None = None       # key-range buckets; None = one unpartitioned table
    part_col: str = "part_id"
    overlap: int = 0                      # re-read history ids in (wm - overlap, wm]: catches
                                          # changes committed out of id order; merges then
                                          # compare versions so re-read rows never win
    max_gaps: int = 0                     # > 0: ids not seen below the watermark are kept as at most so
                                          # many stretches and read when they appear
    gap_horizon: int | None = None        # ids that far below the newest are given up
    lateness: int | None = None           # streams: changes that far below the newest id are ignored,
                                          # and deletes older than that are dropped

    def __post_init__(self):
        if isinstance(self.key, str):
            self.key = [self.key]


class LoadMode(str, Enum):
    """Load modes (names declared by the reference; meanings in SURVEY 7.5)."""
    FULL_REFRESH = "full-refresh"   # new version from the source only, schema may change
    INCREMENTAL = "incremental"     # upsert rows newer than the target's watermark
    TRUNCATE = "truncate"           # like full refresh, existing schema enforced
    SNAPSHOT = "snapshot"           # append source rows stamped with loaded_at
    BACKFILL = "backfill"           # upsert a [start, end) range of the update column


class FileFormat(str, Enum):
    CSV = "csv"
    JSON = "json"
    JSONLINES = "jsonlines"
    XML = "xml"
    PARQUET = "parquet"
    ORC = "orc"
    TEXT = "text"
    AVRO = "avro"       # needs the external spark-avro module on the classpath


class Compression(str, Enum):
    AUTO = "auto"
    NONE = "none"
    GZIP = "gzip"
    SNAPPY = "snappy"
    ZSTD = "zstd"


@dataclass
class SourceOptions:
    trim_space: bool = False
    empty_as_null: bool = False
    null_if: str | None = None
    header: bool = True
    delimiter: str = ","
    datetime_format: str | None = None
    skip_blank_lines: bool = True              # text files; csv and json readers always skip them
    flatten: bool = False
    jmespath: dict[str, tuple[str, str]] | None = None   # new column -> (json column, JSONPath)
    compression: str | None = None
    format: str | None = None
    max_decimals: int | None = None
    limit: int | None = None
    offset: int | None = None
    order_by: list[str] | None = None
    columns: dict[str, str] | None = None      # column -> type (cast map)
    transforms: list[str] | None = None        # SQL expressions appended as columns/selects
    chunk_size: int | None = None              # backfill window width
    schema: str | None = None                  # DDL schema for file sources


@dataclass
class TargetOptions:
    header: bool = True
    delimiter: str = ","
    datetime_format: str | None = None
    compression: str = "zstd"
    format: str = "parquet"
    file_max_rows: int | None = None
    file_max_bytes: int | None = None
    concurrency: int | None = None
    batch_limit: int | None = None
    ignore_existing: bool = False
    delete_missing: bool = False
    column_casing: str | None = None
    add_new_columns: bool = False
    adjust_column_type: bool = False
    max_decimals: int | None = None
    table_ddl: str | None = None
    row_group_rows: int = 100_000
    extra: dict = field(default_factory=dict)
