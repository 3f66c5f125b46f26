"""Copy jobs with load modes (M13, M14, S15, K5, M8, M5) and the resumable bulk load.

A copy job moves one source (a DataFrame, a database query or files) into a target
(a versioned Parquet store, a folder of files, or a database table) under a load mode.
Arguments are validated before anything is read (D11); a combination that a target cannot
keep exactly is an error, never a wider load.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.cleaning import apply_casing, round_fractional
from tidemark.operators._util import as_list, typed_lit
from tidemark.operators.buckets import bucket_id
from tidemark.operators.changes import effective
from tidemark.operators.control import literal, max_text
from tidemark.operators.merge import align_to_schema, merge_upsert, widened_schema
from tidemark.operators.ranges import assign_pages, page_plan
from tidemark.plans.increment import Increment
from tidemark.plans.reconcile import differing_parts
from tidemark.session import work_path
from tidemark.sinks.parquet import rows_for_bytes, write_files
from tidemark.sinks.store import VersionedStore
from tidemark.sources.files import apply_source_options, read_files
from tidemark.sources.jdbc import read_query, write_table
from tidemark.specs import Compression, FileFormat, LoadMode, SourceOptions, TargetOptions

MAX_BROADCAST_KEYS = 1_000_000
RELOADS = (LoadMode.FULL_REFRESH, LoadMode.TRUNCATE)
KEYED = (LoadMode.INCREMENTAL, LoadMode.BACKFILL)


@dataclass
class CopyJob:
    target_object: str | None = None
    source: DataFrame | None = None                # S15: a ready DataFrame
    src_conn: str | None = None                    # jdbc url, or a file format name
    src_stream: str | None = None                  # query / table / path
    tgt_conn: str | None = None                    # jdbc url -> database table, file format -> files
    mode: LoadMode = LoadMode.FULL_REFRESH
    primary_key: list[str] | None = None
    update_key: str | None = None
    backfill_range: tuple | None = None            # [start, end) of update_key
    loaded_at: dt.datetime | None = None           # snapshot mode stamp
    bucket_width: int | None = None                # key-range buckets of the target store
    part_col: str = "part_id"
    source_options: SourceOptions = field(default_factory=SourceOptions)
    target_options: TargetOptions = field(default_factory=TargetOptions)

    @property
    def _database(self) -> bool:
        return bool(self.tgt_conn) and self.tgt_conn.startswith("jdbc:")

    def validate(self) -> None:
        mode, o, src = LoadMode(self.mode), self.target_options, self.source_options
        if not self.target_object:
            raise ValueError("no destination: set target_object to a table name or a folder")
        if self.source is None and not self.src_conn:
            raise ValueError("nothing to read from: set source, or src_conn to a JDBC address or file format")
        if self.source is None and not self.src_stream:
            raise ValueError("src_stream is empty: name the table, query or path that src_conn should read")
        if mode in KEYED and not (self.primary_key and self.update_key):
            raise ValueError(f"mode {mode.value} merges rows: set primary_key and update_key")
        if mode == LoadMode.BACKFILL and not self.backfill_range:
            raise ValueError("mode backfill loads a range: set backfill_range=(start, end)")
        if self.tgt_conn and mode in KEYED:
            raise ValueError(f"mode {mode.value} merges by key, which only a store can do: leave tgt_conn unset")
        if o.delete_missing and (src.limit is not None or src.offset):
            raise ValueError("delete_missing with limit or offset would delete all rows outside the slice")
        if o.delete_missing and mode not in KEYED:
            raise ValueError("delete_missing belongs to modes that merge: incremental and backfill")
        if self.bucket_width and not self.primary_key:
            raise ValueError("bucket_width needs primary_key: buckets are ranges of its first column")
        if o.compression:
            Compression(o.compression)
        if not self.tgt_conn and FileFormat(o.format) != FileFormat.PARQUET:
            raise ValueError("a store holds Parquet: for other formats set tgt_conn to the format")

    def read_source(self, spark: SparkSession) -> DataFrame:
        o = self.target_options
        if self.source is not None:
            df = apply_source_options(self.source, self.source_options)
        elif self.src_conn.startswith("jdbc:"):
            df = apply_source_options(read_query(spark, self.src_conn, self.src_stream),
                                      self.source_options)
        else:
            df = read_files(spark, self.src_stream, self.src_conn, self.source_options)
        df = apply_casing(df, o.column_casing)
        if o.max_decimals is not None:
            df = round_fractional(df, o.max_decimals)
        return df

    def sized(self, spark: SparkSession, df: DataFrame) -> TargetOptions:
        """The target's options with ``file_max_bytes`` as rows per file, measured on a written sample."""
        o = self.target_options
        if not o.file_max_bytes or self._database:
            return o
        o = replace(o, format=FileFormat(self.tgt_conn).value if self.tgt_conn else o.format)
        rows = rows_for_bytes(df, work_path(spark, "file-sample"), o.file_max_bytes, o)
        return replace(o, file_max_rows=min(rows, o.file_max_rows or rows))

    def stamped(self, df: DataFrame) -> DataFrame:
        """Rows of a snapshot load carry the time of the load."""
        if LoadMode(self.mode) != LoadMode.SNAPSHOT:
            return df
        return df.withColumn("loaded_at", typed_lit(self.loaded_at or dt.datetime.now(), "timestamp_ntz"))

    def run(self, spark: SparkSession) -> dict | None:
        self.validate()
        df = self.read_source(spark)
        o, reload = self.sized(spark, df), LoadMode(self.mode) in RELOADS
        if not self.tgt_conn:
            return load_into_store(VersionedStore(spark, self.target_object), df, replace(self, target_options=o))
        mode = "ignore" if o.ignore_existing else "overwrite" if reload else "append"
        if not self._database:
            o = replace(o, format=FileFormat(self.tgt_conn).value)
            write_files(self.stamped(df), self.target_object, o, mode=mode)
            return None
        write_table(self.stamped(df), self.tgt_conn, self.target_object, mode=mode,
                    batchsize=o.batch_limit or 10_000, num_partitions=o.concurrency,
                    column_types=o.table_ddl,
                    properties={"truncate": "true"} if LoadMode(self.mode) == LoadMode.TRUNCATE else {})
        return None


def load_into_store(store: VersionedStore, df: DataFrame, job: CopyJob) -> dict:
    """Apply one load mode to a versioned Parquet target and keep one generation as backup."""
    if job.target_options.ignore_existing and store.exists():
        return store.manifest()
    with store.pinned():
        m = _load(store, df, job)
        store.retain(2)
        return m


def _writer(o: TargetOptions) -> dict:
    out = {"parquet.block.row.count.limit": str(o.row_group_rows), **o.extra}
    if o.file_max_rows:
        out["maxRecordsPerFile"] = str(o.file_max_rows)
    if o.compression and o.compression != Compression.AUTO:
        out["compression"] = o.compression
    return out


def _load(store: VersionedStore, df: DataFrame, job: CopyJob) -> dict:
    o, mode, there = job.target_options, LoadMode(job.mode), store.exists()
    keys = as_list(job.primary_key)
    part = job.part_col if job.bucket_width else None
    if part:
        df = df.withColumn(part, bucket_id(keys[0], job.bucket_width))
    how = {"options": _writer(o), **({"key": keys} if part else {})}
    if mode in RELOADS or (mode == LoadMode.SNAPSHOT and not there):
        if mode == LoadMode.TRUNCATE and there:
            df = align_to_schema(df, store.schema())
        return store.replace(job.stamped(df), part_col=part, fresh=True, **how)
    if mode == LoadMode.SNAPSHOT:
        new = job.stamped(df)
        if o.adjust_column_type:
            old = store.read()
            schema = widened_schema(old, new)
            if schema != old.schema:        # files of other types cannot be read together: rewrite once
                new = align_to_schema(old, schema).unionByName(
                    align_to_schema(new, schema, add_new_columns=o.add_new_columns), allowMissingColumns=o.add_new_columns)
                return store.replace(new, part_col=store.manifest()["part_col"], **how)
        return store.append(new, add_new_columns=o.add_new_columns, **how)
    if mode == LoadMode.INCREMENTAL:
        return _incremental(store, df, job, keys, part, how)
    return _backfill(store, df, job, keys, part, how)


def _upsert(store: VersionedStore, df: DataFrame, rows: DataFrame, job: CopyJob, keys: list[str], part: str | None, how: dict,
            state: Callable[[Increment], dict], checkpoint: str | None = None) -> dict:
    """Merge the newest of ``rows`` per key into the store; publish no data if nothing changes.

    A row takes effect if its key is new, its version newer than the table's, or the same with
    other content. A bucketed store has the parts of such rows rewritten, others the whole table.
    """
    o = job.target_options
    read = Increment.read(store, rows, keys, job.update_key, checkpoint)
    staged, after = read.rows, state(read)
    if not store.exists():
        m = store.replace(staged, part_col=part, fresh=True, state=after, **how)
        store.drop_staging()
        return m
    base = store.manifest()
    pc = base["part_col"]
    touched = _parts(staged, pc) if pc else None
    target = store.read(parts=touched)
    wide = target.unionByName(staged.limit(0), allowMissingColumns=True) if o.add_new_columns else target
    if o.adjust_column_type:
        wide = align_to_schema(wide, widened_schema(wide, staged))
    changed = wide.schema != target.schema
    if changed and touched is not None:      # types of other parts change with it
        touched, target = None, store.read()
        wide = align_to_schema(target, wide.schema, allow_missing=True)
    new = align_to_schema(staged, wide.schema, allow_missing=o.add_new_columns)
    new = store.stage(effective(new, wide, keys, job.update_key, MAX_BROADCAST_KEYS), "effective")
    if not changed:
        hit = _parts(new, pc) if touched is not None else None
        if hit is not None and o.delete_missing:     # parts whose keys are not those of the source have rows to lose
            wanted = df.select(*keys, pc).distinct()
            hit = sorted({*hit, *differing_parts(wanted, store.read().select(*keys, pc), pc)}, key=repr)
        if not hit and (hit is not None or (not o.delete_missing and new.isEmpty())):
            # nothing to do again: a backfill's mark is only moved on or removed, not begun
            now = base.get("state") or {}
            after = {k: v for k, v in after.items() if k in now or not k.startswith("backfill")}
            store.drop_staging()
            return store.set_state(after) if any(now.get(k) != v for k, v in after.items()) else base
        if hit is not None:
            touched, wide = hit, store.read(parts=hit)
    merged = merge_upsert(wide, new, keys, [job.update_key], max_broadcast_rows=MAX_BROADCAST_KEYS, source_reduced=True)
    if o.delete_missing:
        merged = merged.join(df.select(*keys).distinct(), on=keys, how="left_semi")
    if touched is not None:
        m = store.replace_parts(merged, touched, state=after, tasks=store.write_tasks(touched), **how)
    else:
        m = store.replace(merged, part_col=pc, state=after, **how)
    store.drop_staging()
    return m


def _parts(df: DataFrame, part_col: str) -> list:
    return [r[0] for r in df.select(part_col).distinct().collect()]


def _incremental(store, df, job, keys, part, how) -> dict:
    """Rows above the watermark, and at it: later rows may share its value (as in ``VersionUpsert``).

    A watermark taken from a table that has none recorded is read with ``>`` unless it is a time: the
    row that carries the number is in the table.
    """
    dtype, c = df.schema[job.update_key].dataType, F.col(job.update_key)
    before = store.state() if store.exists() else {}
    last = before.get("incremental_watermark")
    if last is None and store.exists():      # no recorded watermark: the target's max (A1)
        last = max_text(store.read(), job.update_key)
    again = "incremental_watermark" in before or isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType))
    newer = df if last is None else df.where(c >= literal(last, dtype) if again else c > literal(last, dtype))

    def state(read):
        return {"incremental_watermark": read.newest if read.newest is not None else last,
                **read.rejected(before, newer, keys, job.update_key, last)}

    return _upsert(store, df, newer, job, keys, part, how, state, last)


def _backfill(store, df, job, keys, part, how) -> dict:
    """``[start, end)`` of the update column, in windows of ``chunk_size`` if given.

    Each window is published with its number, under the range, the window width and the column; a
    rerun resumes after the last one. Of a finished range the state keeps only how many rows without
    a key it held (``backfill_rejected``). A row repairs the table's if its version is as new or newer.
    """
    lo, hi = job.backfill_range
    step = job.source_options.chunk_size
    dtype, c = df.schema[job.update_key].dataType, F.col(job.update_key)
    name = f"backfill {job.update_key} {lo!s} {hi!s} {step!s}"
    i = (store.state().get(name) or 0) if store.exists() else 0
    m = store.manifest()
    start = lo if step is None else lo + i * step
    while start < hi:
        end = hi if step is None else min(hi, start + step)
        i += 1
        done = None if end >= hi else i
        window = df.where((c >= literal(start, dtype)) & (c < literal(end, dtype)))

        def state(read, i=i, done=done):
            n = read.above + (((store.state() if store.exists() else {}).get("backfill_rejected") or 0) if i > 1 else 0)
            return {name: done, "backfill_rejected": n or None}

        m = _upsert(store, df, window, job, keys, part, how, state)
        start = end
    return m


def append_job(store: VersionedStore, source: DataFrame, order_col: str, *, state_key: str = "append_last") -> int:
    """Append-only increment as a job (M8): rows above the last key of the target become new files.

    Rows may come later that share the last key, or have none: of these (and only these) the rows
    that the target does not hold yet are appended, equal rows as often as they are missing.
    Returns the number of rows appended; nothing is published when there are none.
    """
    with store.pinned():
        c, dtype = F.col(order_col), source.schema[order_col].dataType
        last = store.state().get(state_key) if store.exists() else None
        if last is None and store.exists():
            last = max_text(store.read(), order_col)
        newer = source
        if store.exists():
            held = store.read()
            shared = c.isNull() if last is None else c.isNull() | (c == literal(last, dtype))
            ties = align_to_schema(source.where(shared), held.schema).exceptAll(held.where(shared))
            above = source.where(c.isNotNull() if last is None else c > literal(last, dtype))
            newer = align_to_schema(above, held.schema).unionByName(ties)
        staged = store.stage(newer, "append")
        n = staged.count()
        if n:
            end = max_text(staged, order_col)
            store.append(staged, state={state_key: end if end is not None else last})
        store.drop_staging()
        return n


def merge_job(store: VersionedStore, source: DataFrame, key, order_col: str, *, bucket_width: int | None = None) -> dict:
    """Read what is newer than the last key of the target and merge it (M5): an incremental copy job."""
    return CopyJob(target_object=store.root, source=source, mode=LoadMode.INCREMENTAL, primary_key=as_list(key),
                   update_key=order_col, bucket_width=bucket_width).run(store.spark)


def resumable_load(spark: SparkSession, store: VersionedStore, source: DataFrame, order_col: str,
                   page_rows: int, max_pages: int | None = None, pages_per_job: int = 8) -> int:
    """Bulk load in key-range pages, resumable across runs (M11); returns the pages loaded.

    The pages (about ``page_rows`` rows each, closed on ties) are planned once into a ledger, a
    small table beside the store with each page's range ``(after, until]`` and rows.
    ``pages_per_job`` neighbouring pages are one Spark job and one version, written together
    with the last key; a restart continues there. What is loaded stays invisible (K9) until the
    source holds no key above the last one: used-up ledgers are followed by new ones, then by one
    page of the rows without a key, and all is published at once. A later run loads what has
    come since; of the rows without a key, those that the store does not hold, if there are more
    than it has loaded.
    """
    dtype, c = source.schema[order_col].dataType, F.col(order_col)
    pages = 0
    while max_pages is None or pages < max_pages:
        state = store.state() if store.exists() else {}
        last, number, done = state.get("last_key"), state.get("ledger"), state.get("pages_done", 0)
        n = pages_per_job if max_pages is None else min(pages_per_job, max_pages - pages)
        ahead = _planned(spark, store, number, done, n) if number else []
        if not ahead:
            number, done = (number or 0) + 1, 0
            if not _write_ledger(store, source, order_col, page_rows, last, number):
                break
            ahead = _planned(spark, store, number, done, n)
        until = ahead[-1]
        cond = c <= literal(until, dtype)
        if last is not None:
            cond = cond & (c > literal(last, dtype))
        store.append_pending(source.where(cond), state={"last_key": until, "ledger": number, "pages_done": done + len(ahead)})
        pages += len(ahead)
    else:
        return pages
    # no key above the last one
    state = store.state() if store.exists() else {}
    none = source.where(c.isNull())
    before, now = state.get("null_rows", 0), none.count()
    if now > before:
        if before:
            held = store.read(pending=True)
            none = align_to_schema(none, held.schema).exceptAll(held.where(c.isNull()))
        store.append_pending(none, state={"null_rows": now})
        pages += 1
    if store.exists() and store.manifest().get("pending"):
        store.publish_pending()
    return pages


def _ledger_path(store: VersionedStore, number: int) -> str:
    return f"{store.root}/_load/ledger-{number:06d}"


def _write_ledger(store: VersionedStore, source: DataFrame, order_col: str, page_rows: int, last: str | None, number: int) -> int:
    """Plan the pages above ``last`` as ledger ``number``: page, after, until, n_rows. Returns how many there are."""
    dtype, c = source.schema[order_col].dataType, F.col(order_col)
    ends = page_plan(source, order_col, page_rows, last)
    if not ends:
        return 0
    rest = source.where(c.isNotNull() if last is None else c > literal(last, dtype)).select(order_col)
    counts = assign_pages(rest, order_col, ends).groupBy(F.col("page_id").alias("page")).agg(F.count("*").alias("n_rows"))
    plan = source.sparkSession.createDataFrame(
        [(i, a, b) for i, (a, b) in enumerate(zip([last, *ends], ends), 1)], "page long, after string, until string")
    # rows that came after the plan was made lie in the last page or in a later ledger
    store.fs.delete(_ledger_path(store, number))
    plan.join(counts, "page", "left").select("page", "after", "until", F.coalesce("n_rows", F.lit(0)).alias("n_rows")).coalesce(1).write.parquet(
        _ledger_path(store, number))
    return len(ends)


LEDGER = "page long, after string, until string, n_rows long"


def _planned(spark: SparkSession, store: VersionedStore, number: int, done: int, n: int) -> list[str]:
    """The ends of the next ``n`` pages of a ledger."""
    rows = spark.read.schema(LEDGER).parquet(_ledger_path(store, number)).where(F.col("page").between(done + 1, done + n))
    return [r["until"] for r in sorted(rows.select("page", "until").collect())]


def load_ledger(store: VersionedStore) -> DataFrame:
    """All pages of a load: ledger, page, after, until, n_rows, state (loaded or planned); the page without a key is page 0."""
    spark, state = store.spark, store.state() if store.exists() else {}
    now, done = state.get("ledger", 0), state.get("pages_done", 0)
    none = spark.createDataFrame([(0, 0, None, None, state["null_rows"], "loaded")] if state.get("null_rows") else [],
                                 f"ledger int, {LEDGER}, state string")
    if not now:
        return none
    rows = spark.read.schema(LEDGER).parquet(*[_ledger_path(store, i) for i in range(1, now + 1)])
    number = F.regexp_extract(F.input_file_name(), "ledger-([0-9]+)/", 1).cast("int")
    loaded = (F.col("ledger") < now) | (F.col("page") <= done)
    return none.unionByName(rows.withColumn("ledger", number).withColumn("state", F.when(loaded, "loaded").otherwise("planned")))
