"""History-table change data capture into a versioned Parquet snapshot.

``run`` loads the initial snapshot when the store is empty (or ``force_init``),
otherwise applies the history rows after the stored watermark. The watermark lives
in the manifest and is the maximum history id of the *applied batch*, deletes
included (D3); a null watermark means "from the beginning" (D4). Batches that hold
only deletes are applied (D2). With ``bucket_width`` the snapshot is partitioned by
key range and only touched parts are rewritten (M6).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, as_completed

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.aggregates import watermark_value
from tidemark.operators.buckets import bucket_id
from tidemark.operators.gaps import still_open, within
from tidemark.operators.joins import join_small
from tidemark.operators.latest import keep_latest
from tidemark.operators.merge import (
    align_to_schema, cdc_merge, changes_after, drop_stale, init_snapshot, purge_tombstones, without_keys,
)
from tidemark.operators.observed import metrics
from tidemark.sinks.store import VersionedStore
from tidemark.specs import TableSpec

Source = DataFrame | Callable[[], DataFrame]


def _load(src: Source) -> DataFrame:
    return src() if callable(src) else src


class SnapshotSync:
    def __init__(self, spark: SparkSession, store: VersionedStore | str, spec: TableSpec,
                 main: Source, history: Source, *, max_broadcast_keys: int = 10_000_000):
        self.spark = spark
        self.store = store if isinstance(store, VersionedStore) else VersionedStore(spark, store)
        self.spec = spec
        self.main = main
        self.history = history
        # The staged change set's key count is checked before it is broadcast to the
        # anti join; above this bound the snapshot is joined by sort-merge.
        self.max_broadcast_keys = max_broadcast_keys

    def _with_bucket(self, df: DataFrame) -> DataFrame:
        s = self.spec
        return df.withColumn(s.part_col, bucket_id(s.key[0], s.bucket_width)) if s.bucket_width else df

    # M3
    def run(self, force_init: bool = False) -> str:
        if force_init or not self.store.exists():
            return "init" if self.init() else "empty"
        return "sync" if self.sync() else "no-changes"

    # M2
    def init(self) -> bool:
        s = self.spec
        # Watermark first, then the main table: changes made during the load are
        # replayed by the next sync (idempotent), never lost.
        wm = watermark_value(_load(self.history), s.hist_id)
        snap = self._with_bucket(init_snapshot(_load(self.main), wm, columns=s.columns,
                                               hist_id=s.hist_id, op=s.op))
        if snap.isEmpty():
            return False
        # all that was visible when the watermark was read is in the snapshot: a floor for streams
        state = {"watermark": wm, "floor": wm, "table": s.name}
        if s.max_gaps and wm is not None:
            seen = _load(self.history).where(F.col(s.hist_id) <= wm)
            if s.gap_horizon is not None:
                seen = seen.where(F.col(s.hist_id) > wm - s.gap_horizon)
            state["gaps"] = still_open(seen, s.hist_id, [], None, s.gap_horizon, s.max_gaps)
        self.store.replace(snap, part_col=s.part_col if s.bucket_width else None, key=s.key, fresh=True, state=state)
        self.store.retain(2)
        return True

    def read(self) -> DataFrame:
        """The snapshot without the deletes that a streamed store keeps (``op = 0``)."""
        return purge_tombstones(self.store.read(), self.spec.op)

    def current_watermark(self):
        state = self.store.state()
        if "watermark" in state:
            return state["watermark"]
        # Fallback for stores written without state: max over the data.
        return watermark_value(self.store.read(), self.spec.hist_id)

    @staticmethod
    def _staged_path(staged: DataFrame) -> str:
        return _input_path(staged) or "/nonexistent"

    # M1
    def sync(self, changes: DataFrame | None = None, batch_id: int | None = None, stream: str = "default") -> bool:
        """Apply the history after the watermark, or a micro-batch ``changes`` of ``stream``.

        With ``max_gaps``, ids that were missing below the watermark are read when they appear;
        of the keys they change, the newest row in the history decides.

        A micro-batch is new by its stream's offsets, whatever its history ids. Batches may come
        in any order, so each key's versions are compared and deletes stay in the store as rows
        with ``op = 0``: an older change cannot bring a deleted key back. Read such a store
        through ``read``. Changes up to the floor are left out and counted (``late_changes``):
        it begins at the snapshot's watermark, which holds them all, and with ``lateness`` follows
        the slowest stream that has come so far; deletes up to it are dropped from the parts that
        are rewritten, and from all by ``purge``.

        Changes without a key are left out and counted in the state (``rejected_null_keys``).
        """
        with self.store.pinned():
            done = self._sync_batch(changes, batch_id, stream) if changes is not None else self._sync_history()
            if done:
                self.store.retain(2)      # the live table and one generation before it
            return done

    def _staged_changes(self, changes: DataFrame, current: DataFrame) -> tuple[DataFrame, int]:
        """One staged row per key, and the number of changes without a key."""
        s = self.spec
        data_schema = T.StructType([f for f in current.schema.fields if f.name != s.part_col])
        no_key = F.lit(False)
        for k in s.key:
            no_key = no_key | F.col(k).isNull()
        seen = Observation()
        ch = align_to_schema(changes, data_schema).observe(seen, F.count(F.when(no_key, 1)).alias("n")).where(~no_key)
        staged = self.store.stage(keep_latest(ch, s.key, [s.hist_id]), "changes")
        return self._with_bucket(staged), metrics(seen, n=0)["n"]

    def _touched(self, staged: DataFrame) -> tuple[list | None, int | None, int]:
        """Touched parts, the newest history id and the number of staged rows, from one small aggregate."""
        s = self.spec
        keys = [s.part_col] if s.bucket_width else []
        per_part = staged.groupBy(*keys).agg(F.max(s.hist_id).alias("mx"), F.count("*").alias("n")).collect()
        parts = [r[s.part_col] for r in per_part] if keys else None
        return parts, max((r["mx"] for r in per_part if r["mx"] is not None), default=None), sum(r["n"] for r in per_part)

    def _publish(self, merged: DataFrame, staged: DataFrame, touched: list | None, state: dict) -> None:
        if touched is not None:
            tasks = self.store.write_tasks(touched, self.store.fs.size_bytes(self._staged_path(staged)))
            self.store.replace_parts(merged, touched, state=state, key=self.spec.key, tasks=tasks)
        else:
            self.store.replace(merged, state=state)
        self.store.drop_staging()

    def _counted(self, rejected: int) -> dict:
        n = self.store.state().get("rejected_null_keys", 0) + rejected
        return {"rejected_null_keys": n} if n else {}

    def _sync_history(self) -> bool:
        s = self.spec
        if s.max_gaps:
            return self._sync_gaps()
        wm = self.current_watermark()
        read_from = wm - s.overlap if (s.overlap and wm is not None) else wm
        # Literal watermark: pushed into the Parquet or JDBC scan.
        staged, rejected = self._staged_changes(changes_after(_load(self.history), s.hist_id, read_from), self.store.read())
        touched, new_wm, _ = self._touched(staged)
        if new_wm is None:
            self.store.drop_staging()
            return False
        if wm is not None:
            new_wm = max(new_wm, wm)          # a re-read tail never moves the watermark back
        state = {"watermark": new_wm, **self._counted(rejected)}
        current = self.store.read(parts=touched)     # only the touched part directories
        if s.overlap:
            # only re-read rows that are already applied: nothing to publish
            effective = drop_stale(staged, current, s.key, s.hist_id, self.max_broadcast_keys)
            upserts = effective.where(F.col(s.op) > 0)
            # a delete only has an effect while its key still exists
            deletes = join_small(current.select(*s.key),
                                 effective.where(F.col(s.op) == 0).select(*s.key), s.key,
                                 "left_semi", max_rows=self.max_broadcast_keys)
            if upserts.isEmpty() and deletes.isEmpty():
                self.store.drop_staging()
                if new_wm != wm:
                    self.store.set_state(state)
                return False
        merged = cdc_merge(current, staged, s.key, hist_id=s.hist_id, op=s.op, watermark=None,
                           max_broadcast_rows=self.max_broadcast_keys, changes_reduced=True,
                           guard_versions=bool(s.overlap))
        self._publish(merged, staged, touched, state)
        return True

    def _sync_gaps(self) -> bool:
        """Read what is above the watermark or in a gap below it, each id once."""
        s = self.spec
        before = self.store.state()
        wm, gaps = self.current_watermark(), before.get("gaps") or []
        history, h = _load(self.history), F.col(s.hist_id)
        read = self.store.stage(history if wm is None else history.where((h > wm) | within(h, gaps)), "read")
        # greatest id, rows read, least id that was in a gap: the staged rows are all that counts as seen
        top, n, late = read.agg(F.max(h), F.count("*"), F.min(F.when(h <= wm, h)) if wm is not None else F.lit(None)).first()
        if not n:
            self.store.drop_staging()
            return False
        changes = read
        if late is not None:
            keys = read.where(h <= wm).select(*s.key).distinct()
            newer = join_small(history.where((h > late) & (h <= wm)), keys, s.key, "left_semi", max_rows=self.max_broadcast_keys)
            changes = read.unionByName(newer.select(*read.columns))
        staged, rejected = self._staged_changes(changes, self.store.read())
        touched, _, _ = self._touched(staged)
        state = {"watermark": top if wm is None else max(top, wm), "rows_read": before.get("rows_read", 0) + n,
                 "gaps": still_open(read, s.hist_id, gaps, wm, s.gap_horizon, s.max_gaps), **self._counted(rejected)}
        if touched == []:
            self.store.drop_staging()
            self.store.set_state(state)
            return False
        merged = cdc_merge(self.store.read(parts=touched), staged, s.key, hist_id=s.hist_id, op=s.op, watermark=None,
                           max_broadcast_rows=self.max_broadcast_keys, changes_reduced=True)
        self._publish(merged, staged, touched, state)
        return True

    def _settled(self, floor: int | None):
        """Deletes that no change to come can be older than."""
        s = self.spec
        return F.lit(False) if floor is None else F.coalesce((F.col(s.op) == 0) & (F.col(s.hist_id) <= floor), F.lit(False))

    def _sync_batch(self, changes: DataFrame, batch_id: int | None, stream: str) -> bool:
        s = self.spec
        before = self.store.state()
        batches = dict(before.get("batches") or {})
        if batch_id is not None and batch_id <= batches.get(stream, -1):
            return False          # re-delivered micro-batch: already applied
        floor = before.get("floor")
        late, seen = F.lit(False) if floor is None else F.coalesce(F.col(s.hist_id) <= floor, F.lit(False)), Observation()
        watched = changes.observe(seen, F.count(F.when(late, 1)).alias("late"))
        staged, rejected = self._staged_changes(watched.where(~late), self.store.read())
        touched, new_wm, n_staged = self._touched(staged)
        if batch_id is not None:
            batches[stream] = batch_id
        n_late = before.get("late_changes", 0) + metrics(seen, late=0)["late"]
        state = {"batches": batches, **self._counted(rejected), **({"late_changes": n_late} if n_late else {})}
        wm = self.current_watermark()
        if new_wm is not None:
            state["watermark"] = new_wm if wm is None else max(wm, new_wm)
            if s.lateness is not None:
                progress = dict(before.get("progress") or {})
                progress[stream] = max(new_wm, progress.get(stream, new_wm))
                state["progress"] = progress
                floor = max([x for x in (floor, min(progress.values()) - s.lateness) if x is not None])
                state["floor"] = floor
        if new_wm is None:
            self.store.drop_staging()
            self.store.set_state(state)
            return False
        current = self.store.read(parts=touched)
        # the staged rows were counted with their parts; of the joins' sides only keys and versions are sent
        known = (n_staged, 64 * n_staged + 8 * self.store.fs.size_bytes(self._staged_path(staged)))
        newer = drop_stale(staged, current, s.key, s.hist_id, self.max_broadcast_keys, known)
        # an id above all that the store has seen is newer than any row of it: no need to look
        if wm is not None and new_wm <= wm and newer.isEmpty():
            self.store.drop_staging()
            self.store.set_state(state)
            return False
        merged = newer.unionByName(without_keys(current, newer, s.key, self.max_broadcast_keys, unique=True, known=known))
        self._publish(merged.where(~self._settled(floor)), staged, touched, state)
        return True

    # M7
    def purge(self) -> int:
        """Drop the deletes up to the floor from the parts that hold some; returns how many there were."""
        s = self.spec
        with self.store.pinned():
            dead = self._settled(self.store.state().get("floor"))
            rows = self.store.read()
            per_part = rows.where(dead).groupBy(*([s.part_col] if s.bucket_width else [])).count().collect()
            n = sum(r["count"] for r in per_part)
            if not n:
                return 0
            if s.bucket_width:
                parts = [r[s.part_col] for r in per_part]
                self.store.replace_parts(self.store.read(parts=parts).where(~dead), parts, key=s.key, tasks=self.store.write_tasks(parts))
            else:
                self.store.replace(rows.where(~dead))
            self.store.retain(2)
            return n


def _input_path(df: DataFrame) -> str | None:
    files = df.inputFiles()
    return files[0].rsplit("/", 1)[0] if files else None


def run_many(jobs: list[SnapshotSync], force_init: bool = False, at_once: int = 4) -> dict[str, str]:
    """Several tables in one run, one spec each (M12), ``at_once`` at a time.

    Every table's jobs run in a scheduler pool and under a tag of its own. A table that fails does
    not stop the others; when all have ended, ``TablesFailed`` names the failures and the results.
    """
    def one(job: SnapshotSync) -> str:
        sc = job.spark.sparkContext
        sc.setLocalProperty("spark.scheduler.pool", job.spec.name)
        sc.addJobTag(f"table-{job.spec.name}")
        try:
            return job.run(force_init=force_init)
        finally:
            sc.removeJobTag(f"table-{job.spec.name}")
            sc.setLocalProperty("spark.scheduler.pool", None)

    done: dict[str, str] = {}
    failed: dict[str, BaseException] = {}
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        # each call has the session's local properties of this thread
        running = {pool.submit(inheritable_thread_target(j.spark)(one), j): j.spec.name for j in jobs}
        for task in as_completed(running):
            error = task.exception()
            if error is None:
                done[running[task]] = task.result()
            else:
                failed[running[task]] = error
    if failed:
        raise TablesFailed(failed, done)
    return {j.spec.name: done[j.spec.name] for j in jobs}


class TablesFailed(RuntimeError):
    """Some tables of a run failed: ``failed`` has their errors, ``done`` the results of the others."""

    def __init__(self, failed: dict[str, BaseException], done: dict[str, str]):
        super().__init__("; ".join(f"{name}: {error}" for name, error in sorted(failed.items())))
        self.failed, self.done = failed, done
