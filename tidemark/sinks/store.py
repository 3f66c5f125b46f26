"""Versioned Parquet store: staged version directories plus a manifest written last
(K3, K4, K6, K7, K9, K10, M10).

Layout::

    root/tm_version=<n>/                    data of version n (unpartitioned), or
    root/tm_version=<n>/<part_col>=<m>/     data of part m written in version n
    root/_manifest/<seq>.json               manifest; the highest sequence is current
    root/_staging/<run>/                    staged inputs of a run (change sets)

The version is a partition column like the part, so any number of versions is one scan
with pruning on the part; the name ``tm_version`` is reserved.

A manifest names, for every live part, the versions whose files make up that part,
plus the table schema and a free-form ``state`` (watermarks, checkpoints, processed
batch ids). A job writes its data into a new version directory first and publishes
by writing the next manifest with a create-then-rename; readers only ever follow a
manifest, so a failed or running job is invisible. Old versions stay until
``retain`` drops them, which gives the one-generation backup of the reference.
Parts absent from the manifest are gone, so a part emptied by deletes disappears
without deleting anything in place.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import json
import math
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators._util import as_list
from tidemark.sinks.fs import HadoopFS

ALL = "*"
VERSION_COL = "tm_version"
VERSION_PREFIX = f"{VERSION_COL}="
NULL_PART = "__HIVE_DEFAULT_PARTITION__"
#: Characters that partition directories write as percent and two hex digits (fixed values of the layout).
ESCAPED = "\"#%'*/:=?\\\x7f{[]^"

# Fixed writer defaults of the reference's exports: zstd, 100,000-row row groups.
DEFAULT_WRITE_OPTIONS = {"compression": "zstd", "parquet.block.row.count.limit": "100000"}


def part_name(value) -> str:
    """The directory name of a part value."""
    if value is None:
        return NULL_PART
    return "".join(f"%{ord(c):02X}" if c < " " or c in ESCAPED else c for c in str(value))


class ManifestError(RuntimeError):
    pass


class VersionedStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fs = HadoopFS(spark)
        self._pinned: list = []

    @contextlib.contextmanager
    def pinned(self):
        """One consistent view for a run: the manifest is read once, then follows what the
        run itself publishes. A store has a single writer."""
        outer = self._pinned
        self._pinned = outer or [self.manifest()]
        try:
            yield self
        finally:
            self._pinned = outer

    # -------------------------------------------------------------- manifest
    @property
    def manifest_dir(self) -> str:
        return f"{self.root}/_manifest"

    def _seqs(self) -> list[int]:
        out = []
        for name in self.fs.list_names(self.manifest_dir):
            if name.endswith(".json") and not name.startswith("."):
                out.append(int(name[:-5]))
        return sorted(out)

    def manifest(self) -> dict | None:
        """The current manifest, or None when nothing was ever published.

        An unreadable manifest is an error: silently starting over would reload or,
        worse, skip data (M10).
        """
        if self._pinned:
            return self._pinned[0]
        seqs = self._seqs()
        if not seqs:
            return None
        path = f"{self.manifest_dir}/{seqs[-1]:012d}.json"
        try:
            return json.loads(self.fs.read_text(path))
        except Exception as e:  # noqa: BLE001
            raise ManifestError(f"unreadable manifest {path}: {e}") from e

    def exists(self) -> bool:
        return self.manifest() is not None

    def state(self) -> dict:
        m = self.manifest()
        return dict(m.get("state") or {}) if m else {}

    def _publish(self, *, parts: dict, schema: T.StructType, part_col: str | None,
                 state: dict | None, base: dict | None, fresh: bool = False, written: dict | None = None,
                 pending: list | None = None) -> dict:
        """``fresh`` starts with no state but ``state`` (a reload); otherwise ``state`` adds to the old
        one, and a value of None removes an entry. ``written``: part directories of new versions.
        ``pending``: versions of an unfinished load, kept but not read."""
        seq = (base["seq"] + 1) if base else 1
        kept = {} if fresh or not base else dict(base.get("state") or {})
        kept.update(state or {})
        live = {v for vs in parts.values() for v in vs}
        known = {**((base or {}).get("written") or {}), **{str(v): n for v, n in (written or {}).items()}}
        m = {
            "seq": seq,
            "schema": schema.json(),
            "part_col": part_col,
            "parts": {str(k): sorted(set(v)) for k, v in parts.items() if v},
            "written": {v: n for v, n in known.items() if int(v) in live},
            "pending": pending or [],
            "state": {k: v for k, v in kept.items() if v is not None or k in ("watermark", "checkpoint")},
            "created": dt.datetime.now(dt.timezone.utc).isoformat(),
        }
        self.fs.mkdirs(self.manifest_dir)
        self.fs.write_text_atomic(f"{self.manifest_dir}/{seq:012d}.json", json.dumps(m, default=str))
        if self._pinned:
            self._pinned[0] = m
        return m

    def _next_version(self, base: dict | None) -> int:
        used = [self._version_of(n) for n in self.fs.list_names(self.root, dirs_only=True)
                if n.startswith(VERSION_PREFIX)]
        return max([0] + used + ([base["seq"]] if base else [])) + 1

    @staticmethod
    def _version_of(name: str) -> int:
        return int(name[len(VERSION_PREFIX):])

    def vdir(self, v: int) -> str:
        return f"{self.root}/{VERSION_PREFIX}{v}"

    # -------------------------------------------------------------- reading
    def schema(self) -> T.StructType:
        m = self.manifest()
        if m is None:
            raise ManifestError(f"no table at {self.root}")
        return T.StructType.fromJson(json.loads(m["schema"]))

    def paths(self, parts=None, manifest: dict | None = None) -> list[str]:
        """Directories of the live data: a version's own where all its parts are live, else one per part."""
        m = manifest or self.manifest()
        if m is None:
            return []
        pc = m["part_col"]
        wanted = None if parts is None else {part_name(p) for p in parts}
        by_version: dict[int, list[str]] = {}
        for p, versions in sorted(m["parts"].items()):
            if wanted is None or p in wanted:
                for v in versions:
                    by_version.setdefault(int(v), []).append(p)
        out = []
        for v, ps in sorted(by_version.items()):
            if pc is None or len(ps) == (m.get("written") or {}).get(str(v)):
                out.append(self.vdir(v))
            else:
                out += [f"{self.vdir(v)}/{pc}={p}" for p in ps]
        return out

    def read(self, parts=None, pending: bool = False) -> DataFrame:
        """The current table, or only the named parts: the other directories are never listed or
        opened. One scan however many versions are live; ``part_col`` is a partition column of it.
        With ``pending``, the rows of an unfinished load as well."""
        m = self.manifest()
        if m is None:
            raise ManifestError(f"no table at {self.root}")
        schema = T.StructType.fromJson(json.loads(m["schema"]))
        paths = self.paths(parts, m)
        if pending:
            paths += [self.vdir(v) for v in m.get("pending") or []]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self._scan(paths, schema)

    def _scan(self, paths: list[str], schema: T.StructType) -> DataFrame:
        whole = T.StructType([*schema.fields, T.StructField(VERSION_COL, T.LongType())])
        return (self.spark.read.schema(whole).option("basePath", self.root).parquet(*paths)
                .select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]))

    # -------------------------------------------------------------- writing
    @staticmethod
    def cluster_for_parts(df: DataFrame, part_col: str, key=None, n: int | None = None) -> DataFrame:
        """Group rows by part before a partitioned write, with the REBALANCE hint.

        Without it every task writes a file into every part it meets (#tasks x #parts
        small files). REBALANCE hashes on the part column and lets adaptive execution
        coalesce small partitions and split a skewed (hot) part into several tasks; it
        needs no sampling pass, so the merge feeding the write runs once (a range
        repartition would execute it twice). ``n`` sets the initial partition count
        (from stored bytes when known). Rows are then sorted by part and key inside
        each task, which is the writer's required order and gives tight row-group
        statistics on the key.
        """
        keys = [key] if isinstance(key, str) else list(key or [])
        out = df.hint("rebalance", n, part_col) if n else df.hint("rebalance", part_col)
        return out.sortWithinPartitions(part_col, *keys)

    def write_tasks(self, parts, extra_bytes: int = 0, target_file_bytes: int = 256 << 20) -> int:
        """Task count for rewriting ``parts``: one file of about ``target_file_bytes``
        per task, and at least one task per part up to the cluster's parallelism."""
        parts = list(parts)
        m = self.manifest()
        live = m["parts"] if m else {}
        # One size call per version directory, scaled to the touched share of parts
        # (an estimate; per-part calls would cost one round trip per part).
        versions = sorted({v for vs in live.values() for v in vs})
        table = sum(self.fs.size_bytes(self.vdir(v)) for v in versions)
        share = len([p for p in parts if part_name(p) in live]) / max(1, len(live))
        total = extra_bytes + int(table * share)
        return max(1, math.ceil(total / target_file_bytes),
                   min(len(parts), self.spark.sparkContext.defaultParallelism))

    def _write(self, df: DataFrame, path: str, part_col: str | None, options: dict | None,
               sort_within=None, key=None, tasks: int | None = None) -> None:
        opts = dict(DEFAULT_WRITE_OPTIONS)
        opts.update(options or {})
        if part_col:
            df = self.cluster_for_parts(df, part_col, key, tasks)
        if sort_within:
            df = df.sortWithinPartitions(*sort_within)
        w = df.write.mode("errorifexists").options(**opts)
        if part_col:
            w = w.partitionBy(part_col)
        w.parquet(path)

    def _written_parts(self, path: str, part_col: str) -> list[str]:
        pre = f"{part_col}="
        return [n[len(pre):] for n in self.fs.list_names(path, dirs_only=True) if n.startswith(pre)]

    @staticmethod
    def _full_schema(df: DataFrame, part_col: str | None) -> T.StructType:
        if any(f.name.lower() == VERSION_COL for f in df.schema.fields):
            raise ValueError(f"column name {VERSION_COL} is reserved")
        if part_col is None:
            return df.schema
        fields = [f for f in df.schema.fields if f.name != part_col]
        return T.StructType(fields + [df.schema[part_col]])

    def _new_version(self, df, base, part_col, options, sort_within, key, tasks=None) -> tuple[int, list[str]]:
        """Write ``df`` as the next version; its number and its part names."""
        v = self._next_version(base)
        path = self.vdir(v)
        self._write(df, path, part_col, options, sort_within, key, tasks)
        return v, self._written_parts(path, part_col) if part_col else [ALL]

    def replace(self, df: DataFrame, *, part_col: str | None = None, state: dict | None = None, fresh: bool = False,
                options: dict | None = None, sort_within=None, key=None) -> dict:
        """Publish ``df`` as the whole table. ``fresh``: a reload, whose state starts anew."""
        base = self.manifest()
        schema = self._full_schema(df, part_col)
        v, parts = self._new_version(df, base, part_col, options, sort_within, key)
        return self._publish(parts={p: [v] for p in parts}, schema=schema, part_col=part_col, state=state, base=base,
                             fresh=fresh, written={v: len(parts)})

    def replace_parts(self, df: DataFrame, touched, *, state: dict | None = None,
                      options: dict | None = None, sort_within=None, key=None,
                      tasks: int | None = None, schema: T.StructType | None = None) -> dict:
        """Rewrite only the ``touched`` parts from ``df`` (which must hold exactly the
        new content of those parts). A touched part that ``df`` leaves empty is
        dropped from the table. ``schema``: the table's schema with new columns."""
        base = self.manifest()
        if base is None or not base["part_col"]:
            raise ManifestError("replace_parts needs an existing partitioned table")
        pc = base["part_col"]
        v, names = self._new_version(df, base, pc, options, sort_within, key, tasks)
        gone = {part_name(t) for t in touched}
        parts = {p: list(vs) for p, vs in base["parts"].items() if p not in gone}
        parts.update({p: [v] for p in names})
        return self._publish(parts=parts, schema=schema or self.schema(), part_col=pc, state=state, base=base, written={v: len(names)})

    def append(self, df: DataFrame, *, part_col: str | None = None, state: dict | None = None,
               options: dict | None = None, sort_within=None, key=None, add_new_columns: bool = False) -> dict:
        """Add ``df``'s rows as new files (K6); creates the table when absent. With
        ``add_new_columns`` the schema grows; older files give null for the new ones."""
        from tidemark.operators.merge import align_to_schema
        base = self.manifest()
        if base is None:
            return self.replace(df, part_col=part_col, state=state, options=options,
                                sort_within=sort_within, key=key)
        pc = base["part_col"]
        schema = self.schema()
        if add_new_columns:
            known = {f.name.lower() for f in schema.fields}
            schema = T.StructType([*schema.fields, *[f for f in df.schema.fields if f.name.lower() not in known]])
        self._full_schema(df, None)
        v, names = self._new_version(align_to_schema(df, schema, allow_missing=add_new_columns), base, pc, options, sort_within, key)
        parts = {p: list(vs) for p, vs in base["parts"].items()}
        for p in names:
            parts.setdefault(p, []).append(v)
        return self._publish(parts=parts, schema=schema, part_col=pc, state=state, base=base, written={v: len(names)})

    # -------------------------------------------------------------- loads in progress
    def append_pending(self, df: DataFrame, state: dict, options: dict | None = None) -> dict:
        """Add rows that stay invisible until ``publish_pending`` (K9): readers see the table as it was."""
        base = self.manifest()
        if base and base["part_col"]:
            raise ManifestError("pending loads are for unpartitioned tables")
        schema = self._full_schema(df, None)
        if base:
            from tidemark.operators.merge import align_to_schema
            schema = self.schema()
            df = align_to_schema(df, schema)
        v, _ = self._new_version(df, base, None, options, None, None)
        return self._publish(parts=base["parts"] if base else {}, schema=schema, part_col=None, state=state, base=base,
                             pending=[*((base or {}).get("pending") or []), v])

    def publish_pending(self, state: dict | None = None) -> dict:
        """Make all pending rows visible at once."""
        base = self.manifest()
        if base is None:
            raise ManifestError(f"no table at {self.root}")
        new = base.get("pending") or []
        return self._publish(parts={ALL: [*base["parts"].get(ALL, []), *new]}, schema=self.schema(), part_col=None, state=state,
                             base=base, written=dict.fromkeys(new, 1))

    def set_state(self, state: dict) -> dict:
        """Publish a manifest that only changes ``state`` (same data)."""
        base = self.manifest()
        if base is None:
            raise ManifestError("no table to attach state to")
        return self._publish(parts=base["parts"], schema=self.schema(), part_col=base["part_col"],
                             state=state, base=base, pending=base.get("pending"))

    # -------------------------------------------------------------- maintenance
    def compact(self, *, target_file_bytes: int = 256 << 20, key=None) -> dict:
        """Rewrite the live table into files of about ``target_file_bytes``.

        Partitioned tables are rebalanced on the part: a hot part is split over several
        tasks while each task still writes few parts.
        """
        m = self.manifest()
        if m is None:
            raise ManifestError(f"no table at {self.root}")
        # one call per version, also where only some of its parts are live: an upper bound
        versions = sorted({v for vs in m["parts"].values() for v in vs})
        total = sum(self.fs.size_bytes(self.vdir(v)) for v in versions)
        n = max(1, math.ceil(total / max(1, target_file_bytes)))
        df = self.read()
        pc = m["part_col"]
        if pc:
            # at most about one file per part and task; use the cores even when small
            n = max(n, min(len(m["parts"]), self.spark.sparkContext.defaultParallelism))
            df = self.cluster_for_parts(df, pc, key, n)
        else:
            df = df.repartition(n)
        return self._replace_clustered(df, pc, {"compacted_from": m["seq"]}, key)

    def compaction_plan(self, target_file_bytes: int = 256 << 20) -> dict[str, tuple[list[int], int]]:
        """Per part the versions to merge and the files to make of them.

        A version takes part where its files in the part are smaller than half the target on
        average; a part is planned if its small files, packed to the target, become fewer.
        """
        m = self.manifest()
        if m is None:
            raise ManifestError(f"no table at {self.root}")
        pre = f"{m['part_col']}="
        sizes: dict[tuple[str, int], list[int]] = {}
        for v in sorted({int(v) for vs in m["parts"].values() for v in vs}):
            for path, n in self.fs.files(self.vdir(v)):
                part = path.split("/")[0][len(pre):] if m["part_col"] else ALL
                sizes.setdefault((part, v), []).append(n)
        plan = {}
        for p, versions in m["parts"].items():
            small = [int(v) for v in versions if 2 * sum(sizes.get((p, int(v)), [])) < target_file_bytes * len(sizes.get((p, int(v)), []))]
            files = [n for v in small for n in sizes[p, v]]
            planned = max(1, math.ceil(sum(files) / max(1, target_file_bytes)))
            if len(files) > planned:
                plan[p] = (small, planned)
        return plan

    def compact_small(self, *, target_file_bytes: int = 256 << 20, key=None) -> dict[str, tuple[list[int], int]]:
        """Merge small files where they are, part by part (K10); returns the plan that was carried out.

        Parts without a plan, and large files of parts with one, keep their versions and are not read.
        """
        with self.pinned():
            plan, base = self.compaction_plan(target_file_bytes), self.manifest()
            if not plan:
                return plan
            pc, schema = base["part_col"], self.schema()
            paths = [f"{self.vdir(v)}/{pc}={p}" if pc else self.vdir(v) for p, (vs, _) in sorted(plan.items()) for v in vs]
            df, total = self._scan(paths, schema), sum(n for _, n in plan.values())
            if pc:
                # a part's rows are dealt to as many tasks as it is to have files
                files = self.spark.createDataFrame([(None if p == NULL_PART else unquote(p), n) for p, (_, n) in plan.items()], "p string, n int")
                files = files.select(F.col("p").alias("__part"), F.col("n").alias("__files"))
                df = df.join(F.broadcast(files), F.col(pc).cast("string").eqNullSafe(F.col("__part")))     # no larger than the manifest
                deal = F.pmod(F.xxhash64(*[F.col(c) for c in as_list(key)], F.monotonically_increasing_id()), F.col("__files"))
                df = df.withColumn("__deal", deal).repartition(total, pc, "__deal").sortWithinPartitions(pc, *as_list(key)).select(*[f.name for f in schema.fields])
            else:
                df = df.repartition(total).sortWithinPartitions(*as_list(key)) if key else df.repartition(total)
            v = self._next_version(base)
            w = df.write.mode("errorifexists").options(**DEFAULT_WRITE_OPTIONS)
            (w.partitionBy(pc) if pc else w).parquet(self.vdir(v))
            parts = {p: [x for x in vs if p not in plan or int(x) not in plan[p][0]] for p, vs in base["parts"].items()}
            for p in plan:
                parts[p] = [*parts[p], v]
            self._publish(parts=parts, schema=schema, part_col=pc, state={"compacted_from": base["seq"]}, base=base,
                          written={v: len(plan)}, pending=base.get("pending"))
            return plan

    def _replace_clustered(self, df: DataFrame, pc: str | None, state: dict, key) -> dict:
        base = self.manifest()
        v = self._next_version(base)
        path = self.vdir(v)
        w = df.write.mode("errorifexists").options(**DEFAULT_WRITE_OPTIONS)
        (w.partitionBy(pc) if pc else w).parquet(path)
        parts = self._written_parts(path, pc) if pc else [ALL]
        return self._publish(parts={p: [v] for p in parts}, schema=self.schema(), part_col=pc, state=state, base=base,
                             written={v: len(parts)}, pending=base.get("pending"))

    def retain(self, keep: int = 2) -> list[str]:
        """Drop version directories that none of the last ``keep`` manifests names."""
        seqs = self._seqs()
        keep_seqs = seqs[-keep:]
        live = set()
        for s in keep_seqs:
            m = json.loads(self.fs.read_text(f"{self.manifest_dir}/{s:012d}.json"))
            for vs in [*m["parts"].values(), m.get("pending") or []]:
                live.update(int(v) for v in vs)
        dropped = []
        newest = max(live) if live else 0
        for name in self.fs.list_names(self.root, dirs_only=True):
            if name.startswith(VERSION_PREFIX) and self._version_of(name) not in live \
                    and self._version_of(name) < newest:
                self.fs.delete(f"{self.root}/{name}")
                dropped.append(name)
        for s in seqs[:-keep]:
            self.fs.delete(f"{self.manifest_dir}/{s:012d}.json", recursive=False)
        return dropped

    # -------------------------------------------------------------- staging
    def drop_staging(self) -> None:
        """Delete staged inputs once the version built from them is published (the
        store has a single writer, so no other run is using them)."""
        self.fs.delete(f"{self.root}/_staging")

    def stage(self, df: DataFrame, name: str = "changes") -> DataFrame:
        """Write ``df`` to a staging table in the shared folder and read it back.

        Cuts lineage to the source (a database or a large scan is read once) and
        lets later stages survive executor loss by re-reading files, not sources.
        """
        path = f"{self.root}/_staging/{name}-{uuid.uuid4().hex[:12]}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
