"""Versioned upsert as a stream: landed files of row versions -> ``foreachBatch`` -> key buckets (M4).

Files may land in any order and more than once. Where the version is a time it is the event time:
equal rows that come again within ``delay`` are dropped by the stream's own state, which the
watermark keeps bounded; rows older than the watermark are dropped as late, and counted by
``late_rows``. What passes is merged by ``VersionUpsert.sync_batch``, which compares version and
content per key, so a repetition that the state has forgotten has no effect either. Versions of
other types have no event time: then only the merge decides. Batch ids are recorded per stream
with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.changes import fingerprint
from tidemark.plans.upsert import VersionUpsert

EVENT, PRINT = "__tm_event", "__tm_print"


def first_deliveries(stream: DataFrame, key: list[str], version: str, delay: str) -> DataFrame:
    """Each row once, as far back as the event-time watermark reaches."""
    marked = stream.withColumns({EVENT: F.col(version).cast("timestamp"), PRINT: fingerprint(stream)})
    return marked.withWatermark(EVENT, delay).dropDuplicatesWithinWatermark([*key, version, PRINT]).drop(EVENT, PRINT)


def start_version_stream(spark: SparkSession, job: VersionUpsert, path: str, schema: T.StructType, *, delay: str = "1 day",
                         available_now: bool = True, max_files_per_trigger: int | None = None,
                         processing_time: str | None = None, name: str = "default") -> StreamingQuery:
    """``delay``: how far behind the newest version a row may come and still be taken."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = reader.parquet(path)
    if isinstance(schema[job.version_col].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        rows = first_deliveries(rows, job.key, job.version_col, delay)

    def apply(batch_df, batch_id):
        job.sync_batch(batch_df, int(batch_id), name)

    w = rows.writeStream.foreachBatch(apply).option("checkpointLocation", f"{job.store.root}/_stream_checkpoint/{name}")
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def late_rows(query: StreamingQuery) -> int:
    """Rows that the reported batches dropped because they came behind the watermark."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
