"""Parquet exports (K1, K2, K11) and other file formats."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.specs import TargetOptions

# Fixed values of the reference exports: zstd codec, 100,000-row row groups.
#: Rows in a JSON document unless the target says otherwise.
JSON_ROWS = 50_000
EXPORT_CODEC = "zstd"
ROW_GROUP_ROWS = 100_000
TEXT_CODECS = ("none", "gzip", "bzip2", "deflate", "snappy", "lz4")


def export_parquet(df: DataFrame, path: str, *, partition_by=None, sort_within=None,
                   max_records_per_file: int | None = None, mode: str = "errorifexists",
                   row_group_rows: int = ROW_GROUP_ROWS, codec: str = EXPORT_CODEC) -> str:
    """Write ``df`` as Parquet (zstd, row groups of ``row_group_rows``) from the
    executors; nothing passes through the driver."""
    if sort_within:
        df = df.sortWithinPartitions(*([sort_within] if isinstance(sort_within, str) else sort_within))
    w = (df.write.mode(mode).option("compression", codec)
           .option("parquet.block.row.count.limit", str(row_group_rows)))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)
    return path


def write_files(df: DataFrame, path: str, opts: TargetOptions | None = None, mode: str = "errorifexists") -> str:
    """csv / json / jsonlines / orc / parquet / text with the declared target options.

    ``json``: every file is one document, an array of at most ``file_max_rows`` objects (by default
    ``JSON_ROWS``), for a reader takes a document whole; ``jsonlines``: one object a line.
    """
    o = opts or TargetOptions()
    if o.ignore_existing:
        mode = "ignore"
    if o.format == "json":
        df, o = json_documents(df, o.file_max_rows or JSON_ROWS, o), replace(o, format="text", file_max_rows=1)
    w = df.write.mode(mode).format({"jsonlines": "json"}.get(o.format, o.format))
    if o.format == "csv":
        w = w.option("header", str(o.header).lower()).option("sep", o.delimiter)
    if o.datetime_format and o.format in ("csv", "json", "jsonlines"):
        w = w.option("timestampFormat", o.datetime_format)
    if o.compression and o.compression != "auto":
        # zstd is the Parquet/ORC default; text formats only take Hadoop codecs.
        if o.format in ("parquet", "orc") or o.compression in TEXT_CODECS:
            w = w.option("compression", o.compression)
    if o.format == "parquet":
        w = w.option("parquet.block.row.count.limit", str(o.row_group_rows))
    if o.file_max_rows:
        w = w.option("maxRecordsPerFile", str(o.file_max_rows))
    for k, v in o.extra.items():
        w = w.option(k, v)
    w.save(path)
    return path


def json_documents(df: DataFrame, rows: int, opts: TargetOptions | None = None) -> DataFrame:
    """One text per row: a JSON array of at most ``rows`` rows, which follow each other in ``df``.

    A document is put together in one task, so ``rows`` bounds it; null fields are written out.
    """
    how = {"ignoreNullFields": "false"}
    if opts and opts.datetime_format:
        how["timestampFormat"] = opts.datetime_format
    at = F.monotonically_increasing_id()     # partition in the upper bits, row below
    lines = df.select(at.alias("at"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), how).alias("line"))
    document = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), ",\n")
    docs = lines.groupBy(F.shiftright("at", 33), F.floor(F.col("at").bitwiseAND((1 << 33) - 1) / rows)).agg(document.alias("d"))
    return docs.select(F.concat(F.lit("["), "d", F.lit("]")).alias("value"))


def rows_for_bytes(df: DataFrame, path: str, max_bytes: int, opts: TargetOptions, sample_rows: int = 20_000) -> int:
    """Rows of ``df`` that make a file of at most about ``max_bytes``: measured on a sample written in the target's format.

    The sample is spread over the frame; small frames are measured whole. Written again with the rows
    found, it shows what a file costs beside its rows, and the number is lowered until its files fit.
    """
    from tidemark.sinks.fs import HadoopFS
    n = df.count()
    if not n:
        return 1
    fs = HadoopFS(df.sparkSession)
    plain = path + "-rows"
    (df if n <= sample_rows else df.sample(sample_rows / n, seed=11)).write.parquet(plain)      # the source is read once
    part = df.sparkSession.read.schema(df.schema).parquet(plain).coalesce(1)
    rows = part.count()
    for _ in range(6):
        write_files(part, path, replace(opts, file_max_rows=rows, file_max_bytes=None, ignore_existing=False), mode="overwrite")
        largest = max([size for _, size in fs.files(path)], default=0)
        if largest <= 0.95 * max_bytes or rows <= 1:
            break
        rows = max(1, int(rows * 0.85 * max_bytes / largest))
    else:
        largest = max_bytes
    if rows == part.count() and largest:     # the sample fits into one file: as many rows as its width allows
        rows = max(rows, int(0.85 * rows * max_bytes / largest))
    for p in (path, plain):
        fs.delete(p)
    return rows
