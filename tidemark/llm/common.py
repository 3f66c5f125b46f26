"""Helpers shared by the operators: table reads, staged tables, words."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import work_path

#: ASCII bytes that are neither digit nor letter end a word; A-Z become a-z; bytes of
#: multi-byte characters are word bytes. This is ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` on
#: the text with A-Z lower-cased, done by one table look-up per byte.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text; null has none."""
    return text.translate(WORD_BYTES).split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Send at most ``rows`` rows to Python at once: texts are long, and a batch is held whole on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it from there.

    Cuts the lineage: what follows survives lost executors without repeating the work
    before it, and values that depend on the physical plan (row ids) are fixed.
    """
    spark = df.sparkSession
    path = work_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that do not clash with the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_bytes(batch, col: str) -> list[bytes | None]:
    """The texts of an Arrow batch as UTF-8 bytes."""
    import pyarrow as pa
    c = batch.column(batch.schema.get_field_index(col))
    kind = pa.large_binary() if pa.types.is_large_string(c.type) else pa.binary()
    return c.cast(kind).to_pylist()


def give_back() -> None:
    """Return freed memory to the system: Python workers are reused and would keep the most they ever held."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def slices(batches: Iterable, rows: int = 512):
    """Arrow batches in slices of a few rows, so that what is made of them stays small."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)
    give_back()


def gathered(batches: Iterable, size: int = 3 << 20):
    """Arrow batches joined until they hold ``size`` bytes: work done once a batch is done less often."""
    import pyarrow as pa
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.nbytes
        if n >= size:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)
    held = None
    give_back()


def held_out(doc_id):
    """True for rows whose labels must not be learnt: crc32(doc_id as text) mod 4 = 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def chance(*cols, seed: int = 5):
    """A number in [0, 1) fixed by the columns' values."""
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 30)) / float(1 << 30)


def lowest(df: DataFrame, n: int, *cols: str, seed: int = 5) -> DataFrame:
    """About the ``n`` rows of lowest hash, never more: a bounded sample that reruns repeat.

    The count sets a hash limit that some 2n rows pass, so the last sort sees a few rows
    whatever the size of the table.
    """
    total = df.count()
    few = df.where(chance(*cols, seed=seed) < (2 * n + 100) / total) if total > 2 * n + 100 else df
    return few.orderBy(chance(*cols, seed=seed), *cols).limit(n)
