"""FX-rate documents.

A rate document is XML with repeated ``Currency`` elements: attribute ``Kod``, and
children ``Isim`` (name), ``ForexBuying`` and ``ForexSelling``; the last two may be
empty. Documents are landed files (or a column of XML text); parsing runs on the
executors with ``from_xml`` + ``explode``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.encode import to_float
from tidemark.operators.joins import join_small

# The element and attribute names of the rate document.
RATE_SCHEMA = ("_Tarih string, _Date string, "
               "Currency array<struct<_Kod:string, Isim:string, ForexBuying:string, ForexSelling:string>>")
DOC_DATE_FORMAT = "dd.MM.yyyy"
ROW_TAG = "Tarih_Date"


def parse_rate_documents(docs: DataFrame, xml_col: str = "xml", date_col: str | None = None) -> DataFrame:
    """Documents -> rows (rate_date, code, name, buy, sell).

    A row is kept only when code, buying and selling rate are all non-empty; the
    rates are parsed with ``try_cast`` (bad text -> null, not a failed job). The
    date comes from ``date_col`` when given, else from the document's ``Tarih``.
    """
    parsed = docs.select(F.from_xml(F.col(xml_col), RATE_SCHEMA).alias("doc"),
                         *([F.col(date_col).alias("_d")] if date_col else []))
    flat = parsed.select("doc.*", *(["_d"] if date_col else []))
    if date_col:   # an explicit date wins over the document's own
        flat = flat.withColumn("_Tarih", F.date_format("_d", DOC_DATE_FORMAT)).drop("_d")
    return rate_rows(flat)


def count_malformed(docs: DataFrame, xml_col: str = "xml") -> DataFrame:
    """(n_documents, n_malformed): documents that ``parse_rate_documents`` can read nothing from
    because they are not well-formed XML."""
    doc = F.from_xml(F.col(xml_col), RATE_SCHEMA + ", _bad string", {"columnNameOfCorruptRecord": "_bad"})
    bad = F.col("doc").isNull() | F.col("doc._bad").isNotNull()
    return (docs.where(F.col(xml_col).isNotNull()).select(doc.alias("doc"))
            .agg(F.count("*").alias("n_documents"), F.count(F.when(bad, 1)).alias("n_malformed")))


def rate_rows(parsed: DataFrame) -> DataFrame:
    """Rows of parsed documents (``_Tarih``, ``Currency`` columns) -> rate rows."""
    rate_date = F.to_date(F.col("_Tarih"), DOC_DATE_FORMAT)
    cur = parsed.select(rate_date.alias("rate_date"), F.explode("Currency").alias("c"))

    def present(c):
        return F.col(c).isNotNull() & (F.trim(F.col(c)) != "")
    return (cur.select("rate_date", F.col("c._Kod").alias("code"), F.col("c.Isim").alias("name"),
                       F.col("c.ForexBuying").alias("b"), F.col("c.ForexSelling").alias("s"))
               .where(present("code") & present("b") & present("s"))
               .select("rate_date", F.upper("code").alias("code"), "name",
                       to_float("b").alias("buy"), to_float("s").alias("sell")))


def read_rate_files(spark: SparkSession, path: str) -> DataFrame:
    """Landed rate files -> rows, with Spark's XML source (S14): every
    ``Tarih_Date`` element is a row. A file holds one document (as published, one per
    day), or several wrapped in one root element; several bare top-level documents in
    one file are not well-formed XML and the reader returns them as corrupt records.
    The date comes from the document itself, so file names carry no meaning."""
    docs = (spark.read.format("xml").option("rowTag", ROW_TAG).schema(RATE_SCHEMA)
            .load(path))
    return rate_rows(docs)


def lookup_rates(requests: DataFrame, rates: DataFrame, *, date_col: str = "rate_date",
                 code_col: str = "code", max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """Rate for each request (X2): case-insensitive code, exact day. An unknown code
    or a day without a document gives null rates (no previous-day fill)."""
    r = rates.select(F.col("rate_date").alias("__d"), F.col("code").alias("__c"),
                     F.col("name").alias("rate_name"), "buy", "sell")
    req = requests.withColumn("__k", F.upper(F.col(code_col)))
    out = join_small(req, r, (F.col(date_col) == F.col("__d")) & (F.col("__k") == F.col("__c")),
                     "left", max_rows=max_broadcast_rows)
    return out.drop("__d", "__c", "__k")
