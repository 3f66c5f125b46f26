"""Column functions, file sources, rate documents, federated export, driver contract."""

import pytest

from conftest import SF001, rows
from pyspark.sql import functions as F
from tidemark.functions.cleaning import apply_casing, cast_columns, clean_strings, round_fractional
from tidemark.functions.encode import (
    checkpoint_text, long_to_rowversion, parse_rowversion_hex, rowversion_hex, to_float,
)
from tidemark.operators.buckets import bucket_id, floor_div
from tidemark.plans.federated import ExportRequest, federated_export, federated_query, frame_sql
from tidemark.sinks.parquet import export_parquet, write_files
from tidemark.sources.files import read_files, read_filtered, read_parquet_dir, flatten
from tidemark.sources.rates import lookup_rates, parse_rate_documents, read_rate_files
from tidemark.specs import SourceOptions, TargetOptions


def test_floor_div_and_buckets(spark):
    df = spark.createDataFrame([(-11,), (-10,), (-1,), (0,), (9,), (10,), (None,),
                                (9_007_199_254_740_993,)], "k long")
    got = [r[0] for r in df.select(floor_div("k", 10)).collect()]
    assert got == [-2, -1, -1, 0, 0, 1, None, 900_719_925_474_099]
    assert [r[0] for r in df.select(bucket_id("k", 10)).collect()][6] == 0


def test_rowversion_encodings(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "k long")
    got = [r[0] for r in df.select(rowversion_hex(long_to_rowversion("k"))).collect()]
    assert got == ["0x0000000000000001", "0xffffffffffffffff", "0x0000000000000000"]
    assert parse_rowversion_hex("0x00FF") == b"\x00\xff"
    assert parse_rowversion_hex(None) == bytes(8)
    ts = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-02 03:04:05' AS t").select(checkpoint_text("t")).first()[0]
    assert ts == "2024-01-02 03:04:05.000000"


def test_to_float_and_cleaning(spark):
    df = spark.createDataFrame([(" 1.5 ", " a ", 1.26), ("", "", 2.0), ("x", "N/A", None)],
                               "s string, t string, d double")
    assert [r[0] for r in df.select(to_float("s")).collect()] == [1.5, None, None]
    c = clean_strings(df, trim_space=True, empty_as_null=True, null_if="N/A")
    assert rows(c, "t") == sorted([("a",), (None,), (None,)], key=repr)
    assert [r["d"] for r in round_fractional(df, 1).collect()] == [1.3, 2.0, None]
    assert cast_columns(df, {"s": "double"}).schema["s"].dataType.simpleString() == "double"
    assert apply_casing(df.withColumnRenamed("s", "FirstName"), "snake").columns[0] == "first_name"
    with pytest.raises(ValueError):
        cast_columns(df, {"nope": "int"})


def test_parquet_dir_and_filters(spark, tmp_root):
    with pytest.raises(FileNotFoundError):
        read_parquet_dir(spark, tmp_root + "/missing")
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    path = export_parquet(o, tmp_root + "/o", max_records_per_file=100)
    back = read_parquet_dir(spark, path, columns=["o_orderkey"], where="o_orderkey > 10")
    assert back.count() == o.where("o_orderkey > 10").count()
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,10)]" in plan
    assert read_filtered(o, "o_orderkey > 10", limit=5, order_by="o_orderkey").count() == 5


def test_file_formats_roundtrip(spark, tmp_root):
    c = spark.read.parquet(f"{SF001}/customer.parquet")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in c.schema.fields)
    for fmt in ("csv", "jsonlines", "orc", "parquet"):
        p = write_files(c, f"{tmp_root}/{fmt}", TargetOptions(format=fmt, compression="gzip"
                                                              if fmt in ("csv", "jsonlines") else "zstd"))
        back = read_files(spark, p, fmt, SourceOptions(schema=ddl))
        assert rows(back) == rows(c), fmt


def test_flatten_and_json_paths(spark):
    df = spark.sql("SELECT named_struct('a', 1, 'b', named_struct('c', 'x')) AS s, '{\"k\": 3}' AS j")
    assert flatten(df).columns == ["s__a", "s__b__c", "j"]
    from tidemark.sources.files import apply_source_options
    out = apply_source_options(df, SourceOptions(jmespath={"k": ("j", "$.k")}))
    assert out.first()["k"] == "3"


def test_rate_documents_and_lookup(spark, tmp_root):
    doc = ('<Tarih_Date Tarih="02.01.2024"><Currency Kod="USD"><Isim>DOLAR</Isim>'
           '<ForexBuying>30.1</ForexBuying><ForexSelling>30.2</ForexSelling></Currency>'
           '<Currency Kod="XDR"><Isim>SDR</Isim><ForexBuying></ForexBuying><ForexSelling>1</ForexSelling></Currency>'
           '<Currency Kod="EUR"><Isim>EURO</Isim><ForexBuying>33</ForexBuying><ForexSelling>33.5</ForexSelling></Currency>'
           '</Tarih_Date>')
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.text(tmp_root + "/rates")
    r = read_rate_files(spark, tmp_root + "/rates")
    assert sorted(rows(r, "code", "buy", "sell")) == [("EUR", 33.0, 33.5), ("USD", 30.1, 30.2)]
    req = spark.createDataFrame([("usd", "2024-01-02"), ("usd", "2024-01-03"), ("zzz", "2024-01-02")],
                                "code string, d string").withColumn("rate_date", F.to_date("d"))
    wrapped = "<Kurlar>" + doc + "\n" + doc.replace("02.01.2024", "03.01.2024") + "</Kurlar>"
    spark.createDataFrame([(wrapped,)], "value string").coalesce(1).write.text(tmp_root + "/wrapped")
    both = read_rate_files(spark, tmp_root + "/wrapped")
    assert sorted(str(d) for d, in rows(both.select("rate_date").distinct())) == ["2024-01-02", "2024-01-03"]
    out = lookup_rates(req, r, max_broadcast_rows=0)   # forces the non-broadcast path
    assert sorted(rows(out, "code", "d", "buy"), key=repr) == sorted(
        [("usd", "2024-01-02", 30.1), ("usd", "2024-01-03", None), ("zzz", "2024-01-02", None)], key=repr)


def test_federated_request_rules(spark, tmp_root):
    ds = {"lake": {"nation": f"SELECT * FROM parquet.`{SF001}/nation.parquet`",
                   "region": f"SELECT * FROM parquet.`{SF001}/region.parquet`"}}
    q = "SELECT r_name, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name"
    with pytest.raises(KeyError):
        federated_query(spark, ExportRequest(ds, q))
    out = federated_query(spark, ExportRequest(ds, q), configured={"lake": "spark"})
    assert sum(r["n"] for r in out.collect()) == 25
    dup = {"a": {"nation": "SELECT 1"}, "b": {"NATION": "SELECT 2"}}
    with pytest.raises(ValueError, match="twice"):
        federated_query(spark, ExportRequest(dup, "SELECT 1", {"a": "spark", "b": "spark"}))
    path = federated_export(spark, ExportRequest(ds, q, {"lake": "spark"}), tmp_root + "/fed")
    assert spark.read.parquet(path).count() == 5
    n = spark.read.parquet(f"{SF001}/nation.parquet")
    assert frame_sql(n, "SELECT count(*) AS c FROM {frame}").first()["c"] == 25


def test_driver_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["id", "bal", "hist_id", "op"]
    assert df.count() > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


def test_federated_requests_are_isolated(spark):
    ds = {"lake": {"zz_nation": f"SELECT * FROM parquet.`{SF001}/nation.parquet`"}}
    out = federated_query(spark, ExportRequest(ds, "SELECT count(*) AS n FROM zz_nation", {"lake": "spark"}))
    assert out.first()["n"] == 25
    assert not spark.catalog.tableExists("zz_nation")


def test_table_reader_falls_back_to_parquet_and_sql_literals(spark, tmp_root):
    import datetime as dt
    from tidemark.sources.files import read_table
    from tidemark.sources.jdbc import sql_literal
    spark.range(3).write.parquet(tmp_root + "/t")
    assert read_table(spark, tmp_root + "/t", columns=["id"]).count() == 3
    assert sql_literal(dt.datetime(2024, 1, 2, 3, 4, 5)) == "'2024-01-02 03:04:05.000000'"
    assert sql_literal(dt.date(2024, 1, 2)) == "'2024-01-02'"
    assert sql_literal(None) == "NULL" and sql_literal(5) == "5"


def test_row_capped_export_files(spark, tmp_root):
    import pyarrow.parquet as pq
    from tidemark.sinks.fs import HadoopFS
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    path = export_parquet(o.coalesce(1), tmp_root + "/capped", max_records_per_file=100)
    names = [n for n in HadoopFS(spark).list_names(path) if n.endswith(".parquet")]
    assert len(names) >= o.count() // 100
    local = path.replace("file:", "")
    assert max(pq.ParquetFile(f"{local}/{n}").metadata.num_rows for n in names) <= 100
