"""Readers: Parquet and other file formats, JDBC, rate documents."""
