"""tidemark: keep analytical Parquet copies of relational tables in step with their
sources, and export queries that span several datasets, on Spark.

Pure operators (``DataFrame -> DataFrame``) live in ``operators``/``functions``;
reading and writing live in ``sources``/``sinks``; jobs that combine them with a
versioned store live in ``plans``; the micro-batch form lives in ``streaming``.
"""

__version__ = "0.1.0"
