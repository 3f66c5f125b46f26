"""Pipeline from raw documents to packed token ids, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns
a DataFrame; between stages the documents are written as Parquet in the shared folder and
read again. All stages but the last return the columns of ``documents``.

Rows of ``run``: one per document copy in the mix, in the order of the written files:
doc_id, start, n_tokens, ids_crc32, part, block.

Defined results of all stages: null texts end at the first stage, so later ones see none,
though each takes them; equal rows are one document to the second stage and documents of their
own to the others; very long texts are worked on whole; an empty table gives an empty one;
other columns than those of ``documents``, whatever their names, are carried along up to the
last stage, which does not read them. Ties: languages by code point, near copies by least id
and text digest, mixing by hash, output by id and text hash.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.binpack import tokenize_to_files
from tidemark.llm.common import bounded_batches, stage, table
from tidemark.llm.decontam import remove_contamination
from tidemark.llm.langid import keep_identified
from tidemark.llm.mixing import mix_documents
from tidemark.llm.ngram_join import drop_near_copies
from tidemark.llm.queries import TOKENIZER, VOCABULARY


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language: null texts and those without letters go."""
    bounded_batches(spark)
    return keep_identified(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    bounded_batches(spark)
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly such passages go."""
    bounded_batches(spark)
    clean = remove_contamination(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    return clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    bounded_batches(spark)
    return mix_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids, read back from the files."""
    bounded_batches(spark)
    return tokenize_to_files(docs, public_tokenizers.path(TOKENIZER), VOCABULARY)


STAGES = [("language_id", language_id), ("ngram_join", near_copies), ("decontamination", decontamination),
          ("mixing", mixing), ("token_output", token_output)]

#: The first stage learns profiles, which SQL cannot express; tests hold all stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
