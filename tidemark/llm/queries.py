"""Registered queries: each operator with production parameters on its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, table
from tidemark.llm.oracles import DECONTAMINATION, MERKLE_MANIFEST, NEAR_VECTORS, RANKED_SEARCH

#: byte_bpe_50k.json: 50,257 ids with the special one
TOKENIZER, VOCABULARY = "byte_bpe_50k.json", 50_257


def op1_sharding(spark: SparkSession, d: str) -> DataFrame:
    """Uniform shuffle of all documents into shards 0..39 whose row counts are at most one apart."""
    from tidemark.llm.sharding import shuffle_to_shards
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = table(spark, d, "documents", "doc_id", "text").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shuffle_to_shards(rows, 40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op2_mixing(spark: SparkSession, d: str) -> DataFrame:
    """Sources mixed to weights 5, 2, 1 with at most three passes over a source."""
    from tidemark.llm.mixing import mix_plan
    return mix_plan(table(spark, d, "documents", "doc_id", "text", "source"))


def op3_token_output(spark: SparkSession, d: str) -> DataFrame:
    """All texts as packed token ids; rows come from the files that were written."""
    import public_tokenizers

    from tidemark.llm.binpack import tokenize_to_files
    return tokenize_to_files(table(spark, d, "documents", "doc_id", "text"), public_tokenizers.path(TOKENIZER), VOCABULARY)


def op4_decontamination(spark: SparkSession, d: str) -> DataFrame:
    """Words of documents inside ten-word windows of benchmark items."""
    from tidemark.llm.decontam import contamination
    return contamination(table(spark, d, "documents", "doc_id", "text"), table(spark, d, "benchmark", "item_id", "text"))


def op5_toxicity(spark: SparkSession, d: str) -> DataFrame:
    """Toxicity of all documents, learnt from confirmed and unlabelled texts."""
    from tidemark.llm.toxicity import toxicity
    return toxicity(table(spark, d, "documents", "doc_id", "text"), table(spark, d, "labels", "doc_id", "toxic"))


def op6_license_scan(spark: SparkSession, d: str) -> DataFrame:
    """Licence phrases and expressions of all documents."""
    from tidemark.llm.licenses import license_scan
    return license_scan(table(spark, d, "documents", "doc_id", "text"))


def op7_near_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.95."""
    from tidemark.llm.vectors import near_vectors
    return near_vectors(table(spark, d, "embeddings", "vec_id", "embedding"))


def op8_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    """Classes, links and components of all documents at Jaccard 0.8 over five-word shingles."""
    from tidemark.llm.ngram_join import ngram_join
    return ngram_join(table(spark, d, "documents", "doc_id", "text"))


def op9_pii(spark: SparkSession, d: str) -> DataFrame:
    """Personal data in all documents: checked patterns, and what the tagger adds."""
    from tidemark.llm.pii import pii_digest
    return pii_digest(table(spark, d, "documents", "doc_id", "text"))


def op10_language_id(spark: SparkSession, d: str) -> DataFrame:
    """Language of all documents by hyperdimensional profiles."""
    from tidemark.llm.langid import identify
    return identify(table(spark, d, "documents", "doc_id", "text", "lang"))


def op11_packing(spark: SparkSession, d: str) -> DataFrame:
    """All documents as sequences of power-of-two lengths up to 1024."""
    import public_tokenizers

    from tidemark.llm.packing import pack_sequences
    rows = pack_sequences(table(spark, d, "documents", "doc_id", "text"), public_tokenizers.path(TOKENIZER))
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                       F.lit(0).cast("long").alias("offset"), "bucket", "batch")


def op12_ranked_search(spark: SparkSession, d: str) -> DataFrame:
    """The 50 best documents for each benchmark item, over all documents."""
    from tidemark.llm.ranked import ranked_search
    return ranked_search(table(spark, d, "documents", "doc_id", "text"), table(spark, d, "benchmark", "item_id", "text"))


def op13_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Merkle manifest of all documents by language, with a proof of each."""
    from tidemark.llm.merkle import merkle_digest
    return merkle_digest(table(spark, d, "documents", "doc_id", "source", "lang", "n_chars", "text"))


def _bounded(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, d: str) -> DataFrame:
        bounded_batches(spark)
        return query(spark, d)
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _bounded(f) for f in (op1_sharding, op2_mixing, op3_token_output, op4_decontamination, op5_toxicity, op6_license_scan,
                            op7_near_vectors, op8_ngram_join, op9_pii, op10_language_id,
                            op11_packing, op12_ranked_search, op13_merkle_manifest)}
ORACLES: dict[str, str] = {
    "op4_decontamination": DECONTAMINATION, "op7_near_vectors": NEAR_VECTORS,
    "op12_ranked_search": RANKED_SEARCH, "op13_merkle_manifest": MERKLE_MANIFEST}
