"""The corpus pipeline: languages, exact copies, near copies, benchmark passages, tokens.

Every stage takes the documents that the one before it kept and returns documents, except the last, which returns ids.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sightline.llm import byte_bpe, decontaminate, exact_dedup, language_id, parity_join
from sightline.llm.common import settle, table

TOKENIZER, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
#: Bytes of rows that travel to a Python worker at once: Spark, the worker and their buffers each hold such a batch.
BATCH_BYTES = 2 << 20


def small_batches(spark: SparkSession) -> None:
    """Batches bounded by bytes for the session: Spark's own bound of 10,000 rows is 30 MB of ordinary documents, and any size of long ones."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier does not reject."""
    small_batches(spark)
    return language_id.drop_rejected(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each connected group of similar ones."""
    small_batches(spark)
    return parity_join.drop_near(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    small_batches(spark)
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``lang``, ``source``, token ``ids``, ``n_tokens``, and whether the ids decode to the text."""
    small_batches(spark)
    rows = docs.select("doc_id", "lang", "source", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    both = byte_bpe.encode(rows, TOKENIZER, PATTERN, decoded="decoded")
    same = F.xxhash64(F.col("decoded").cast("string")) == F.col("text_hash")
    return both.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), same.alias("decodes"))


STAGES = [("language_id", known_language), ("exact_dedup", exact_copies), ("ngram_jaccard", near_copies),
          ("decontamination", clean_of_benchmark), ("byte_bpe", tokens)]
#: Centroids and sketches have no SQL form; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written as a table and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
