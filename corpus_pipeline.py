"""The corpus pipeline: quality, near duplicates, repeats, leaks, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is
written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm import op1_bpe, op2_jaccard, op8_repeats, op9_quality, op10_tiling
from cellweave.session import cut, table


def lean(spark: SparkSession) -> None:
    """Small batches between Spark and its Python workers: whole rows of documents pass through them."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    lean(spark)
    return op9_quality.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    lean(spark)
    return op2_jaccard.keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the repeated passages of over 50 words."""
    lean(spark)
    return op8_repeats.strip(docs, words=51).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    lean(spark)
    return op10_tiling.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, ids_sha256, decoded_sha256."""
    import public_tokenizers

    lean(spark)
    return op1_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True, small=True)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeats", repeats), ("leaks", leaks), ("tokens", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
