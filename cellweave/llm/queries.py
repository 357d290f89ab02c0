"""Registered queries of the operators in this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cellweave.session import table


def _tokenizer(name: str) -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellweave.llm import op1_bpe as op

    return op.round_trip(table(spark, sf_dir, "documents"), *_tokenizer("byte_bpe_multi_50k.tiktoken"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellweave.llm import op6_counts as op

    return op.counts(table(spark, sf_dir, "documents"), *_tokenizer("byte_bpe_50k.json"))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellweave.llm import op2_jaccard as op

    return op.components(table(spark, sf_dir, "documents"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellweave.llm import op3_licenses as op

    return op.scan(table(spark, sf_dir, "documents"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellweave.llm import op4_merkle as op

    return op.neighbours_compared(table(spark, sf_dir, "documents"))


def op5_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellweave.llm import op5_ppm as op

    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")  # packed units pass through Python whole
    return op.score(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellweave.llm import op7_shards as op

    return op.shard(table(spark, sf_dir, "documents"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellweave.llm import op8_repeats as op

    return op.removed(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellweave.llm import op9_quality as op

    return op.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellweave.llm import op10_tiling as op

    return op.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellweave.llm import op11_near as op

    return op.score(table(spark, sf_dir, "embeddings"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellweave.llm import op12_repair as op

    return op.repair(table(spark, sf_dir, "conversations"))


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellweave.llm import op13_align as op

    return op.score(table(spark, sf_dir, "documents"), *_tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model")[0])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_jaccard": op2_jaccard,
    "op3_licenses": op3_licenses,
    "op4_fingerprints": op4_fingerprints,
    "op5_ppm": op5_ppm,
    "op6_token_counts": op6_token_counts,
    "op7_sharding": op7_sharding,
    "op8_repeats": op8_repeats,
    "op9_quality": op9_quality,
    "op10_decontamination": op10_decontamination,
    "op11_near_embeddings": op11_near_embeddings,
    "op12_repair": op12_repair,
    "op13_align": op13_align,
}
SQL: dict[str, str] = {}
