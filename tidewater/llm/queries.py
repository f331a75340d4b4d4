"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conversations, decontamination, exact_dedup, language, line_dedup, mixing, near_dedup, neighbours, quality, secrets, suffix_dedup, token_output, tokenizer_alignment


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents")).drop("spans")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.document_rates(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_boilerplate(_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.coded_corpus(_table(spark, sf_dir, "documents"), tokenizer_path())


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenizer_alignment.link_strengths(_table(spark, sf_dir, "documents"), tokenizer_path(), piece_model_path())


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired(conversations.damaged(_table(spark, sf_dir, "conversations")))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_source_mixing": op2_source_mixing,
    "op3_language_id": op3_language_id,
    "op4_near_dedup": op4_near_dedup,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_secret_scan": op6_secret_scan,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_line_dedup": op8_line_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_token_output": op10_token_output,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_exact_dedup": op13_exact_dedup,
}

ORACLES: dict[str, str] = {"op8_line_dedup": line_dedup.ORACLE_SQL, "op13_exact_dedup": exact_dedup.ORACLE_SQL}
