"""The corpus pipeline: five stages, each written and read again before the next.

language ID -> near-duplicate removal -> benchmark decontamination -> mixing to
target weights -> token output. Every stage works on all rows that the one
before has kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import decontamination, language, mixing, near_dedup, token_output
from tidewater.llm.common import written
from tidewater.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language can't be told go."""
    return language.with_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class stays."""
    return near_dedup.first_of_class(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a passage of the benchmark go."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row occurs as often as its rate says."""
    return mixing.mixed(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all rows, read back: their place, length and checksum."""
    return token_output.coded_corpus(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("source_mixing", mix_sources),
    ("token_output", token_ids),
]

#: Trained models, signatures and token ids are beyond SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
