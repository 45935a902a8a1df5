"""From raw documents to token ids: quality rules, line and near-duplicate removal, decontamination, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwise.functions.scale import stage
from tillwise.llm import decontamination, line_dedup, near_dedup, quality_rules, sentencepiece_codec
from tillwise.llm.common import prepare, table
from tillwise.llm.queries import TOKENIZER


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality_rules.quality_stage(docs)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return line_dedup.line_dedup_stage(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_dedup.near_dedup_stage(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate_stage(docs, table(spark, sf_dir, "benchmark"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return sentencepiece_codec.encode_stage(docs, TOKENIZER)


STAGES = [
    ("quality_rules", keep_quality),
    ("line_dedup", drop_common_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("sentencepiece", to_tokens),
]

# The last stage runs a tokenizer, which SQL does not have; the stages before it are tested against
# brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
