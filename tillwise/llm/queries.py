"""The corpus operators as queries over the test tables, and the SQL twins of those that have one."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import (
    decontamination, katz_lm, language_id, licenses, line_dedup, near_dedup, packing, quality_rules, resampling,
    sentencepiece_codec, spelling, substring_dedup, warc,
)
from tillwise.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = os.environ.get("TOKENIZER_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
WORD_TOKENIZER = os.environ.get("WORD_TOKENIZER_MODEL", "/opt/tokenizers/word_bpe_49k.json")


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    coded = sentencepiece_codec.encode(table(spark, folder, "documents"), TOKENIZER)
    return coded.select("row.doc_id", "ids", "n_tokens", "round_trip")


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.pages_through_archives(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"
    )


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return decontamination.verdicts(found).select(
        "row.doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    languages, model = language_id.train_text_model(table(spark, folder, "documents"))
    return language_id.identify(table(spark, folder, "pages"), languages, model)


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.apply_rules(table(spark, folder, "documents"))
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_bad"
    )


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = substring_dedup.remove_passages(table(spark, folder, "documents"))
    return cut.select(
        "row.doc_id", "spans", F.size("spans").cast("bigint").alias("n_spans"),
        F.char_length("kept_text").cast("bigint").alias("kept_chars"), F.sha2("kept_text", 256).alias("kept_sha256"),
    )


def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    cut = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return cut.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_katz_lm(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    return katz_lm.score(table(spark, folder, "documents"), held_out)


def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, folder, "documents")).select(
        "row.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "duty"
    )


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents"))


def op12_resampling(spark: SparkSession, folder: str) -> DataFrame:
    drawn = resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("row.doc_id", "n_features", "weight", "score", "rank")


def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), WORD_TOKENIZER).select(
        "row.doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


QUERIES: dict[str, Query] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_warc": op2_warc,
    "op3_decontamination": op3_decontamination,
    "op4_language_id": op4_language_id,
    "op5_quality_rules": op5_quality_rules,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_near_dedup": op7_near_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_katz_lm": op9_katz_lm,
    "op10_licenses": op10_licenses,
    "op11_spelling": op11_spelling,
    "op12_resampling": op12_resampling,
    "op13_packing": op13_packing,
}
