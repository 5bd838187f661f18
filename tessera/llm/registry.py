"""Queries and oracle SQL of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import line_dedup as lines
from tessera.llm import merkle, personal_data, ranked_search
from tessera.llm import quality_rules as rules
from tessera.llm.byte_cnn import quality_scores
from tessera.llm.common import table
from tessera.llm.gif_media import stored_and_read
from tessera.llm.jaccard_join import jaccard_groups
from tessera.llm.packing import pack
from tessera.llm.piece_codec import piece_digests
from tessera.llm.substring_dedup import substring_dedup
from tessera.llm.token_store import read_tokens, write_tokens
from tessera.llm.toxicity import toxicity_scores


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed_lines")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_tokens(write_tokens(table(spark, sf_dir, "documents")))


def op4_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_and_read(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents")).drop("clean_text")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "removed")


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_token_store": op3_token_store,
    "op4_gif_media": op4_gif_media,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_packing": op6_packing,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_quality_rules": op8_quality_rules,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_personal_data": personal_data.op11_personal_data,
    "op12_ranked_search": ranked_search.op12_ranked_search,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": lines.ORACLE_SQL,
    "op8_quality_rules": rules.ORACLE_SQL,
    "op12_ranked_search": ranked_search.ORACLE_SQL,
    "op13_merkle_manifest": merkle.ORACLE_SQL,
}
