"""Registered queries of the training-data operators: one ``opN_<name>`` each,
over its whole table with production parameters, with oracle SQL where SQL
can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_path
from . import (bpe, chat, decontaminate, language_id, lexical_search, line_dedup, lm, ngram_join, pii, prefix_trie,
               quality_classifier, quality_rules, sharding)

BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
CHAT_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _fold(doc_id: Column) -> Column:
    """CRC-32 of the id as text, modulo 5 (null for a null id)."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(5))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.table(_table(spark, sf_dir, "documents"))


def _held_out(remainder: int) -> Column:
    return F.coalesce(_fold(F.col("doc_id")) == remainder, F.lit(False)).alias("held_out")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_classifier.classify(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"),
        training=lambda doc_id: _fold(doc_id).isin(1, 2, 3), calibration=lambda doc_id: _fold(doc_id) == 4)
    return out.select("doc_id", _held_out(0), "score", "predicted")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = language_id.identify(_table(spark, sf_dir, "documents"), training=lambda doc_id: _fold(doc_id) != 0)
    return out.select("doc_id", _held_out(0), "lang_pred", "score")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(_table(spark, sf_dir, "documents"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.table(_table(spark, sf_dir, "conversations"), CHAT_TOKENIZER)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(_table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(_table(spark, sf_dir, "documents"), BPE_RANKS, public_tokenizers.PATTERN)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(_table(spark, sf_dir, "documents"))


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score(_table(spark, sf_dir, "documents"), training=lambda doc_id: _fold(doc_id) != 1)
    return scored.select("doc_id", _held_out(1), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.table(_table(spark, sf_dir, "conversations"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_sharding": op1_sharding,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_ngram_join": op3_ngram_join,
    "op4_chat": op4_chat,
    "op5_language_id": op5_language_id,
    "op6_quality_rules": op6_quality_rules,
    "op7_bpe": op7_bpe,
    "op8_decontaminate": op8_decontaminate,
    "op9_pii": op9_pii,
    "op10_lm": op10_lm,
    "op11_lexical_search": op11_lexical_search,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_line_dedup": op13_line_dedup,
}

ORACLES: dict[str, str] = {
    "op1_sharding": sharding.ORACLE_SQL,
    "op4_chat": chat.ORACLE_SQL,
    "op6_quality_rules": quality_rules.ORACLE_SQL,
    "op8_decontaminate": decontaminate.ORACLE_SQL,
    "op11_lexical_search": lexical_search.ORACLE_SQL,
    "op12_prefix_trie": prefix_trie.ORACLE_SQL,
    "op13_line_dedup": line_dedup.ORACLE_SQL,
}
