"""Corpus pipeline: raw documents to token ids, in five written stages.

Every stage is ``(spark, docs, sf_dir) -> DataFrame`` over all rows that its
predecessor kept; ``run`` writes each result as Parquet in the shared work folder and
rereads it as the next stage's input, so a lost executor costs at most one stage.
All stages but the last return the columns of ``documents``:

1. quality: rejected documents go, boilerplate lines leave the texts;
2. near_duplicates: one document of each class stays (the smallest doc_id);
3. decontamination: documents that share a window with the benchmark go;
4. pii: spans are replaced by their kind, n_chars follows the text;
5. tokens: doc_id, n_tokens and the token ids.

No SQL oracle: stages 2, 4 and 5 have no SQL form (see tests/llm/test_corpus_pipeline.py).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from occurlens.llm import bpe, decontaminate, ngram_join, pii, quality_rules
from occurlens.llm.common import written
from occurlens.llm.queries import BPE_RANKS
from occurlens.session import table_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(table_path(sf_dir, "benchmark")))


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def tokenization(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.tokens(docs, BPE_RANKS, public_tokenizers.PATTERN)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("pii", redaction), ("tokens", tokenization)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
