"""From documents to token files: five stages, each over what the one before kept.

Toxic documents go, one document of each group of near duplicates stays, documents
with benchmark passages go, the sources are mixed to their target weights, and the
result is written as token ids and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillflow.llm import decontaminate, mixing, ngram_join, token_store, toxicity
from tillflow.llm.queries import table, tokenizer_path
from tillflow.llm.shared import written


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def reject_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def reject_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document of the token store."""
    root = token_store.write_store(docs, tokenizer_path("byte_bpe_50k.json"))
    return token_store.read_store(spark, root)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", reject_near_duplicates),
    ("decontamination", reject_benchmark_leaks),
    ("mixing", mix_sources),
    ("token_ids", write_tokens),
]

# The trained classifier and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written before the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
