"""The corpus pipeline: toxic documents go, then copies, then near copies; personal data is taken out; the rest is packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tramline.llm import exact_dedup, ngram_join, packing, pii, toxicity
from tramline.llm.registry import tokenizer
from tramline.llm.shared import documents, folders_made, release, staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon learnt from `labels` does not reject."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the smallest doc_id."""
    return exact_dedup.one_of_each(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-gram similarity of 0.8 or more: the smallest doc_id."""
    return ngram_join.one_of_each(docs)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and the terms that reveal it replaced."""
    return pii.sanitised(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 tokens, with their ids."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("PII", remove_personal_data),
    ("packing", pack),
]

#: SQL cannot express the learnt lexicon, the components and the packing; tests hold stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again as the next one's input.

    What a stage has left in the shared folder is removed once its result is written.
    """
    docs, before = documents(spark, sf_dir), folders_made()
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
        release(spark, before, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
