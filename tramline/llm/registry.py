"""Queries of this subpackage, with production parameters over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.llm import ann, exact_dedup, licences, lm, ngram_join, packing, pieces, pii, substring_dedup, toxicity
from tramline.llm.shared import documents


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(documents(spark, sf_dir))


def op2_licence_scan(spark, sf_dir):
    return licences.scan_licences(documents(spark, sf_dir))


def op3_lm_scoring(spark, sf_dir):
    return lm.score_documents(documents(spark, sf_dir), F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


def op4_packing(spark, sf_dir):
    return packing.digest(packing.pack(documents(spark, sf_dir), tokenizer("word_bpe_49k.json")))


def op5_nearest_neighbours(spark, sf_dir):
    return ann.nearest_neighbours(_table(spark, sf_dir, "embeddings"))


def op6_exact_dedup(spark, sf_dir):
    return exact_dedup.digest(exact_dedup.exact_dedup(documents(spark, sf_dir)))


def op7_pii(spark, sf_dir):
    return pii.digest(pii.find_personal_data(documents(spark, sf_dir)))


def op8_toxicity(spark, sf_dir):
    return toxicity.score_toxicity(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op9_piece_coding(spark, sf_dir):
    model = tokenizer("piece_bpe_32k.model")
    return pieces.digest(pieces.decode(pieces.encode(documents(spark, sf_dir), model), model))


def op10_substring_dedup(spark, sf_dir):
    return substring_dedup.digest(substring_dedup.without_repeats(documents(spark, sf_dir)))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_licence_scan": op2_licence_scan,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_packing": op4_packing,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_pii": op7_pii,
    "op8_toxicity": op8_toxicity,
    "op9_piece_coding": op9_piece_coding,
    "op10_substring_dedup": op10_substring_dedup,
}

ORACLES = {
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op10_substring_dedup": substring_dedup.ORACLE,
}
