"""The queries of this subpackage and their SQL, as __spark_entry__ registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, curve_search, exact_topk, html_text, language_id, masked_lm, merkle, mixing, near_duplicates, quality, reversed_search, token_counts, toxicity
from .common import in_training, table


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op2_curve_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_search.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return masked_lm.score(docs, *masked_lm.learn(docs))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.link_groups(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.learn(docs)).select("doc_id", (~in_training()).alias("held_out"), "lang_pred", "score")


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, *toxicity.learn(docs, table(spark, sf_dir, "labels"))).select("doc_id", (~in_training()).alias("held_out"), "score", "predicted")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.rate(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reversed_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_text": op1_html_text,
    "op2_curve_search": op2_curve_search,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_masked_lm": op4_masked_lm,
    "op5_token_counts": op5_token_counts,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_language_id": op7_language_id,
    "op8_exact_topk": op8_exact_topk,
    "op9_mixing": op9_mixing,
    "op10_toxicity": op10_toxicity,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_quality_rules": op12_quality_rules,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL: dict[str, str] = {"op6_ngram_jaccard": near_duplicates.SQL, "op8_exact_topk": exact_topk.SQL, "op9_mixing": mixing.SQL, "op11_merkle_manifest": merkle.SQL, "op13_lexical_search": reversed_search.SQL}
