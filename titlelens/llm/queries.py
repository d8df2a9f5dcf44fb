"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from titlelens.llm import (balltree, conversations, decontaminate, htmltext, licenses, mixing,
                           ngram_join, quality, spelling, tokenbinary, tokencounts, toxicity,
                           urlrules)
from titlelens.plans.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_bpe() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def piece_bpe() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    tokenbinary.write_tokens(_table(spark, sf_dir, "documents"), path, byte_bpe())
    return tokenbinary.read_tokens(spark, path)


def _decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"),
                                       _table(spark, sf_dir, "benchmark"))


def _ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(_table(spark, sf_dir, "documents")).drop("text_key")


def _mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def _license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def _exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.top_k(_table(spark, sf_dir, "embeddings"))


def _url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judge(_table(spark, sf_dir, "pages"))


def _quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def _html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(_table(spark, sf_dir, "pages"))


def _conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damaged(_table(spark, sf_dir, "conversations"))
    return conversations.repair_report(rows, "present")


def _spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.spoilt_words(_table(spark, sf_dir, "documents")))


def _token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.count_tokens(_table(spark, sf_dir, "documents"), piece_bpe())


QUERIES: dict[str, Query] = {
    "op1_token_binary": _token_binary,
    "op2_license_scan": _license_scan,
    "op3_toxicity": _toxicity,
    "op4_decontaminate": _decontaminate,
    "op5_exact_topk": _exact_topk,
    "op6_ngram_jaccard": _ngram_jaccard,
    "op7_url_filter": _url_filter,
    "op8_mix_sources": _mix,
    "op9_quality_crf": _quality_crf,
    "op10_html_text": _html_text,
    "op11_conversation_repair": _conversation_repair,
    "op12_spelling_variants": _spelling_variants,
    "op13_token_counts": _token_counts,
}
