"""The operators bound to the given tables, with production parameters and whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotape.llm import oracles
from chronotape.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronotape.llm.sharding import shard_documents

    return shard_documents(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronotape.llm.toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronotape.llm.mixing import mix_sources

    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronotape.llm.language_model import score_language

    return score_language(table(spark, sf_dir, "documents"))


def op5_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations read as tool traffic: a user's turn calls a tool and the assistant's next turn is its result.

    Short questions call ``lookup``, others ``write``; a third of the later questions also refer to the
    result of the question before, and some lack a required argument or give one of the wrong type.
    """
    from chronotape.llm.tool_calls import link_tool_calls

    messages = table(spark, sf_dir, "conversations")
    text = F.coalesce("text", F.lit(""))

    def call_id(turn):
        return F.concat_ws("-", F.lit("call"), F.col("conv_id"), turn)

    mark = F.crc32(text.cast("binary"))
    short = F.char_length(text) < 200
    before = F.when((mark % 3 == 0) & (F.col("turn") >= 2), F.struct(call_id(F.col("turn") - 2).alias("$ref")))
    lookup = F.to_json(F.struct(F.when(mark % 7 != 0, F.col("text")).alias("query"), (mark % 10).alias("limit"), before.alias("context")))
    write = F.to_json(F.struct(F.col("text").alias("prompt"), F.when(mark % 5 == 0, F.lit("long")).alias("words"), before.alias("context")))
    calls = messages.where("role = 'user'").select(
        "conv_id", "turn", call_id(F.col("turn")).alias("call_id"), F.when(short, "lookup").otherwise("write").alias("name"), F.when(short, lookup).otherwise(write).alias("arguments")
    )
    results = messages.where("role = 'assistant'").select("conv_id", "turn", call_id(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    schemas = spark.sql(
        "VALUES ('lookup', 'query', 'string', true), ('lookup', 'limit', 'integer', false), ('lookup', 'context', 'object', false),"
        " ('write', 'prompt', 'string', true), ('write', 'words', 'integer', false), ('write', 'context', 'object', false) AS t(name, param, type, required)"
    )
    return link_tool_calls(messages.where("coalesce(role NOT IN ('user', 'assistant'), true)"), calls, results, schemas)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronotape.llm.extraction import extract_text

    return extract_text(table(spark, sf_dir, "pages"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronotape.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronotape.llm.quality import judge_quality

    judged = judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronotape.llm.topk import exact_top_k

    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronotape.llm.near_duplicates import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronotape.llm.spelling import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled documents are no pages, so the URLs that the host rules decide are the labels to learn from."""
    from chronotape.llm.url_rules import judge_urls

    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op13_pivot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronotape.llm.pivot_clusters import cluster_vectors

    return cluster_vectors(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_sharding": op1_sharding,
    "op2_toxicity": op2_toxicity,
    "op3_source_mixing": op3_source_mixing,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_tool_call_linking": op5_tool_call_linking,
    "op6_html_extraction": op6_html_extraction,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_quality_rules": op8_quality_rules,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_url_filters": op12_url_filters,
    "op13_pivot_clusters": op13_pivot_clusters,
}
ORACLES: dict[str, str] = {
    "op9_exact_top_k": oracles.TOP_K,
    "op11_spelling_variants": oracles.SPELLING,
    "op12_url_filters": oracles.URLS,
    "op13_pivot_clusters": oracles.CLUSTERS,
}
