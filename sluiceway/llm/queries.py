"""The corpus operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm import chat_format, collocations, decontamination, embedding_links, filter_audit, html_text, jaccard_join, language, licenses, mixing, sharding, substring_dedup, toxicity
from sluiceway.llm.common import cut, table
from sluiceway.llm.oracle import LLM_ORACLE  # noqa: F401

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    LLM_QUERIES[run.__name__] = run
    return run


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    hit = decontamination.words_hit(F.col("spans"))
    return found.select("doc_id", F.col("n_words").cast("long").alias("n_words"), hit.alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _fold(n: int):
    return F.crc32(F.col("doc_id").cast("string")) % n


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    return toxicity.score_toxicity(docs, model).select("doc_id", (_fold(5) == 0).alias("held_out"), "score", "predicted")


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.training_texts(docs))
    return found.select("doc_id", (_fold(3) == 1).alias("held_out"), "lang_pred", "score")


@query
def op6_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links.embedding_links(table(spark, sf_dir, "embeddings"))


@query
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("text_id")


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.hilbert_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages, html_text.trained()).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents")).drop("text_id")


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    pieces = cut(chat_format.format_chat(given.unionByName(chat_format.probe(spark))), "chat-formatted")
    return chat_format.read_back(pieces)


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_collocations(table(spark, sf_dir, "documents").select("lang", "text"))
