"""Queries of this folder, one per operator; their SQL is in :mod:`topicloom.llm.checks`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm import chat, quality_model, secrets
from topicloom.llm import decontaminate as wu_manber
from topicloom.llm.divergence import audit
from topicloom.llm.checks import SQL
from topicloom.llm.html_text import extract_text
from topicloom.llm.mixing import mix_sources
from topicloom.llm.ngram_join import ngram_join
from topicloom.llm.quality_rules import quality_rules
from topicloom.llm.substring_dedup import dedup_substrings
from topicloom.llm.url_filter import filter_urls
from topicloom.llm.warc import archive_round_trip
from topicloom.llm.whitening import whiten


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join(_table(spark, sf, "documents"))


def op2_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    return quality_model.score(docs, quality_model.fit(docs, _table(spark, sf, "labels")))


def op3_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules(_table(spark, sf, "documents"))


def op4_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return extract_text(_table(spark, sf, "pages"))


def op5_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    spans = F.col("secrets")
    return secrets.scan(_table(spark, sf, "documents").select("doc_id", "text")).select(
        "doc_id",
        secrets.of_kind(spans, "assign").alias("n_assign"),
        secrets.of_kind(spans, "access").alias("n_access"),
        secrets.of_kind(spans, "hex").alias("n_hex"),
        F.sha2(secrets.joined(secrets.base_only(spans)), 256).alias("base_sha256"),
        secrets.joined(spans).alias("spans"),
    )


def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = wu_manber.decontaminate(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))
    n_hit = wu_manber.hit_words("hits")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        wu_manber.items_digest("items").alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op7_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_substrings(_table(spark, sf, "documents"))


def op8_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mix_sources(_table(spark, sf, "documents"))


def op9_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return filter_urls(_table(spark, sf, "pages")).drop("bin")


def op10_warc(spark: SparkSession, sf: str) -> DataFrame:
    return archive_round_trip(_table(spark, sf, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    conversations = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(
        [(chat.PLANTED_CONVERSATION, 0, "user", chat.PLANTED_TEXT), (chat.PLANTED_CONVERSATION, 1, "assistant", chat.PLANTED_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    return chat.format_chats(spark, chat.turn_events(conversations.unionByName(planted)))


def op12_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return audit(_table(spark, sf, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whiten(_table(spark, sf, "embeddings").select("vec_id", "embedding")).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    )


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_quality_rules": op3_quality_rules,
    "op4_html_text": op4_html_text,
    "op5_secret_scan": op5_secret_scan,
    "op6_decontamination": op6_decontamination,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_mixing": op8_mixing,
    "op9_url_filter": op9_url_filter,
    "op10_warc": op10_warc,
    "op11_chat_format": op11_chat_format,
    "op12_source_divergence": op12_source_divergence,
    "op13_embedding_whitening": op13_embedding_whitening,
}

__all__ = ["QUERIES", "SQL"]
