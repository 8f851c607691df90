"""Stages of the pipeline: each takes (spark, docs, sf_dir) and returns what goes on.

All but the last return the columns of ``documents``; extra columns are left out. Rows whose id is
null stay through every filter that their text passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm import secrets
from topicloom.llm.decontaminate import decontaminate
from topicloom.llm.mixing import mix_sources
from topicloom.llm.ngram_join import distinct_documents
from topicloom.llm.quality_rules import quality_rules

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie inside the compression bands."""
    return quality_rules(docs, carry=COLUMNS).where("kept").select(COLUMNS)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least id, once; rows without an id stay.
    Texts that share an id and do not link are different documents."""
    return distinct_documents(docs.select(COLUMNS))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=COLUMNS)
    return found.where("size(items) = 0").select(COLUMNS)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by ``[secret]``; ``n_chars`` follows the text."""
    found = secrets.scan(docs.select(COLUMNS))
    text = F.when(F.size("secrets") > 0, secrets.redacted(F.col("text"), F.col("secrets"))).otherwise(F.col("text"))
    n_chars = F.when(F.size("secrets") > 0, F.length("_text").cast("bigint")).otherwise(F.col("n_chars"))
    return found.withColumn("_text", text).withColumn("n_chars", n_chars).withColumn("text", F.col("_text")).select(COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document go into the mix."""
    return mix_sources(docs)
