"""The training-data pipeline: stages over ``documents``, each on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from topicloom.llm import stages
from topicloom.session import scratch_path

STAGES = [
    ("quality rules", stages.quality),
    ("n-gram Jaccard join", stages.distinct_texts),
    ("benchmark decontamination", stages.decontaminated),
    ("secret scans", stages.without_secrets),
    ("mixing sources", stages.mixed),
]

# Compression ratios, links found by set similarity and seeded draws are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = scratch_path(spark, "pipeline")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
