"""Word embedding tables on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_embeddings(vectors: DataFrame, path: str) -> None:
    """Write (word, vec) as Parquet (word, vector array<float>) next to its size and count."""
    vectors.select("word", F.col("vec").cast("array<float>").alias("vector")).write.mode("overwrite").parquet(f"{path}/data")
    written = vectors.sparkSession.read.parquet(f"{path}/data")
    facts = written.agg(F.max(F.size("vector")).alias("vector_size"), F.count("*").alias("num_words"))
    facts.write.mode("overwrite").json(f"{path}/metadata")


def load_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """(word, vec) as written; a table of another size or count is an error."""
    expected = spark.read.schema("vector_size int, num_words bigint").json(f"{path}/metadata").first()
    data = spark.read.schema("word string, vector array<float>").parquet(f"{path}/data")
    found = data.agg(F.min(F.size("vector")), F.max(F.size("vector")), F.count("*")).first()
    if found[0] != expected.vector_size or found[1] != expected.vector_size:
        raise ValueError(f"expected vectors of size {expected.vector_size}, got {found[0]} to {found[1]}")
    if found[2] != expected.num_words:
        raise ValueError(f"expected {expected.num_words} words, got {found[2]}")
    return data.select("word", F.col("vector").cast("array<double>").alias("vec"))
