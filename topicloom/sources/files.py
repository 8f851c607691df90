"""Line and delimited text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.functions.text import split_java

CORPUS_MIN_LEN = 100

# The columns of the class dictionary file.
DICTIONARY_FIELDS = [
    ("word", "string"),
    ("f_id", "int"),
    ("s_id", "int"),
    ("t_id", "int"),
    ("dict_id", "int"),
    ("f_name", "string"),
    ("s_name", "string"),
    ("t_name", "string"),
    ("dict_name", "string"),
]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line): one row per line, cut at line feeds only. Files are split, not read whole.

    Paths go through the default file system, like all others; a local file needs ``file://``."""
    return spark.read.option("lineSep", "\n").text(path).withColumnRenamed("value", "line")


def load_delimited(spark: SparkSession, path: str, sep: str, fields: Sequence[str]) -> DataFrame:
    """String columns from lines with exactly as many fields; ``sep`` is a regex.

    Trailing empty fields do not count, so a line with an empty last field is left out."""
    parts = read_lines(spark, path).select(split_java("line", sep).alias("p")).where(F.size("p") == len(fields))
    return parts.select(*[F.col("p")[i].alias(name) for i, name in enumerate(fields)])


def load_typed_csv(
    spark: SparkSession, path: str, fields: Sequence[tuple[str, str]] = tuple(DICTIONARY_FIELDS), strict: bool = True
) -> DataFrame:
    """Comma lines with exactly the given typed fields. A number that cannot be read is an error,
    or null when not ``strict``."""
    parts = read_lines(spark, path).select(split_java("line", ",").alias("p")).where(F.size("p") == len(fields))
    cells = [(F.col("p")[i], name, kind) for i, (name, kind) in enumerate(fields)]
    return parts.select(*[(c.cast(kind) if strict else c.try_cast(kind)).alias(name) for c, name, kind in cells])


def load_corpus(spark: SparkSession, path: str, prefix: str, min_len: int = CORPUS_MIN_LEN) -> DataFrame:
    """(id, msg) of lines longer than ``min_len``; the id is ``prefix`` and a unique number, which
    follows from the place of the line in the file splits."""
    lines = read_lines(spark, path).where(F.length("line") > min_len)
    number = F.monotonically_increasing_id().cast("string")
    return lines.select(F.concat(F.lit(prefix), number).alias("id"), F.col("line").alias("msg"))


def load_words(spark: SparkSession, path: str) -> DataFrame:
    """(word): one word per line."""
    return read_lines(spark, path).withColumnRenamed("line", "word")


def load_class_hierarchy(spark: SparkSession, id2label: str, classes: str) -> DataFrame:
    """(id, name) with name = parent label - child label.

    ``id2label`` lines hold exactly ``id,label``; ``classes`` lines ``parent,child[,..]``. A class
    whose labels are missing is an error."""

    def fields(path: str) -> DataFrame:
        return read_lines(spark, path).select(split_java(F.trim("line"), ",").alias("p"))

    labels = fields(id2label).where(F.size("p") == 2).select(F.col("p")[0].cast("int").alias("id"), F.col("p")[1].alias("label"))
    labels = labels.groupBy("id").agg(F.min("label").alias("label"))
    pairs = fields(classes).where(F.size("p") > 1).select(F.col("p")[0].cast("int").alias("parent"), F.col("p")[1].cast("int").alias("child"))
    upper = labels.select(F.col("id").alias("parent"), F.col("label").alias("upper"))
    lower = labels.select(F.col("id").alias("child"), F.col("label").alias("lower"))
    named = pairs.join(upper, "parent", "left").join(lower, "child", "left")
    unknown = F.raise_error(F.concat(F.lit("no label for class "), F.col("child").cast("string"))).cast("string")
    name = F.when(F.col("upper").isNotNull() & F.col("lower").isNotNull(), F.concat_ws("-", "upper", "lower")).otherwise(unknown)
    return named.select(F.col("child").alias("id"), name.alias("name")).groupBy("id").agg(F.min("name").alias("name"))
