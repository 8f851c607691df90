"""Inputs of the query catalogue, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.functions.text import letter_runs
from topicloom.operators.segment import explode_tokens, segment
from topicloom.session import cut_lineage
from topicloom.sources.tables import spread

# A character table that folds accented letters, standing in for a table of
# traditional and simplified characters.
ACCENTS = {"é": "e", "è": "e", "ê": "e", "ç": "c", "ñ": "n", "ü": "u", "ö": "o", "ä": "a", "ó": "o", "í": "i", "á": "a"}


# One Han character for each letter from a to z, to build unspaced words from the texts.
HAN_LETTERS = "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏闰余"
HAN_MIN_FREQ = 5


def han(text: Column | str) -> Column:
    return F.translate(F.lower(text), "abcdefghijklmnopqrstuvwxyz", HAN_LETTERS)


def han_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    """The frequent plain words, spelled in Han characters; the other words fall into them."""
    known = lexicon(spark, sf).where((F.col("freq") >= HAN_MIN_FREQ) & F.col("word").rlike("^[a-z]+$"))
    return known.withColumn("word", han("word"))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf}/{name}.parquet"))


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("msg"), "lang", "source")


def docs(spark: SparkSession, sf: str) -> DataFrame:
    """(id, msg, words): the segmented corpus."""
    return segment(corpus(spark, sf).select("id", "msg"))


def tokens(spark: SparkSession, sf: str) -> DataFrame:
    return explode_tokens(docs(spark, sf))


def nature_rule(word: Column) -> Column:
    """A tag by word length, in place of a statistical tagger."""
    n = F.length(word)
    return F.when(n >= 6, "n").when(n == 5, "ns").when(n == 4, "nr").when(n == 3, "nx").otherwise("x")


def lexicon(spark: SparkSession, sf: str) -> DataFrame:
    """(word, nature, freq). Jobs read it as a stored table, so it is stored once here too."""
    counts = tokens(spark, sf).groupBy("word").agg(F.count("*").alias("freq"))
    return cut_lineage(counts.select("word", nature_rule(F.col("word")).alias("nature"), "freq"))


def tagged(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens with the tag their lexicon entry holds."""
    return tokens(spark, sf).withColumn("nature", nature_rule(F.col("word")))


def word_nature(spark: SparkSession, sf: str) -> DataFrame:
    from topicloom.operators.stats import word_nature_count

    return word_nature_count(tagged(spark, sf))


def rules(spark: SparkSession, sf: str) -> DataFrame:
    """Rule table: words whose length is a multiple of 7 are switched off."""
    words = tokens(spark, sf).select("word").distinct()
    return words.withColumn("use_flag", F.when(F.length("word") % 7 == 0, 0).otherwise(1))


def search_log(spark: SparkSession, sf: str) -> DataFrame:
    """(imei, key_word, turn) of all turns."""
    return table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("imei"), F.col("text").alias("key_word"), "turn")


def label_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """(word, label): the languages and sources of the documents a word occurs in."""
    words = segment(corpus(spark, sf)).select("lang", "source", F.explode_outer(F.array_distinct("words")).alias("word"))
    label = F.explode(F.array("lang", "source")).alias("label")
    return words.where(F.col("word").isNotNull()).select("word", label).distinct()


def tag_dictionary(spark: SparkSession, sf: str, words: DataFrame | None = None) -> DataFrame:
    """(word, taglayer): each noun under its first letter and its first two letters.

    ``words`` is the lexicon, where the caller has it stored already."""
    w = F.col("word")
    path = F.concat_ws("-", F.substring(w, 1, 1), F.substring(w, 1, 2), w)
    words = lexicon(spark, sf) if words is None else words
    return words.where("nature = 'n'").select("word", path.alias("taglayer"))


def word_vec(spark: SparkSession, sf: str) -> DataFrame:
    """(word, vec): nouns joined to an embedding that their hash names."""
    vecs = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vec"))
    n = vecs.agg(F.count("*")).scalar()
    number = F.conv(F.substring(F.md5("word"), 1, 7), 16, 10).cast("bigint")
    nouns = lexicon(spark, sf).where("nature = 'n'").select("word", (number % n).alias("vec_id"))
    return nouns.join(vecs, "vec_id").select("word", "vec")


def doc_points(spark: SparkSession, sf: str) -> DataFrame:
    """(id, vec): embeddings under ids whose text order is their number order."""
    vec = F.col("embedding").cast("array<double>").alias("vec")
    return table(spark, sf, "embeddings").select(F.lpad(F.col("vec_id").cast("string"), 9, "0").alias("id"), vec)


def class_dictionary(spark: SparkSession, sf: str, words: DataFrame | None = None) -> DataFrame:
    """(word, s_id): corpus nouns under the nation their hash names.

    ``words`` is the lexicon, where the caller has it stored already."""
    nations = table(spark, sf, "nation")
    n = nations.agg(F.count("*")).scalar()
    number = F.conv(F.substring(F.md5("word"), 1, 7), 16, 10).cast("bigint")
    words = lexicon(spark, sf) if words is None else words
    return words.where("nature like 'n%'").select("word", (100 + number % n).cast("int").alias("s_id"))


def part_words(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", F.explode(letter_runs("p_name")).alias("word"))
