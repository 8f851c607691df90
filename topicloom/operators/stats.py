"""Counts, TF-IDF, vocabularies and term vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.operators.segment import explode_tokens
from topicloom.operators.skew import dense_index, rows_by_key, salted_join
from topicloom.session import cut_lineage, scratch_path

# Documents of a task that are counted side by side.
CHUNK_ROWS = 8192


def word_nature_count(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy("word", "nature").agg(F.count("*").alias("cnt"))


def term_frequency(docs: DataFrame, key: str = "id", words: str = "words") -> DataFrame:
    """(id, word, tf). The tokens of a text meet in one map task, so the shuffle carries
    each distinct word of a document once. Tokens are never null, so joins add no filter below
    the count and all its readers share one shuffle."""
    return explode_tokens(docs, key, words).groupBy(key, "word").agg(F.count("*").alias("tf"))


def token_counts(docs: DataFrame, key: str = "id", words: str = "words") -> DataFrame:
    """(id, word, tf) like :func:`term_frequency`, counted inside each row: no shuffle, and the words
    of a document stay in its task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            terms = lists.flatten().dictionary_encode()
            sizes = np.diff(lists.offsets.to_numpy())
            rows = np.repeat(np.arange(len(lists)), sizes)
            width = max(len(terms.dictionary), 1)
            pairs, tf = np.unique(rows * width + terms.indices.to_numpy(zero_copy_only=False), return_counts=True)
            yield pa.record_batch(
                [batch.column(0).take(pa.array(pairs // width)), terms.dictionary.take(pa.array(pairs % width)), pa.array(tf.astype(np.int64))],
                names=[key, "word", "tf"],
            )

    listed = docs.select(key, F.coalesce(F.col(words), F.array().cast("array<string>")).alias(words))
    return listed.mapInArrow(count, f"`{key}` {docs.schema[key].dataType.simpleString()}, word string, tf long")


def document_frequency(tf: DataFrame) -> DataFrame:
    """(word, df, tf): number of documents and of tokens per word.

    Reading ``tf`` as well lets this branch and the rows it is joined to share one shuffle.
    """
    return tf.groupBy("word").agg(F.count("*").alias("df"), F.sum("tf").alias("tf"))


def doc_count(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count("*").alias("n_docs"))


def idf(n_docs: Column, df: Column, how: str = "inside") -> Column:
    """``inside``: ln((N+1)/(df+1)); ``outside``: ln(N+1)/(df+1)."""
    if how == "inside":
        return F.ln((n_docs + 1.0) / (df + 1.0))
    if how == "outside":
        return F.ln(n_docs + F.lit(1)) / (df + 1)
    raise ValueError(f"unknown idf: {how}")


def tfidf_weights(docs: DataFrame, how: str = "outside", scale: float = 1000, min_df: int = 1, key: str = "id") -> DataFrame:
    """(id, word, tf, weight) for the words found in more than ``min_df`` documents."""
    tf = term_frequency(docs, key)
    n = docs.agg(F.count("*")).scalar()
    kept = (
        document_frequency(tf)
        .where((F.col("df") > min_df) & (F.col("tf") > 0))
        .select("word", "df", idf(n, F.col("df"), how).alias("idf"))
    )
    return salted_join(tf, kept, "word", heat="df").select(
        key, "word", "tf", (F.col("idf") * F.col("tf") * F.lit(scale)).alias("weight")
    )


def _by_weight() -> list[Column]:
    return [F.round("weight", 6).desc(), F.col("word").asc()]


def doc_tfidf(
    docs: DataFrame, how: str = "outside", scale: float = 1000, min_df: int = 1, drop_last: bool = True, key: str = "id"
) -> DataFrame:
    """(id, word, weight, rank) by falling weight; the lowest word of each document is dropped."""
    rank = Window.partitionBy(key).orderBy(*_by_weight())
    ranked = tfidf_weights(docs, how, scale, min_df, key).select(
        key,
        "word",
        "weight",
        F.row_number().over(rank).alias("rank"),
        F.lead(F.lit(1)).over(rank).isNull().alias("_last"),
    )
    return (ranked.where(~F.col("_last")) if drop_last else ranked).drop("_last")


def doc_tfidf_lists(
    docs: DataFrame, how: str = "outside", scale: float = 1000, min_df: int = 1, drop_last: bool = True, key: str = "id"
) -> DataFrame:
    """The same as one row per document with ``words`` = array of (word, weight). A document
    with a single weighted word keeps an empty array.

    Documents are written down in chunks; the distinct words of a chunk meet the idf table in a join, and the
    chunk's lists are counted beside what was found: no term of a document travels alone. Only the
    terms of ids that stand on several rows are shuffled by themselves."""
    single, several = rows_by_key(docs.select(key, "words"), key)
    dealt = _dealt(single, key)
    per_word = dealt.select(F.explode_outer(F.array_distinct("words")).alias("word")).where(F.col("word").isNotNull())
    df = per_word.groupBy("word").agg(F.count("*").alias("df"))
    if several is not None:
        more = term_frequency(several, key)
        df = df.unionByName(document_frequency(more).select("word", "df")).groupBy("word").agg(F.sum("df").alias("df"))
    n = docs.agg(F.count("*")).scalar()
    kept = cut_lineage(df.where(F.col("df") > min_df).select("word", "df", idf(n, F.col("df"), how).alias("idf")))
    found = _chunk_counts(dealt, kept, key)
    if several is not None:
        pair = F.struct("word", "tf", "idf")
        grouped = salted_join(more, kept, "word", heat="df").groupBy(key).agg(F.collect_list(pair).alias("found"))
        found = found.unionByName(grouped)

    def weighted(x: Column) -> Column:
        weight = x["idf"] * x["tf"] * F.lit(scale)
        return F.struct((-F.round(weight, 6)).alias("o"), x["word"].alias("word"), weight.alias("weight"))

    lists = found.select(key, F.sort_array(F.transform("found", weighted)).alias("w"))
    kept_items = F.slice("w", F.lit(1), F.size("w") - 1) if drop_last else F.col("w")
    return lists.select(key, F.transform(kept_items, lambda x: F.struct(x["word"], x["weight"])).alias("words"))


def _dealt(docs: DataFrame, key: str) -> DataFrame:
    """``docs``(key, words) with ``_chunk``: up to ``CHUNK_ROWS`` neighbouring rows of a task. Written to
    the shared folder, so that all readers see the same chunks and no text is segmented again."""
    path = scratch_path(docs.sparkSession, "chunks")
    listed = docs.select(key, F.coalesce(F.col("words"), F.array().cast("array<string>")).alias("words"))
    place = F.monotonically_increasing_id()
    listed.withColumn("_chunk", F.floor(place / F.lit(CHUNK_ROWS)).cast("bigint")).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _chunk_counts(dealt: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """(id, found): the words of each row of :func:`_dealt` that are in ``kept``(word, idf), as (word, tf, idf);
    rows without any are left out."""
    used = dealt.select(F.col("_chunk").alias("_of"), F.explode_outer("words").alias("word")).where(F.col("word").isNotNull()).distinct()
    known = used.join(kept.select("word", "idf"), "word").select("_of", "word", "idf")
    item = pa.struct([("word", pa.string()), ("tf", pa.int64()), ("idf", pa.float64())])

    def count(rows: pa.Table, found: pa.Table) -> pa.Table:
        ids, lists = rows.column(key), rows.column("words").combine_chunks()
        names, idfs = found.column("word").combine_chunks(), found.column("idf").combine_chunks()
        spot = pc.fill_null(pc.index_in(lists.flatten(), value_set=names), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        width = max(len(names), 1)
        pairs, tf = np.unique((row * width + spot)[spot >= 0], return_counts=True)
        row, at = np.unique(pairs // width, return_index=True)
        spot = pa.array(pairs % width)
        items = pa.StructArray.from_arrays([names.take(spot), pa.array(tf.astype(np.int64)), idfs.take(spot)], fields=list(item))
        listed = pa.ListArray.from_arrays(pa.array(np.append(at, len(pairs)), pa.int32()), items)
        return pa.table([ids.take(pa.array(row)), listed], names=[key, "found"])

    schema = f"`{key}` {dealt.schema[key].dataType.simpleString()}, found array<struct<word:string,tf:bigint,idf:double>>"
    return dealt.groupBy("_chunk").cogroup(known.groupBy("_of")).applyInArrow(count, schema)


def corpus_tfidf(docs: DataFrame, how: str = "inside", key: str = "id") -> DataFrame:
    """(word, tf, df, tfidf) over the whole corpus."""
    counts = document_frequency(term_frequency(docs, key))
    n = docs.agg(F.count("*")).scalar()
    return counts.select("word", "tf", "df", (F.col("tf") * idf(n, F.col("df"), how)).alias("tfidf"))


def distinct_words(df: DataFrame) -> DataFrame:
    return df.select("word").distinct()


def dedupe_map(df: DataFrame, key: str, value: str) -> DataFrame:
    """One value per key: the smallest, where a driver-side map would keep an arbitrary one."""
    return df.groupBy(key).agg(F.min(value).alias(value))


def word_classes(dictionary: DataFrame, word: str = "word", class_id: str = "s_id") -> DataFrame:
    """The set of class ids of each dictionary word."""
    pairs = dictionary.select(word, class_id).distinct()
    return pairs.groupBy(word).agg(F.sort_array(F.collect_list(class_id)).alias("class_ids"))


def vocabulary(tokens: DataFrame, min_count: int = 5) -> DataFrame:
    """(word, cnt, index): words by falling count, then by word, numbered from 0."""
    counts = tokens.groupBy("word").agg(F.count("*").alias("cnt")).where(F.col("cnt") >= min_count)
    return dense_index(counts, [F.col("cnt").desc(), F.col("word").asc()])


def term_index(docs: DataFrame, words: str = "words") -> DataFrame:
    """(word, df, index) of every distinct term, most frequent first."""
    return vocabulary(explode_tokens(docs, words=words, key=words).select("word"), 1).withColumnRenamed("cnt", "heat")


def term_vectors(docs: DataFrame, key: str = "id", words: str = "words", index: DataFrame | None = None) -> DataFrame:
    """(id, num_features, indices, values): exact-vocabulary term counts as sparse vectors.

    The vocabulary stays a table; it is never held by the driver or by one task.
    """
    index = term_index(docs, words) if index is None else index
    width = index.agg(F.count("*")).scalar()
    terms = salted_join(term_frequency(docs, key, words), index, "word", heat="heat")
    pairs = F.sort_array(F.collect_list(F.struct(F.col("index").alias("i"), F.col("tf").cast("double").alias("v"))))
    vectors = terms.groupBy(key).agg(pairs.alias("p"))
    return docs.select(key).join(vectors, key, "left").select(
        key,
        width.alias("num_features"),
        F.coalesce(F.col("p.i"), F.array().cast("array<bigint>")).alias("indices"),
        F.coalesce(F.col("p.v"), F.array().cast("array<double>")).alias("values"),
    )


@F.udf(VectorUDT())
def ml_vector(num_features, indices, values):
    """The cells of :func:`term_vectors` as the vector type that ML stages read."""
    return SparseVector(num_features, indices, values)


class TermVectors(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """ML-pipeline form of :func:`term_vectors`: adds a sparse vector column."""

    numFeatures = Param(Params._dummy(), "numFeatures", "how many terms the vectors count", TypeConverters.toInt)
    keyCol = Param(Params._dummy(), "keyCol", "column that identifies the rows", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol: str = "words", outputCol: str = "features", keyCol: str = "id"):
        super().__init__()
        self._setDefault(inputCol="words", outputCol="features", keyCol="id", numFeatures=1 << 18)
        self._set(**self._input_kwargs)

    def getNumFeatures(self) -> int:
        return self.getOrDefault(self.numFeatures)

    def setNumFeatures(self, value: int) -> TermVectors:
        if value <= 0:
            raise ValueError(f"a vector needs at least one feature, not {value}")
        return self._set(numFeatures=value)

    def setInputCol(self, value: str) -> TermVectors:
        return self._set(inputCol=value)

    def setOutputCol(self, value: str) -> TermVectors:
        return self._set(outputCol=value)

    def setKeyCol(self, value: str) -> TermVectors:
        return self._set(keyCol=value)

    def transformSchema(self, schema: T.StructType) -> T.StructType:
        found = schema[self.getInputCol()].dataType
        if not isinstance(found, T.ArrayType):
            raise TypeError(f"term vectors are made of word arrays, not of {found.simpleString()}")
        return T.StructType([*schema.fields, T.StructField(self.getOutputCol(), VectorUDT())])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        self.transformSchema(dataset.schema)
        key = self.getOrDefault(self.keyCol)
        index = term_index(dataset, self.getInputCol())
        self.setNumFeatures(max(index.count(), 1))
        made = term_vectors(dataset, key, self.getInputCol(), index)
        cell = ml_vector("num_features", "indices", "values").alias(self.getOutputCol())
        return dataset.join(made.select(key, cell), key)
