"""TextRank keyword scores.

A document is one row, so its graph is built and iterated where the row lies: nothing is
shuffled until scores are summed over documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.operators.skew import rows_by_key

BEFORE = 5
AFTER = 4
# Pairs that a task gathers before it hands out their lists.
LIST_PAIRS = 1 << 18


def cooccurrence_edges(
    docs: DataFrame, key: str = "id", words: str = "words", before: int = BEFORE, after: int = AFTER, per_word: bool = False
) -> DataFrame:
    """(id, word, neighbour): distinct neighbours within ``before`` tokens to the left and
    ``after`` tokens to the right of any occurrence. A word may neighbour itself.

    The pairs of a document are made distinct where its row lies, so none of the nine-fold
    repeated tokens is shuffled. With ``per_word`` the rows are (id, word, neighbours): the sorted
    neighbours of a word in all rows of the id, in one list. Lists are made beside the row too; only the pairs of
    ids that stand on several rows are shuffled (a neighbour is listed once for each of these rows)."""
    if not per_word:
        return _listed(docs, key, words).mapInArrow(_pairs_by_row(key, before, after), _edge_schema(docs, key, T.StringType(), "neighbour"))
    single, several = rows_by_key(docs.select(key, words), key)
    lists = _listed(single, key, words).mapInArrow(
        _lists_by_row(key, before, after), _edge_schema(docs, key, T.ArrayType(T.StringType()), "neighbours")
    )
    if several is None:
        return lists
    edges = cooccurrence_edges(several, key, words, before, after)
    return lists.unionByName(edges.groupBy(key, "word").agg(F.sort_array(F.collect_list("neighbour")).alias("neighbours")))


def _edge_schema(docs: DataFrame, key: str, kind: T.DataType, name: str) -> T.StructType:
    return T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("word", T.StringType()), T.StructField(name, kind)])


def _pairs_by_row(key: str, before: int, after: int):
    def pair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            names, documents = _coded(batch.column(1))
            for row, codes in documents:
                own, seq = np.unique(codes, return_inverse=True)
                word, other = _neighbour_pairs(seq, len(own), before, after)
                if len(word):
                    columns = [ids.take(pa.array(np.full(len(word), row))), names.take(pa.array(own[word])), names.take(pa.array(own[other]))]
                    yield pa.record_batch(columns, names=[key, "word", "neighbour"])

    return pair_batches


def _lists_by_row(key: str, before: int, after: int):
    """The same pairs with the neighbours of a word in one list, in the order of their UTF-8 bytes."""

    def list_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, documents = _coded(batch.column(1))
            # Bytes sort as Spark sorts strings; codes that follow this order make sorted pairs.
            order = np.array(pc.sort_indices(names.cast(pa.binary())))
            names, place = names.take(pa.array(order)), np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
            size = 0

            def lists(held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
                rows, word, counts, others = zip(*held, strict=True)
                spans = pa.array(np.r_[0, np.cumsum(np.concatenate(counts))], pa.int32())
                return pa.record_batch(
                    [
                        batch.column(0).take(pa.array(np.repeat(rows, [len(w) for w in word]))),  # noqa: B023
                        names.take(pa.array(np.concatenate(word))),  # noqa: B023
                        pa.ListArray.from_arrays(spans, names.take(pa.array(np.concatenate(others)))),  # noqa: B023
                    ],
                    names=[key, "word", "neighbours"],
                )

            for row, codes in documents:
                own, seq = np.unique(place[codes], return_inverse=True)
                word, other = _neighbour_pairs(seq, len(own), before, after)
                if len(word):
                    first, counts = np.unique(word, return_counts=True)
                    held.append((row, own[first], counts, own[other]))
                    size += len(word)
                if size >= LIST_PAIRS:
                    yield lists(held)
                    held, size = [], 0
            if held:
                yield lists(held)

    return list_batches


def _listed(docs: DataFrame, key: str, words: str) -> DataFrame:
    return docs.select(key, F.coalesce(F.col(words), F.array().cast("array<string>")).alias(words))


def _coded(lists: pa.ListArray) -> tuple[pa.Array, Iterator[tuple[int, np.ndarray]]]:
    """The distinct words of a batch and, for each document that has any, its word codes."""
    terms = lists.flatten().dictionary_encode()
    codes = terms.indices.to_numpy().astype(np.int64)
    ends = np.cumsum(np.diff(lists.offsets.to_numpy()))
    spans = enumerate(zip(np.r_[0, ends[:-1]], ends, strict=True))
    return terms.dictionary, ((row, codes[lo:hi]) for row, (lo, hi) in spans if hi > lo)


def _neighbour_pairs(seq: np.ndarray, size: int, before: int, after: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (word, neighbour) index pairs of one token sequence."""
    found = [seq[k:] * size + seq[:-k] for k in range(1, before + 1) if k < len(seq)]
    found += [seq[:-k] * size + seq[k:] for k in range(1, after + 1) if k < len(seq)]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pairs = np.unique(np.concatenate(found))
    return pairs // size, pairs % size


def _iterate(
    word: np.ndarray, other: np.ndarray, size: int, d: float, max_iter: int, tol: float, degree_norm: bool
) -> np.ndarray:
    score = np.zeros(size)
    degree = np.maximum(np.bincount(word, minlength=size), 1) if degree_norm else 1
    for _ in range(max_iter):
        passed = score / degree
        fresh = (1 - d) + d * np.bincount(word, weights=passed[other], minlength=size)
        change = np.abs(fresh - score).max(initial=0.0)
        score = fresh
        if change < tol:
            break
    return score


def textrank(
    docs: DataFrame,
    key: str = "id",
    words: str = "words",
    d: float = 0.85,
    max_iter: int = 20,
    tol: float = 1e-5,
    degree_norm: bool = False,
    before: int = BEFORE,
    after: int = AFTER,
) -> DataFrame:
    """(id, word, score, rank, n_words): the words of each document by falling score.

    ``s(w) = (1 - d) + d * sum of s(other)`` over the neighbours of ``w``, from 0. Scores are not
    divided by the neighbour count unless ``degree_norm``. Scores equal to nine digits of their
    logarithm rank by word.
    """
    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            T.StructField("word", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("rank", T.LongType()),
            T.StructField("n_words", T.LongType()),
        ]
    )

    rank = _ranker(d, max_iter, tol, degree_norm, before, after)

    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, ranked = rank(batch.column(1))
            if ranked:
                rows, picked, scores = zip(*ranked, strict=True)
                sizes = np.array([len(p) for p in picked])
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array(np.repeat(rows, sizes))),
                        names.take(pa.array(np.concatenate(picked))),
                        pa.array(np.concatenate(scores)),
                        pa.array(np.concatenate([np.arange(1, n + 1) for n in sizes])),
                        pa.array(np.repeat(sizes, sizes)),
                    ],
                    names=[key, "word", "score", "rank", "n_words"],
                )

    return _listed(docs, key, words).mapInArrow(score_batches, schema)


def _ranker(d: float, max_iter: int, tol: float, degree_norm: bool, before: int, after: int):
    """A function from a list column to (distinct words, [(row, word codes by falling score, scores)])."""

    def rank(lists: pa.ListArray) -> tuple[pa.Array, list[tuple[int, np.ndarray, np.ndarray]]]:
        names, documents = _coded(lists)
        alphabetic = np.empty(len(names), np.int64)
        alphabetic[np.argsort(np.array(names.to_pylist(), dtype=object))] = np.arange(len(names))
        ranked = []
        for row, codes in documents:
            own, seq = np.unique(codes, return_inverse=True)
            word, other = _neighbour_pairs(seq, len(own), before, after)
            word, other = word[word != other], other[word != other]
            score = _iterate(word, other, len(own), d, max_iter, tol, degree_norm)
            order = np.lexsort((alphabetic[own], -np.round(np.log(score), 9)))
            ranked.append((row, own[order], score[order]))
        return names, ranked

    return rank


def textrank_by_doc(
    docs: DataFrame,
    key: str = "id",
    words: str = "words",
    msg: str = "msg",
    d: float = 0.85,
    max_iter: int = 20,
    tol: float = 1e-5,
    degree_norm: bool = False,
    before: int = BEFORE,
    after: int = AFTER,
) -> DataFrame:
    """(id, msg, textrank): per document its words and scores, best first. All of it stays in the row."""
    rank = _ranker(d, max_iter, tol, degree_norm, before, after)
    item = pa.struct([("word", pa.string()), ("score", pa.float64())])

    def list_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, ranked = rank(batch.column(2))
            sizes = np.zeros(batch.num_rows, np.int64)
            for row, picked, _ in ranked:
                sizes[row] = len(picked)
            codes = np.concatenate([p for _, p, _ in ranked]) if ranked else np.zeros(0, np.int64)
            scores = np.concatenate([s for _, _, s in ranked]) if ranked else np.zeros(0)
            items = pa.StructArray.from_arrays([names.take(pa.array(codes)).cast(pa.string()), pa.array(scores)], fields=list(item))
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), items)
            yield pa.record_batch([batch.column(0), batch.column(1), lists], names=[key, msg, "textrank"])

    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            T.StructField(msg, docs.schema[msg].dataType),
            T.StructField("textrank", T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("score", T.DoubleType())]))),
        ]
    )
    listed = docs.select(key, msg, F.coalesce(F.col(words), F.array().cast("array<string>")).alias(words))
    return listed.mapInArrow(list_batches, schema)


def textrank_total(scores: DataFrame) -> DataFrame:
    """(word, trval): sum of a word's scores over all documents."""
    return scores.groupBy("word").agg(F.sum("score").alias("trval"))
