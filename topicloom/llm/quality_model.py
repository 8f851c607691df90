"""Quality classifier: boosted trees over document statistics.

Statistics are taken from whole texts. The trees are fitted on a bounded sample of labelled rows
(``MAX_ROWS``, the rows with the smallest hashes of their ids), which alone passes through the
driver; every document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.boosted_trees import Forest, predict, train
from topicloom.llm.quality_rules import _repeated, _repeated_lines
from topicloom.llm.texts import NOT_SPACE, Piece, Rolling, U, Words, mix, pieces, bound_batches

MAX_ROWS = 20_000
ACCEPT = 0.7
FEATURES = (
    "words", "chars_per_word", "long_words", "short_words", "distinct_words", "repeated_words", "top_word", "upper", "digits", "signs", "brackets",
    "sentence_ends", "commas", "non_ascii", "spaces", "signed_words", "capital_words", "lines", "repeated_lines", "ratio", "byte_entropy", "distinct_bytes",
)


def _byte_class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_UPPER, _DIGIT = _byte_class(bytes(range(65, 91))), _byte_class(b"0123456789")
_SIGN = _byte_class(bytes(i for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in ".,!?;:'\"()-"))
_BRACKET, _END, _COMMA = _byte_class(b"()[]{}<>|"), _byte_class(b".!?"), _byte_class(b",;:")
_HIGH = np.arange(256) >= 0xC0  # first bytes of longer characters
_LEAD = (np.arange(256) & 0xC0) != 0x80


def features(piece: Piece) -> np.ndarray:
    """One row of ``FEATURES`` per document; an empty text gives zeros."""
    data, n = piece.data, len(piece)
    words = Words(data, piece.offsets, NOT_SPACE)
    hashes = Rolling(data).hash(words.starts, words.ends)
    doc = np.repeat(np.arange(n), words.counts)
    length = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_LEAD[data], out=length[1:])
    sizes = length[words.ends] - length[words.starts]
    count = np.maximum(words.counts, 1)

    def per_byte(which: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(which[data], out=sums[1:])
        return sums[piece.offsets[1:]] - sums[piece.offsets[:-1]]

    def per_word(flag: np.ndarray) -> np.ndarray:
        return np.bincount(doc, flag, n)

    keys = np.sort(mix(hashes ^ mix(doc.astype(np.uint64) + U(1))))
    order = np.argsort(mix(hashes ^ mix(doc.astype(np.uint64) + U(1))), kind="stable")
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] + U(1)))
    of, times = doc[order[first]], np.diff(np.append(first, len(keys)))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, of, times)
    chars = np.maximum(length[piece.offsets[1:]] - length[piece.offsets[:-1]], 1)
    rows = np.zeros((n, len(FEATURES)))
    rows[:, 0] = np.log1p(words.counts)
    rows[:, 1] = per_word(sizes) / count
    rows[:, 2], rows[:, 3] = per_word(sizes >= 12) / count, per_word(sizes <= 3) / count
    rows[:, 4], rows[:, 5], rows[:, 6] = np.bincount(of, minlength=n) / count, _repeated(words, hashes) / count, top / count
    for i, which in enumerate((_UPPER, _DIGIT, _SIGN, _BRACKET, _END, _COMMA, _HIGH, ~NOT_SPACE)):
        rows[:, 7 + i] = per_byte(which) / chars
    signs = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_SIGN[data], out=signs[1:])
    rows[:, 15] = per_word(signs[words.ends] > signs[words.starts]) / count
    rows[:, 16] = per_word(_UPPER[data[words.starts]] if len(data) else np.zeros(0)) / count
    packer = zstandard.ZstdCompressor(level=3)
    for i in range(n):
        text = piece.text(i)
        if text:
            lines = text.count(b"\n") + 1
            spread = np.bincount(data[piece.offsets[i] : piece.offsets[i + 1]], minlength=256)
            share = spread[spread > 0] / len(text)
            rows[i, 17:] = np.log1p(lines), _repeated_lines(text) / lines, len(packer.compress(text)) / len(text), -(share * np.log2(share)).sum(), len(share)
    return rows


def _features_of(docs: DataFrame, keep: tuple[str, ...], text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(len(keep))):
                own = [batch.column(i).slice(piece.rows.start, len(piece)) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(features(piece).tolist(), pa.list_(pa.float64()))], names=[*keep, "features"])

    shape = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return docs.select(*keep, text).mapInArrow(run, shape + "features array<double>")


def held_out(key):
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", max_rows: int = MAX_ROWS) -> Forest:
    """Trees from at most ``max_rows`` labelled ids that are not held out. Labels that are null, or
    that contradict each other for one id, are left out."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key))).groupBy(key)
    known = known.agg(F.min(label).alias("_y"), F.max(label).alias("_z")).where("_y = _z").select(key, "_y")
    sample = known.orderBy(F.xxhash64(key), key).limit(max_rows)
    joined = docs.select(key, text).join(F.broadcast(sample), key)
    rows = _features_of(joined, (key, "_y"), text).orderBy(key).toArrow()
    x = np.array(rows.column("features").to_pylist(), float).reshape(rows.num_rows, len(FEATURES))
    return train(x, np.array(rows.column("_y").to_pylist(), float))


def score(docs: DataFrame, forest: Forest, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, held_out, score, predicted) per row; null and empty texts get the score of zeros in all
    statistics. Repeated rows are scored each for itself; other columns are left out. No shuffle."""
    bound_batches(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(1)):
                p = predict(forest, features(piece))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(piece.rows.start, len(piece)), pa.array(p)], names=[key, "score"])

    scored = docs.select(key, text).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, score double")
    return scored.select(key, held_out(F.col(key)).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
