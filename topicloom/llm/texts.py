"""Whole texts as numpy arrays: words, rolling hashes and bounded pieces of Arrow batches.

All of it works on UTF-8 bytes. A piece holds whole documents and about ``PIECE`` bytes (one
longer document makes a piece of its own), so that temporary arrays stay small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
# Largest Arrow batch of whole texts that a task sends to Python.
BATCH_BYTES = 8 << 20
BATCH_ROWS = 2_000
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
_ROWS_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
U = np.uint64
_R = U(0x9E3779B97F4A7C15 | 1)
_R_INVERSE = U(pow(int(_R), -1, 1 << 64))

# The classes of bytes that the contracts name.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
LETTERS_DIGITS = np.ones(256, bool)  # [^\x00-\x2F\x3A-\x60\x7B-\x7F], after lower-casing
for _low, _high in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
    LETTERS_DIGITS[_low : _high + 1] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits (the finishing steps of splitmix64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_CODE = mix((np.arange(256, dtype=np.uint64) + U(1)) * _R)


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, kept for the longest piece so far."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_R, _R_INVERSE)):
            powers = np.full(1 << int(n).bit_length(), base, np.uint64)
            powers[0] = 1
            _POWERS[i] = np.multiply.accumulate(powers)
    return _POWERS


class Rolling:
    """64-bit hashes of any stretch of a byte array, from one cumulative sum."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_CODE[data] * up[: len(data)], out=self.sums[1:])

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])


class Piece:
    """Some whole documents of a batch: ``rows`` are their places in the batch."""

    def __init__(self, rows: range, data: np.ndarray, offsets: np.ndarray):
        self.rows, self.data, self.offsets = rows, data, offsets

    def __len__(self) -> int:
        return len(self.rows)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def pieces(column: pa.Array, limit: int = PIECE) -> Iterator[Piece]:
    """Cut a string column (null: empty) into pieces."""
    n = len(column)
    if n == 0:
        return
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, place, body = column.buffers()
    at = np.frombuffer(place, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield Piece(range(first, last), data[at[first] : at[last]], at[first : last + 1] - at[first])
        first = last


class Words:
    """Places of the words of a piece: byte starts and ends, and the word range of each document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray):
        inside = word_bytes[data]
        n = len(data)
        edge = np.zeros(n + 1, bool)  # the first byte of each document
        edge[offsets] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        before[edge[:n]] = False
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        after[edge[1:]] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.offsets = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.offsets)


def windows(offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all runs of ``k`` items inside one document, and the document of each start."""
    counts = np.maximum(np.diff(offsets) - k + 1, 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) - first[doc] + offsets[:-1][doc], doc


def combine(words: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """Hashes of runs of ``k`` word hashes."""
    total = np.full(len(starts), k, np.uint64) * U(0xD6E8FEB86659FD93)
    for i in range(k):
        total = total * _R + mix(words[starts + i] + U(i))
    return mix(total)


def bound_batches(df):
    """Lower the session's bounds on Arrow batches to ``BATCH_BYTES`` and ``BATCH_ROWS`` (larger
    bounds are lowered, smaller ones kept), so that a batch of texts cannot fill a Python worker;
    returns ``df``."""
    spark = df.sparkSession
    for conf, limit in ((_BATCH_CONF, BATCH_BYTES), (_ROWS_CONF, BATCH_ROWS)):
        digits = "".join(c for c in (spark.conf.get(conf, None) or "") if c.isdigit())
        if not digits or int(digits) <= 0 or int(digits) > limit:
            spark.conf.set(conf, str(limit))
    return df
