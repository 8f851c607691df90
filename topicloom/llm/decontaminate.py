"""Benchmark decontamination with Wu-Manber multi-pattern search.

The symbols are words. A benchmark item gives its runs of ten consecutive words (a shorter item
is one run); these are the patterns. A shift table tells for each block of two words how far the
search may jump when the block stands at the end of the current position; a block that no pattern
holds lets it jump nine words at once. Where the shift is 0, the block's bucket names the patterns
that end in it, and comparing the words one by one confirms them.

Many stretches of many documents are searched in step, so each step is a few numpy operations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.texts import LETTERS_DIGITS, LOWER, Piece, Rolling, U, Words, mix, pieces, bound_batches
from topicloom.session import cut_lineage

WINDOW = 10
# Words of the benchmark that one pass over the documents may carry; more take further passes.
PATTERN_WORDS = 4_000_000
# Positions of a document that one lane of the search walks through.
LANE = 192
HITS = "array<struct<start:bigint,end:bigint>>"


def _hashes(piece: Piece) -> tuple[np.ndarray, Words, np.ndarray]:
    data = LOWER[piece.data]
    words = Words(data, piece.offsets, LETTERS_DIGITS)
    return data, words, Rolling(data).hash(words.starts, words.ends)


class Table(NamedTuple):
    """Search tables of all patterns of one length."""

    length: int
    block: int
    shift: np.ndarray  # by block hash
    ends: np.ndarray  # sorted hashes of the last block of each pattern
    patterns: np.ndarray  # word hashes, one row per pattern, in the order of ``ends``
    spelled: list[bytes]  # the same patterns as text
    items: list[list[int]]  # the items each pattern comes from


def _block(words: np.ndarray, last: np.ndarray, block: int) -> np.ndarray:
    """Hash of the ``block`` words that end at ``last``."""
    return mix(words[last] + U(0x51ED270B) * words[last - 1]) if block == 2 else mix(words[last])


def build_tables(items: list[str | None], window: int = WINDOW) -> list[Table]:
    found: dict[int, dict[bytes, list[int]]] = {}
    hashes: dict[bytes, np.ndarray] = {}
    for piece in pieces(pa.array(items, pa.string())):
        data, words, h = _hashes(piece)
        spelled = [data[a:b].tobytes() for a, b in zip(words.starts, words.ends, strict=True)]
        for i in range(len(piece)):
            first, last = words.offsets[i], words.offsets[i + 1]
            size = min(window, last - first)
            for at in range(first, last - size + 1) if size else ():
                text = b" ".join(spelled[at : at + size])
                hashes[text] = h[at : at + size]
                places = found.setdefault(int(size), {}).setdefault(text, [])
                if not places or places[-1] != piece.rows[i]:
                    places.append(piece.rows[i])
    tables = []
    for size, patterns in sorted(found.items()):
        texts = list(patterns)
        rows = np.stack([hashes[t] for t in texts])
        block = min(2, size)
        bits = max(12, int(rows.size).bit_length() + 3)
        shift = np.full(1 << bits, size - block + 1, np.int64)
        for last in range(block - 1, size):  # later blocks allow less
            np.minimum.at(shift, _block(rows.T.copy(), np.array([last]), block)[0] >> U(64 - bits), size - 1 - last)
        ends = _block(rows.T.copy(), np.array([size - 1]), block)[0]
        order = np.argsort(ends, kind="stable")
        tables.append(Table(size, block, shift, ends[order], rows[order], [texts[i] for i in order], [patterns[texts[i]] for i in order]))
    return tables


def search(table: Table, words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, pattern) of all occurrences in the documents ``words[offsets[i]:offsets[i + 1]]``."""
    size, bits = table.length, U(64 - (len(table.shift).bit_length() - 1))
    firsts, stops = [], []  # lanes: ends of candidate positions, first and one past the last
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        if b - a >= size:
            start = np.arange(a + size - 1, b, LANE)
            firsts.append(start)
            stops.append(np.minimum(start + LANE, b))
    if not firsts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, stop = np.concatenate(firsts), np.concatenate(stops)
    starts, which = [], []
    while len(at):
        block = _block(words, at, table.block)
        jump = table.shift[block >> bits]
        tested = np.flatnonzero(jump == 0)
        if len(tested):
            low = np.searchsorted(table.ends, block[tested], side="left")
            high = np.searchsorted(table.ends, block[tested], side="right")
            n = high - low
            place = np.repeat(at[tested], n)
            pattern = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
            equal = np.ones(len(place), bool)
            for i in range(size):
                equal &= words[place - size + 1 + i] == table.patterns[pattern, i]
            starts.append(place[equal] - size + 1)
            which.append(pattern[equal])
        at = at + np.maximum(jump, 1)
        more = at < stop
        at, stop = at[more], stop[more]
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(starts), np.concatenate(which)


def _occurrences(tables: list[Table], piece: Piece):
    """Word count, hit words (as a mask over all words) and item places per document of a piece."""
    data, words, h = _hashes(piece)
    edges = np.zeros(len(h) + 1, np.int64)
    items: dict[int, set[int]] = {}
    for table in tables:
        starts, which = search(table, h, words.offsets)
        doc = np.searchsorted(words.offsets, starts, side="right") - 1
        for s, p, d in zip(starts.tolist(), which.tolist(), doc.tolist(), strict=True):
            text = b" ".join(data[a:b].tobytes() for a, b in zip(words.starts[s : s + table.length], words.ends[s : s + table.length], strict=True))
            if text == table.spelled[p]:  # direct comparison
                edges[s] += 1
                edges[s + table.length] -= 1
                items.setdefault(d, set()).update(table.items[p])
    return words, np.cumsum(edges)[:-1] > 0, items


def _pass(docs: DataFrame, text: str, carry: list[str], ids: list, benchmark: list[str | None], window: int, number: int) -> DataFrame:
    """The columns of ``carry`` with word counts, runs of hit words and ids of the items found."""
    shared = docs.sparkSession.sparkContext.broadcast(build_tables(benchmark, window))  # bounded by PATTERN_WORDS
    names = [*carry, "_words", f"_hits{number}", f"_items{number}"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value
        for batch in batches:
            for piece in pieces(batch.column(len(carry))):
                words, hit, items = _occurrences(tables, piece)
                spans = []
                for a, b in zip(words.offsets[:-1], words.offsets[1:], strict=True):
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit[a:b].view(np.int8), [0]])))
                    spans.append([{"start": x, "end": y} for x, y in edge.reshape(-1, 2).tolist()])
                found = [sorted({str(ids[x]) for x in items.get(i, ())}) for i in range(len(piece))]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(piece.rows.start, len(piece)) for i in range(len(carry))),
                        pa.array(words.counts, pa.int64()),
                        pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        pa.array(found, pa.list_(pa.string())),
                    ],
                    names=names,
                )

    shape = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in carry)
    return docs.select(*carry, F.col(text).alias("_text")).mapInArrow(run, f"{shape}_words long, _hits{number} {HITS}, _items{number} array<string>")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    pattern_words: int = PATTERN_WORDS,
) -> DataFrame:
    """Per document row the columns of ``carry``, then ``n_words``, ``hits`` (runs of hit words, end
    exclusive) and ``items`` (ids as text, sorted).

    Null and empty texts have no words and no hits; null or empty items give no window; repeated
    items count once per id, items without an id are left out; other columns are left out. The
    benchmark passes through the driver in parts of about ``pattern_words`` words (by its size in
    characters, an upper bound). Each part costs one pass over the documents. No shuffle takes place.
    """
    bound_batches(docs)
    rows = benchmark.select(F.col(item_key).alias("_id"), F.coalesce(item_text, F.lit("")).alias("_text")).where("_id is not null")
    total = rows.agg(F.sum(F.length("_text"))).first()[0] or 0
    parts = -(-total // (2 * pattern_words)) or 1  # a word and its separator take two characters at least
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("_id", "_text"), F.lit(parts)))
    found, through = docs.select(*dict.fromkeys([*carry, text])), list(dict.fromkeys([*carry, text])) if parts > 1 else list(carry)
    for part in range(parts):
        items = rows.where(F.col("_part") == part).orderBy("_id", "_text").collect()
        found = _pass(found, text, through, [r[0] for r in items], [r[1] for r in items], window, part)
        if parts > 1:
            found = cut_lineage(found.withColumnRenamed("_words", "n_words") if part == parts - 1 else found.drop("_words"))
            through += [f"_hits{part}", f"_items{part}"]
    if parts == 1:
        return found.select(*carry, F.col("_words").alias("n_words"), F.col("_hits0").alias("hits"), F.col("_items0").alias("items"))
    hits = merged(F.array(*[f"_hits{i}" for i in range(parts)]))
    items = F.array_sort(F.array_distinct(F.flatten(F.array(*[f"_items{i}" for i in range(parts)]))))
    return found.select(*carry, "n_words", hits.alias("hits"), items.alias("items"))


def merged(lists):
    """One list of runs from several, overlapping ones joined."""

    def step(out, run):
        last = F.try_element_at(out, F.lit(-1))
        longer = F.struct(last.start.alias("start"), F.greatest(last.end, run.end).alias("end"))
        joined = F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(longer))
        return F.when((F.size(out) > 0) & (run.start <= last.end), joined).otherwise(F.concat(out, F.array(run)))

    return F.aggregate(F.array_sort(F.flatten(lists)), F.array().cast(HITS), step)


def hit_words(hits):
    """Number of words in a list of runs."""
    return F.aggregate(hits, F.lit(0).cast("bigint"), lambda n, run: n + run.end - run.start)


def items_digest(items):
    return F.sha2(F.array_join(items, ","), 256)


def digest(ids: list[str]) -> str:
    """The digest of a list of item ids, in plain Python."""
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
