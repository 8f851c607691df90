"""Quality rules by compression bands.

A text passes through zstandard twice: whole, and in chunks that overlap. Repetitive text
compresses far better than prose, random text (encoded data, key mashing) far worse; both leave a
band whose limits depend on the length, because short texts compress less. The chunks find what the
whole hides: a long document that repeats or garbles one stretch keeps a normal ratio overall. One
odd chunk is enough, and as chunks start every quarter, so is a stretch of about a chunk's length
wherever it stands. Texts shorter than a chunk are judged as a whole only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from topicloom.llm.texts import NOT_SPACE, Rolling, Words, combine, mix, pieces, windows, bound_batches

# Compressed size over plain size that a whole text may have, by its size in bytes up to the bound.
BANDS: tuple[tuple[float, float, float], ...] = (
    (512, 0.42, 1.00),
    (2_048, 0.38, 0.85),
    (8_192, 0.34, 0.75),
    (float("inf"), 0.28, 0.70),
)
CHUNK = 4_096
CHUNK_BAND = (0.25, 0.75)
# Chunks that start within the length of one.
OVERLAP = 4
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "ratio double, odd_chunks double, base_failed boolean, kept boolean"
)


def _repeated(words: Words, hashes: np.ndarray) -> np.ndarray:
    """Words per document that lie in a three-word window found at least twice in it."""
    starts, doc = windows(words.offsets, 3)
    keys = mix(combine(hashes, starts, 3) ^ mix(doc.astype(np.uint64)))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words.starts), bool)
    for i in range(3):
        covered[starts[twice] + i] = True
    total = np.concatenate([[0], np.cumsum(covered)])
    return total[words.offsets[1:]] - total[words.offsets[:-1]]


def _repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def _ratios(text: bytes, packer: zstandard.ZstdCompressor, chunk: int) -> tuple[float, list[float]]:
    """Of the whole text, and of each full chunk (the last one ends with the text)."""
    if not text:
        return 0.0, []
    whole = len(packer.compress(text)) / len(text)
    cuts = [*range(0, len(text) - chunk, max(1, chunk // OVERLAP)), len(text) - chunk] if len(text) >= chunk else []
    return whole, [len(packer.compress(text[a : a + chunk])) / chunk for a in cuts]


def verdict(text: bytes, bands: Sequence[tuple[float, float, float]], chunk: int, chunk_band: tuple[float, float], packer=None):
    """(ratio, share of odd chunks, inside all limits) of one UTF-8 text; an empty one is inside."""
    packer = packer or zstandard.ZstdCompressor(level=3)
    whole, parts = _ratios(text, packer, chunk)
    if not text:
        return 0.0, 0.0, True
    low, high = next((low, high) for bound, low, high in bands if len(text) <= bound)
    odd = sum(not chunk_band[0] <= x <= chunk_band[1] for x in parts)
    return whole, odd / len(parts) if parts else 0.0, low <= whole <= high and not odd


def quality_rules(
    docs: DataFrame,
    text: str = "text",
    bands: Sequence[tuple[float, float, float]] = BANDS,
    chunk: int = CHUNK,
    chunk_band: tuple[float, float] = CHUNK_BAND,
    carry: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Counts and verdict per document, with the columns of ``carry`` in front.

    Null and empty texts have no words and fail the base rule (fewer than 50 words). Repeated
    rows are judged each for itself; all other columns are left out. No shuffle takes place.
    """
    bound_batches(docs)
    fields = [docs.schema[c] for c in carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for piece in pieces(batch.column(len(carry))):
                words = Words(piece.data, piece.offsets, NOT_SPACE)
                hashes = Rolling(piece.data).hash(words.starts, words.ends)
                repeated = _repeated(words, hashes)
                n = words.counts
                lead = (piece.data & 0xC0) != 0x80
                sums = [np.concatenate([[0], np.cumsum(x)]) for x in (lead & NOT_SPACE[piece.data], SYMBOLS[piece.data])]
                chars, symbols = (s[piece.offsets[1:]] - s[piece.offsets[:-1]] for s in sums)
                texts = [piece.text(i) for i in range(len(piece))]
                lines = [_repeated_lines(t) for t in texts]
                judged = [verdict(t, bands, chunk, chunk_band, packer) for t in texts]
                failed = (n < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n)
                kept = ~failed & np.array([x[2] for x in judged], bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(piece.rows.start, len(piece)) for i in range(len(carry))),
                        *(pa.array(x, pa.int64()) for x in (n, chars, symbols, lines, repeated)),
                        pa.array([x[0] for x in judged], pa.float64()),
                        pa.array([x[1] for x in judged], pa.float64()),
                        pa.array(failed),
                        pa.array(kept),
                    ],
                    names=names,
                )

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", " + COLUMNS
    names = [*carry, *(c.split()[0] for c in COLUMNS.split(", "))]
    return docs.select(*carry, text).mapInArrow(run, shape)
