"""Segmentation of texts to words and tags, driven by a lexicon(word, nature, freq)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.functions.text import DEFAULT_PATTERN, letter_runs, to_half_width, to_simplified
from topicloom.operators.skew import BROADCAST_BYTES, lookup_join, table_bytes
from topicloom.session import cut_lineage

# Pieces of one run: Han characters, and whatever else the pattern allows.
PIECES = r"\p{IsHan}+|[^\p{IsHan}]+"
HAS_HAN = r"\p{IsHan}"
UNKNOWN_NATURE = "x"
USER_WORD_FREQ = 1024
# Characters of the rows that are cut side by side when a lexicon is too large to be broadcast.
CHUNK_CHARS = 1 << 23
# The filter that tells most substrings from words: its largest size, bits and probes per word, tasks that fill it.
FILTER_BYTES = 8 << 20
FILTER_BITS_PER_WORD = 32
FILTER_PROBES = 4
FILTER_TASKS = 8
BASE = 0x9E3779B97F4A7C15


def normalized(text: Column | str, simplify: Mapping[str, str] | None = None) -> Column:
    """Half-width folding, then the character table if one is given."""
    text = F.col(text) if isinstance(text, str) else text
    # Most texts hold no wide form, and looking for one costs less than translating.
    folded = F.when(text.rlike("[\u3000\uff01-\uff5e]"), to_half_width(text)).otherwise(text)
    return to_simplified(folded, simplify) if simplify else folded


def segment(
    df: DataFrame,
    text: str = "msg",
    out: str = "words",
    lexicon: DataFrame | None = None,
    simplify: Mapping[str, str] | None = None,
    normalize: bool = True,
    key: str | Sequence[str] = "id",
    pattern: str = DEFAULT_PATTERN,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add the ordered words of each text as an array column.

    Spaced scripts are cut by ``pattern`` inside the JVM. With a lexicon, the Han characters in each
    of its runs are cut by longest match, up to the lexicon's longest word: against a broadcast
    word set when the lexicon's Han words take no more than ``max_bytes``, by joining candidate
    substrings otherwise. Both give the same words. ``key`` names columns that come with a row;
    equal rows stay apart.
    """
    source = normalized(text, simplify) if normalize else F.col(text)
    if lexicon is None:
        return df.withColumn(out, letter_runs(source, pattern))
    han_words = cut_lineage(lexicon.where(F.col("word").rlike(HAS_HAN)).select(F.lower("word").alias("word")).distinct())
    runs = F.flatten(F.transform(letter_runs(source, pattern), lambda run: F.regexp_extract_all(run, F.lit(PIECES), F.lit(0))))
    longest = han_words.agg(F.max(F.length("word"))).first()[0]
    if longest is None:
        return df.withColumn(out, F.flatten(F.transform(runs, _single_characters)))
    if table_bytes(han_words) > max_bytes:
        return _segment_by_join(df, text, runs, out, han_words)
    return _segment_by_set(df, runs, out, han_words, longest)


def _single_characters(run: Column) -> Column:
    """A Han run without any known word falls into its characters."""
    return F.when(run.rlike("^" + HAS_HAN), F.split(run, "")).otherwise(F.array(run))


def _longest_cuts(run: str, words: set[str], longest: int) -> list[str]:
    cuts, at = [], 0
    while at < len(run):
        size = next((n for n in range(min(longest, len(run) - at), 1, -1) if run[at : at + n] in words), 1)
        cuts.append(run[at : at + size])
        at += size
    return cuts


def _segment_by_set(df: DataFrame, runs: Column, out: str, han_words: DataFrame, longest: int) -> DataFrame:
    words = {row[0] for row in han_words.toLocalIterator()}  # of bounded size, checked
    shared = df.sparkSession.sparkContext.broadcast(words)

    @F.pandas_udf("array<string>")
    def cut_runs(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared.value
        for rows in batches:
            # Each distinct run of a batch is cut once.
            cuts: dict[str, list[str]] = {}
            for items in rows:
                for run in () if items is None else items:
                    if run not in cuts:
                        cuts[run] = _longest_cuts(run, known, longest) if _starts_han(run) else [run]
            yield rows.map(lambda items: None if items is None else [cut for run in items for cut in cuts[run]])  # noqa: B023

    # Only texts that hold Han characters travel to Python.
    return (
        df.withColumn("_runs", runs)
        .withColumn("_cuts", cut_runs(F.when(F.exists("_runs", lambda run: run.rlike("^" + HAS_HAN)), F.col("_runs"))))
        .withColumn(out, F.coalesce("_cuts", "_runs"))
        .drop("_runs", "_cuts")
    )


def _starts_han(run: str) -> bool:
    point = ord(run[0])
    return (
        0x2E80 <= point <= 0x2FDF
        or point in (0x3005, 0x3007)
        or 0x3021 <= point <= 0x303B
        or 0x3400 <= point <= 0x9FFF
        or 0xF900 <= point <= 0xFAFF
        or 0x20000 <= point <= 0x323AF
    )


def _segment_by_join(df: DataFrame, text: str, runs: Column, out: str, han_words: DataFrame) -> DataFrame:
    """Longest match without holding the lexicon anywhere: candidates meet it in a join.

    Each distinct run is cut once, however many texts hold it. Of its substrings only those travel that a filter
    of bounded size (see :func:`_word_filter`) lets pass, and the false ones among them are taken out. Rows are dealt
    in chunks, as they are; the cuts of a chunk's distinct runs come beside them, and no word of a text travels alone.
    The rows are read several times and must be the same each time.
    """
    chars = df.agg(F.coalesce(F.sum(F.length(text).cast("bigint")), F.lit(0))).first()[0]
    chunks = F.lit(max(1, -(-chars // CHUNK_CHARS)))
    place = F.pmod(F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]), chunks)
    # The outer form keeps the runs from being computed a second time for a filter on their number.
    listed = df.select(place.alias("_of"), runs.alias("_runs")).select("_of", F.explode_outer("_runs").alias("_text"))
    used = listed.where(F.col("_text").rlike("^" + HAS_HAN)).distinct()
    used = cut_lineage(used)
    passed = cut_lineage(_candidates(used.select("_text").distinct(), han_words))
    false = passed.select("word").distinct().join(han_words, "word", "left_anti")
    known = lookup_join(passed, false, "word", "left_anti")
    # Dealt by text once, for both groupings.
    best = known.repartition("_text").groupBy("_text", "at").agg(F.max_by("word", "n").alias("word"))
    spot = F.struct("at", F.length("word").alias("n"))
    per_run = best.groupBy("_text").agg(F.sort_array(F.collect_list(spot)).alias("spots"))
    # Walk the places: keep one, skip as many as its word is long.
    walk = F.aggregate(
        "spots",
        F.struct(F.lit(0).alias("next"), F.array().cast("array<int>").alias("kept")),
        lambda s, x: F.when(
            x["at"] >= s["next"],
            F.struct((x["at"] + x["n"]).alias("next"), F.concat(s["kept"], F.array(x["at"], x["n"])).alias("kept")),
        ).otherwise(s),
    )["kept"]
    cuts = used.join(per_run.select("_text", walk.alias("_cuts")), "_text", "left").select("_of", "_text", "_cuts")

    def cut(rows: pa.Table, found: pa.Table) -> pa.Table:
        lists = rows.column("_runs").combine_chunks()
        coded = lists.flatten().dictionary_encode()
        spots = dict(zip(found.column("_text").to_pylist(), found.column("_cuts").to_pylist(), strict=True))
        pieces, ends = [], [0]
        for run in coded.dictionary.to_pylist():
            pieces.extend(_cut_at(run, spots[run] or ()) if run in spots else [run])
            ends.append(len(pieces))
        ends, codes = np.array(ends), coded.indices.to_numpy(zero_copy_only=False)
        sizes = np.diff(ends)[codes]
        upto = np.r_[0, np.cumsum(sizes)]
        words = pa.array(pieces, pa.string()).take(pa.array(np.arange(upto[-1]) + np.repeat(ends[codes] - upto[:-1], sizes)))
        of_row = np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))]
        listed = pa.ListArray.from_arrays(pa.array(upto[of_row], pa.int32()), words, mask=lists.is_null())
        return rows.drop_columns(["_chunk", "_runs"]).append_column(out, listed)

    # Only the rows themselves are dealt out; their runs are made afterwards.
    dealt = df.withColumn("_chunk", place).repartition("_chunk").withColumn("_runs", runs)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.StringType()))])
    return dealt.groupBy("_chunk").cogroup(cuts.groupBy("_of")).applyInArrow(cut, schema)


def _cut_at(run: str, spots: Sequence[int]) -> Iterator[str]:
    """The words of a run at ``spots`` (place, length, place, length, ..), and the characters between them."""
    at = 0
    for place, size in zip(spots[::2], spots[1::2], strict=True):
        yield from run[at:place]
        yield run[place : place + size]
        at = place + size
    yield from run[at:]


def _hashes(words: pa.Array) -> tuple[str, np.ndarray, np.ndarray, Callable[[np.ndarray, int | np.ndarray], np.ndarray]]:
    """(all characters, start and end of each word, a function (places, length) -> 64-bit hashes of the substrings there)."""
    text = "".join(words.to_pylist())
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    ends = np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False), dtype=np.int64)
    starts = np.r_[0, ends[:-1]] if len(ends) else ends
    # Sums of character * BASE^place; differences, brought back to place 0, are the hashes of substrings.
    up, down = (np.cumprod(np.r_[np.uint64(1), np.full(len(points), b, np.uint64)]) for b in (BASE, pow(BASE, -1, 1 << 64)))
    sums = np.r_[np.uint64(0), np.cumsum(points * up[:-1], dtype=np.uint64)]

    def of(at: np.ndarray, size: int | np.ndarray) -> np.ndarray:
        h = (sums[at + size] - sums[at]) * down[at]
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))

    return text, starts, ends, of


def _filter_place(hashes: np.ndarray, probe: int, bits: int) -> np.ndarray:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return ((hashes + np.uint64(probe) * step) & np.uint64(bits - 1)).astype(np.int64)


def _word_filter(words: DataFrame, n: int) -> np.ndarray:
    """Bits that are 1 at a few places for each of ``n`` words (a Bloom filter): of other words almost none find theirs all set.

    Its size follows from ``n`` up to ``FILTER_BYTES``; a lexicon beyond that lets more false words pass, all of which
    are found out later."""
    bits = 1 << min(max(n * FILTER_BITS_PER_WORD, 8) - 1, FILTER_BYTES * 8 - 1).bit_length()

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.zeros(bits, np.uint8)
        for batch in batches:
            _, starts, ends, of = _hashes(batch.column(0))
            hashes = of(starts, ends - starts)
            for probe in range(FILTER_PROBES):
                marks[_filter_place(hashes, probe, bits)] = 1
        yield pa.record_batch([pa.array([np.packbits(marks).tobytes()])], names=["marks"])

    total = np.zeros(bits // 8, np.uint8)
    for row in words.coalesce(FILTER_TASKS).mapInArrow(fill, "marks binary").toLocalIterator():
        total |= np.frombuffer(row[0], np.uint8)
    return total


def _candidates(runs: DataFrame, han_words: DataFrame) -> DataFrame:
    """(_text, at, n, word): the substrings of ``runs``(_text), from place ``at`` (from 0) and ``n`` > 1 characters long, that may be among the words."""
    per_length = {r[0]: r[1] for r in han_words.groupBy(F.length("word")).agg(F.count("*")).collect()}
    sizes = sorted(n for n in per_length if n > 1)
    shared = runs.sparkSession.sparkContext.broadcast(_word_filter(han_words, sum(per_length.values())).tobytes())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            text, starts, ends, of = _hashes(batch.column(0))
            row = np.repeat(np.arange(len(ends)), ends - starts)
            left = ends[row] - np.arange(len(row))
            for n in sizes:
                at = np.flatnonzero(left >= n)
                hashes = of(at, n)
                for probe in range(FILTER_PROBES):
                    bit = _filter_place(hashes, probe, len(marks) * 8)
                    hit = (marks[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 == 1
                    at, hashes = at[hit], hashes[hit]
                if len(at):
                    found = pa.array([text[p : p + n] for p in at.tolist()], pa.string())
                    place = pa.array((at - starts[row[at]]).astype(np.int32))
                    yield pa.record_batch([batch.column(0).take(pa.array(row[at])), place, pa.array(np.full(len(at), n, np.int32)), found], names=["_text", "at", "n", "word"])

    return runs.mapInArrow(search, "_text string, at int, n int, word string")


def explode_tokens(df: DataFrame, key: str = "id", words: str = "words") -> DataFrame:
    """One row per token: (key, pos, word).

    The outer form keeps Spark from adding a filter on the array's size, which would compute
    the segmentation a second time below the explode."""
    return df.select(key, F.posexplode_outer(words).alias("pos", "word")).where(F.col("word").isNotNull())


def tag_tokens(tokens: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Add the part-of-speech tag of each token; words outside the lexicon get ``x``."""
    tags = lexicon.select("word", "nature")
    return (
        lookup_join(tokens, tags, "word", "left")
        .withColumn("nature", F.coalesce("nature", F.lit(UNKNOWN_NATURE)))
    )


def segment_with_nature(df: DataFrame, lexicon: DataFrame, text: str = "msg", key: str = "id", **options) -> DataFrame:
    """One row per token with its tag: (key, pos, word, nature)."""
    cut = segment(df, text, "_words", lexicon=lexicon, key=key, **options)
    return tag_tokens(explode_tokens(cut, key, "_words"), lexicon).select(key, "pos", "word", "nature")


def with_user_words(lexicon: DataFrame, words: DataFrame) -> DataFrame:
    """Add user words(word, nature); they replace the lexicon's own entry of the word."""
    own = lexicon.select("word", "nature", "freq", F.lit(0).alias("_level"))
    user = words.select("word", "nature", F.lit(USER_WORD_FREQ).cast("bigint").alias("freq"), F.lit(1).alias("_level"))
    entry = F.struct("nature", "freq")
    rank = F.struct("_level", "freq", "nature")
    return own.unionByName(user).groupBy("word").agg(F.max_by(entry, rank).alias("e")).select("word", "e.nature", "e.freq")
