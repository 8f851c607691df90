"""Removal of long repeated substrings, by blockwise sorting of suffix buckets.

A byte goes when it lies in a string of ``LENGTH`` bytes (a window) that also starts elsewhere. The
windows are the suffixes to be sorted, cut off at the length that matters. They fall into buckets by
the least hash among the ``GRAM``-byte grams inside them; equal windows have equal grams, so they
share a bucket. The grams that are least in some window are a cover of the text: about one position
in 75, and any two equal windows hold one at the same distance. Windows in a row with one least gram
form a run, so a bucket holds a few runs instead of every suffix.

1. Runs are dealt to the buckets as (bucket, hash of the run's bytes, place), without text. Within
   a bucket, runs whose bytes are equal are long ties: their rank is that hash, and all their windows
   repeat. A bucket of one run is done, unless its gram occurs twice in the run.
2. What is left are runs that share a bucket with different ones, as at the ends of a repeat. Only
   these, and one of each set of equal runs, send their bytes; one bucket at a time is sorted by its
   windows' hashes, and equal neighbours repeat.
3. The places found are joined to the texts once more, which are cut and hashed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.texts import Rolling, U, mix, pieces, bound_batches
from topicloom.session import cut_lineage

LENGTH = 200
GRAM = 48
# Runs that a task gathers before it hands them out to the buckets.
FLUSH = 500_000
# Runs of a bucket that send their bytes to one task; larger buckets are split by window hash.
HOT = 20_000
SPLIT = 64
# Windows that are sorted together, if their buckets allow it.
SORTED = 2_000_000
RUN = np.dtype([("bucket", "<u8"), ("rank", "<u8"), ("key", "<i8"), ("place", "<u4"), ("n", "<u2"), ("again", "u1")])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` values in a row."""
    out, span = values, 1
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """All runs of a piece as RUN rows (``key`` unset), and the document of each."""
    width = length - gram + 1
    if len(data) < length:
        return np.zeros(0, RUN), np.zeros(0, np.int64)
    rolling = Rolling(data)
    at = np.arange(len(data) - gram + 1)
    grams = rolling.hash(at, at + gram)
    least = _least(grams, width)
    valid = np.zeros(len(least) + 1, np.int8)  # windows inside one document
    sizes = np.diff(offsets)
    long = sizes >= length
    np.add.at(valid, offsets[:-1][long], 1)
    np.add.at(valid, np.minimum(offsets[1:][long] - length + 1, len(least)), -1)
    valid = np.cumsum(valid)[:-1] > 0
    starts = valid.copy()
    starts[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
    first = np.flatnonzero(starts)
    ends = valid.copy()
    ends[:-1] &= starts[1:] | ~valid[1:]
    n = np.flatnonzero(ends) + 1 - first
    parts = -(-n // width)  # long runs (periodic text) are cut
    of = np.repeat(np.arange(len(first)), parts)
    step = np.arange(len(of)) - (np.cumsum(parts) - parts)[of]
    first, n = first[of] + step * width, np.minimum(n[of] - step * width, width)
    rows = np.zeros(len(first), RUN)
    rows["bucket"], rows["rank"], rows["n"] = least[first], rolling.hash(first, first + n - 1 + length), n
    for low in range(0, len(first), 2_048):  # does the gram occur again in the run?
        a, m = first[low : low + 2_048, None], n[low : low + 2_048, None]
        step = np.arange(2 * width - 1)[None, :]
        inside = step < m + width - 1
        found = (grams[np.minimum(a + step, len(grams) - 1)] == least[a]) & inside
        rows["again"][low : low + 2_048] = found.sum(axis=1) > 1
    doc = np.searchsorted(offsets, first, side="right") - 1
    rows["place"] = first - offsets[doc]
    return rows, doc


def _dealt(docs: DataFrame, buckets: int, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0

        def deal() -> pa.RecordBatch:
            rows = np.concatenate(gathered)
            to = (rows["bucket"] % U(buckets)).astype(np.int32)  # least hashes are small, their low bits are even
            order = np.argsort(to, kind="stable")
            rows, to = rows[order], to[order]
            at = np.flatnonzero(np.diff(to, prepend=-1))
            blobs = [rows[a:b].tobytes() for a, b in zip(at, [*at[1:], len(rows)], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(to[at], pa.int32()), pa.array(blobs, pa.binary())], names=["part", "rows"])

        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for piece in pieces(batch.column(1)):
                rows, doc = runs(piece.data, piece.offsets, length, gram)
                rows["key"] = keys[piece.rows.start + doc]
                gathered.append(rows)
                size += len(rows)
                if size >= FLUSH:
                    yield deal()
                    gathered, size = [], 0
        if size:
            yield deal()

    return docs.select("_key", "_text").mapInArrow(run, "part int, rows binary")


TIED = "key long, place int, n int, bucket long, solved boolean, shown boolean, hot boolean"


def _tied(dealt: DataFrame, hot: int) -> DataFrame:
    """Runs that share a bucket with others: ``solved`` ones repeat whole, ``shown`` ones send their bytes."""

    def sort(blobs: list[bytes]) -> pa.RecordBatch:
        rows = np.frombuffer(b"".join(blobs), RUN)
        rows = rows[np.lexsort((rows["rank"], rows["bucket"]))]
        new_bucket = np.ones(len(rows), bool)
        new_bucket[1:] = rows["bucket"][1:] != rows["bucket"][:-1]
        new_rank = new_bucket.copy()
        new_rank[1:] |= (rows["rank"][1:] != rows["rank"][:-1]) | (rows["n"][1:] != rows["n"][:-1])
        bucket, rank = np.cumsum(new_bucket) - 1, np.cumsum(new_rank) - 1
        solved = np.bincount(rank)[rank] > 1
        different = np.bincount(bucket[new_rank])  # sets of equal runs in the bucket
        # A bucket is open if a run stands alone in it beside others, or repeats its gram.
        is_open = (np.bincount(bucket, ~solved) > 0) & ((different > 1) | (np.bincount(bucket, rows["again"]) > 0))
        shown = is_open[bucket] & new_rank
        large = different[bucket] > hot
        use = solved | shown
        rows, solved, shown, large = rows[use], solved[use], shown[use], large[use]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(rows["key"], pa.int64()),
                pa.array(rows["place"].astype(np.int32), pa.int32()),
                pa.array(rows["n"].astype(np.int32), pa.int32()),
                pa.array(rows["bucket"].astype(np.int64), pa.int64()),
                pa.array(solved),
                pa.array(shown),
                pa.array(large),
            ],
            names=["key", "place", "n", "bucket", "solved", "shown", "hot"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blobs = None, []
        for batch in batches:
            for p, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if p != part and blobs:
                    yield sort(blobs)
                    blobs = []
                part = p
                blobs.append(rows)
        if blobs:
            yield sort(blobs)

    return dealt.repartition("part").sortWithinPartitions("part").mapInArrow(run, TIED)


def _sent(docs: DataFrame, tied: DataFrame, length: int) -> DataFrame:
    """(bucket, key, place, n, solved, body): the bytes of the shown runs; of runs in hot buckets the
    hashes of their windows instead, dealt by hash (``body`` holds (hash, place) pairs, n is 0)."""
    shown = tied.where("shown").groupBy("key").agg(F.collect_list(F.struct("place", "n", "bucket", "solved", "hot")).alias("_runs"))
    # The id goes along, so that this shuffle of the texts is the one of the last join.
    joined = docs.join(shown.withColumnRenamed("key", "_key"), "_key").select("_key", "_text", "_runs", "_id")
    names = ["bucket", "key", "place", "n", "solved", "body"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            size = 0
            for key, text, listed in zip(*batch.columns[:3], strict=True):
                data, key = text.as_py().encode("utf-8", "surrogatepass"), key.as_py()
                for r in listed.as_py():
                    body = data[r["place"] : r["place"] + r["n"] - 1 + length]
                    if r["hot"]:
                        one = Rolling(np.frombuffer(body, np.uint8))
                        at = np.arange(r["n"])
                        hashes = one.hash(at, at + length)
                        to = hashes % U(SPLIT)
                        for part in np.unique(to).tolist():
                            mine = to == part
                            pairs = np.stack([hashes[mine], (at[mine] + r["place"]).astype(np.uint64)], axis=1).tobytes()
                            code = int(mix(np.array([r["bucket"]], np.int64).view(np.uint64) + U(part)).view(np.int64)[0])
                            out.append((code, key, r["place"], 0, r["solved"], pairs))
                            size += len(pairs)
                    else:
                        out.append((r["bucket"], key, r["place"], r["n"], r["solved"], body))
                        size += len(body)
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                        out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return joined.mapInArrow(run, "bucket long, key long, place int, n int, solved boolean, body binary")


def _repeats(sent: DataFrame, length: int) -> DataFrame:
    """(key, start, end): stretches of unsolved runs whose windows repeat within their bucket."""

    def windows(row: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and places of the windows of a run."""
        _, _, place, n, _, body = row
        if n == 0:
            pairs = np.frombuffer(body, np.uint64).reshape(-1, 2)
            return pairs[:, 0], pairs[:, 1].astype(np.int64)
        at = np.arange(n)
        return Rolling(np.frombuffer(body, np.uint8)).hash(at, at + length), at + place

    def sort(rows: list[tuple]) -> pa.RecordBatch:
        found = [windows(r) for r in rows]
        of = np.repeat(np.arange(len(rows)), [len(h) for h, _ in found])
        bucket = np.array([r[0] for r in rows], np.int64).view(np.uint64)
        codes = mix(np.concatenate([h for h, _ in found]) + mix(bucket)[of])
        places = np.concatenate([p for _, p in found])
        order = np.argsort(codes)
        same = codes[order][1:] == codes[order][:-1]
        twice = np.zeros(len(codes), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        twice &= ~np.array([r[4] for r in rows], bool)[of]
        hit = np.flatnonzero(twice)
        new = np.ones(len(hit), bool)
        new[1:] = (of[hit][1:] != of[hit][:-1]) | (places[hit][1:] != places[hit][:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(hit)) - 1 if len(hit) else first
        key = np.array([r[1] for r in rows], np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(key[of[hit[first]]]), pa.array(places[hit[first]]), pa.array(places[hit[last]] + length)], names=["key", "start", "end"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, bucket = [], 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != bucket and size >= SORTED:
                    yield sort(rows)
                    rows, size = [], 0
                bucket = row[0]
                rows.append(row)
                size += max(row[3], len(row[5]) // 16 if row[3] == 0 else 0)
        if rows:
            yield sort(rows)

    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "key long, start long, end long")


def merge(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches joined where they overlap or touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(pairs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def dedup_substrings(
    docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, gram: int = GRAM, hot: int = HOT, kept_text: bool = False
) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256[, kept]) per row.

    ``kept`` holds the remaining bytes. Null and empty texts have no bytes; texts shorter than
    ``length`` bytes keep all. Rows that repeat id and text are documents like others: they remove
    each other. Other columns are left out. Exact up to 64-bit hashes.
    """
    bound_batches(docs)
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(F.col(key).alias("_id"), body.alias("_text"), F.xxhash64(F.col(key), body).alias("_key"))
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    tied = cut_lineage(_tied(_dealt(own, buckets, length, gram), hot))
    solved = tied.where("solved").select("key", F.col("place").cast("bigint").alias("start"), (F.col("place") + F.col("n") - 1 + length).cast("bigint").alias("end"))
    # From here on one plan: both joins with the texts take the same shuffle of them.
    found = solved.unionByName(_repeats(_sent(own, tied, length), length))
    spans = found.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("_spans")).withColumnRenamed("key", "_key")
    names = [key, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                out = []
                for body, listed in zip(part.column(1), part.column(2), strict=True):
                    data = body.as_py().encode("utf-8", "surrogatepass")
                    gone = merge([(s["start"], s["end"]) for s in listed.as_py() or ()])
                    edges = [0, *(x for pair in gone for x in pair), len(data)]
                    rest = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    out.append((len(data), len(data) - len(rest), len(gone), hashlib.sha256(rest).hexdigest(), rest if kept_text else None))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))], names=names
                )

    shape = f"`{key}` {docs.schema[key].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    done = own.join(spans, "_key", "left").select("_id", "_text", "_spans").mapInArrow(cut, shape)
    return done if kept_text else done.drop("kept")
