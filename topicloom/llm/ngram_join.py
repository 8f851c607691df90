"""N-gram Jaccard join: T-occurrence search with DivideSkip.

A text's set are its distinct five-word shingles. Two sets of n and m shingles link when they share
at least T = ceil(t / (1 + t) * (n + m)) of them. The join runs in these steps:

1. Texts with equal sets form one class; a class stands for all its copies.
2. Every set is put in one global order in which shingles of crowded cells of a counting table come
   last. Two sets that link share a shingle among the first n - ceil(t * n) + 1 of each; these short
   inverted lists are built in buckets of shingles. The other lists are the long ones of DivideSkip:
   they yield no candidates.
3. Short lists give candidate pairs, pruned by size, by place and by tables of parities. A list of
   more than ``RUN`` sets gives each set its neighbours by size and in some shuffled orders only, and
   is kept for step 5.
4. For each query set, an inverted index of its partners is searched: short lists are merged on a
   heap, candidates that the remaining long lists could still lift to T are probed there by binary
   search, and those that reach T are links. Links form components.
5. In the kept lists, all pairs of sets that are by then in different components are searched
   likewise. So no link between components is lost, and a large group of near copies, which the
   neighbours have joined, never meets itself pair by pair.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.llm.components import components, written
from topicloom.llm.texts import LOWER, NOT_SPACE, Piece, Rolling, U, Words, combine, mix, pieces, windows, bound_batches
from topicloom.operators.skew import lookup_join
from topicloom.session import cut_lineage

WORDS = 5
PERCENT = 75
CELL_BITS = 18
SLICE = 1 << 13
RUN = 8
NEAREST = 2
# Postings that a task gathers before it hands them out to the buckets, and names of sets it remembers.
FLUSH = 1 << 18
SEEN = 1 << 16
# Bytes of text that are cut into shingles at a time: some 30 bytes of arrays hang on each.
TEXT = 1 << 18
# Pairs of one kept list that are looked at together.
CELLS = 1 << 18
# Sets of one kept list that meet in one task; longer lists are cut in pairs of blocks.
BLOCK = 4_096
# Partners of a query that are indexed together.
PARTNERS = 256
MU = 0.01
# Shuffled orders in which the sets of a kept list meet their neighbours.
ORDERS = 3
POSTING = np.dtype([("token", "<u8"), ("key", "<i8"), ("n", "<u4"), ("place", "<u4")])


def shingle_sets(piece: Piece, k: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every document; fewer than ``k`` words are one shingle."""
    data = LOWER[piece.data]
    words = Words(data, piece.offsets, NOT_SPACE)
    hashes = Rolling(data).hash(words.starts, words.ends)
    starts, doc = windows(words.offsets, k)
    keys = combine(hashes, starts, k)
    bounds = np.searchsorted(doc, np.arange(len(piece) + 1))
    sets = []
    for i in range(len(piece)):
        n = int(words.counts[i])
        if n >= k:
            tokens = np.sort(keys[bounds[i] : bounds[i + 1]])
            first = np.ones(len(tokens), bool)
            first[1:] = tokens[1:] != tokens[:-1]
            sets.append(tokens[first])
        else:
            sets.append(combine(hashes, words.offsets[i : i + 1], n) if n else np.zeros(0, np.uint64))
    return sets


def _class(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def needed(n: int, m: int, percent: int = PERCENT) -> int:
    """Least number of shared shingles of sets of n and m."""
    return -(-percent * (n + m) // (100 + percent))


def divide_skip(lists: list[list[int]], t: int, mu: float = MU) -> list[tuple[int, int]]:
    """(id, count) of the ids that stand in at least ``t`` of the ascending lists.

    The longest lists are set aside: a hit must stand in t minus their number of the others. Those
    are merged on a heap that skips ids no longer reachable; hits are then looked for in the long
    lists by binary search, until the rest cannot lift them to ``t``.
    """
    lists = sorted((x for x in lists if x), key=len)
    if t < 1 or len(lists) < t:
        return []
    n_long = min(t - 1, int(t / (mu * math.log2(max(2, len(lists[-1]))) + 1)))
    short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
    least = t - len(long)
    heap = [(x[0], i, 0) for i, x in enumerate(short)]
    heapq.heapify(heap)
    found = []
    while len(heap) >= least:
        top = heap[0][0]
        popped = []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap))
        if len(popped) >= least:
            count = len(popped)
            for left, x in enumerate(reversed(long)):
                if count + len(long) - left < t:
                    break
                at = bisect_left(x, top)
                count += at < len(x) and x[at] == top
            if count >= t:
                found.append((top, count))
            aim = top + 1
        else:  # no id below the least-th smallest head can be a hit
            while heap and len(popped) < least - 1:
                popped.append(heapq.heappop(heap))
            if not heap:
                break
            aim = heap[0][0]
        for _, i, at in popped:
            at = bisect_left(short[i], aim, at)
            if at < len(short[i]):
                heapq.heappush(heap, (short[i][at], i, at))
    return found


def search(query: np.ndarray, partners: list[np.ndarray], percent: int = PERCENT) -> list[int]:
    """Places of the partners that link with ``query``."""
    tokens = np.concatenate(partners)
    owner = np.repeat(np.arange(len(partners)), [len(p) for p in partners])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    low, high = np.searchsorted(tokens, query, side="left"), np.searchsorted(tokens, query, side="right")
    lists = [owner[a:b].tolist() for a, b in zip(low.tolist(), high.tolist(), strict=True) if a < b]
    n = len(query)
    t = needed(n, min(len(p) for p in partners), percent)
    return [i for i, count in divide_skip(lists, t) if 100 * count >= percent * (n + len(partners[i]) - count)]


def parities(tokens: np.ndarray) -> bytes:
    """One bit per place of a table of at least as many places as shingles: whether an odd number of
    shingles falls there. Two tables differ in no more places than the sets in shingles."""
    size = max(64, 1 << int(max(1, len(tokens)) - 1).bit_length())
    odd = np.bincount((tokens & U(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def may_link(n: int, m: int, a: bytes, b: bytes, percent: int = PERCENT) -> bool:
    """Whether the parity tables of sets of n and m leave room for a link."""
    x, y = (np.frombuffer(z, np.uint64) for z in (a, b))
    if len(x) > len(y):
        x, y = y, x
    if len(x) < len(y):  # fold the longer table onto the shorter
        y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum()) <= n + m - 2 * needed(n, m, percent)


# --- step 1: classes, and the counting table of shingles


def _signatures(docs: DataFrame, text: str, key: str, k: int) -> DataFrame:
    """(doc_id, n, key, bits) per row; and per task its slices of the counting table (slice, bits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            for piece in pieces(batch.column(1), TEXT):
                sets = shingle_sets(piece, k)
                cells += np.bincount((np.concatenate(sets) >> U(64 - CELL_BITS)).astype(np.int64), minlength=len(cells))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(piece.rows.start, len(piece)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_class(s) for s in sets], pa.int64()),
                        pa.nulls(len(sets), pa.int32()),
                        pa.array([parities(s) for s in sets], pa.binary()),
                    ],
                    names=["doc_id", "n", "key", "slice", "bits"],
                )
        filled = [i for i in range(len(cells) // SLICE) if cells[i * SLICE : (i + 1) * SLICE].any()]
        none = pa.nulls(len(filled), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(len(filled), kind),
                none,
                none,
                pa.array(filled, pa.int32()),
                pa.array([cells[i * SLICE : (i + 1) * SLICE].astype("<u8").tobytes() for i in filled], pa.binary()),
            ],
            names=["doc_id", "n", "key", "slice", "bits"],
        )

    kind = pa.int64()
    return docs.select(F.col(key).cast("bigint").alias("doc_id"), text).mapInArrow(run, "doc_id long, n long, key long, slice int, bits binary")


def _crowded(slices: DataFrame) -> np.ndarray:
    """Cells with far more shingles than others: a table of fixed size, whatever the corpus."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[i] = sums.get(i, 0) + np.frombuffer(counts, "<u8")
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["slice", "counts"])

    counts = np.zeros(1 << CELL_BITS, np.float64)
    for i, x in slices.repartition("slice").mapInArrow(add, "slice int, counts binary").collect():
        counts[i * SLICE : (i + 1) * SLICE] += np.frombuffer(x, "<u8")
    mean = counts.mean()
    return counts > mean + 8 * math.sqrt(mean) + 64


# --- step 2 and 3: short lists and their candidate pairs


def _postings(docs: DataFrame, text: str, crowded: np.ndarray, buckets: int, k: int, percent: int) -> DataFrame:
    packed = np.packbits(crowded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = np.unpackbits(packed).view(bool)
        gathered, size, seen = [], 0, set()

        def deal() -> pa.RecordBatch:
            rows = np.concatenate(gathered)
            bucket = (rows["token"] % U(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            rows, bucket = rows[order], bucket[order]
            at = np.flatnonzero(np.diff(bucket, prepend=-1))
            blobs = [rows[a:b].tobytes() for a, b in zip(at, [*at[1:], len(rows)], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(bucket[at], pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "rows"])

        for batch in batches:
            for piece in pieces(batch.column(0), TEXT):
                for tokens in shingle_sets(piece, k):
                    n = len(tokens)
                    if not n or (name := (_class(tokens), n)) in seen:
                        continue
                    seen.add(name)
                    last = late[tokens >> U(64 - CELL_BITS)]
                    first = n + (-percent * n // 100) + 1
                    rows = np.empty(first, POSTING)
                    rows["token"] = np.concatenate([tokens[~last], tokens[last]])[:first]
                    rows["key"], rows["n"], rows["place"] = name[0], n, np.arange(first)
                    gathered.append(rows)
                    size += first
                if size >= FLUSH:
                    yield deal()
                    gathered, size = [], 0
                if len(seen) >= SEEN:
                    seen = set()
        if gathered:
            yield deal()

    return docs.select(text).mapInArrow(run, "bucket int, rows binary")


def _fits(n, m, i, j, percent: int):
    """Whether sets of n <= m shingles that first meet at places i and j may link."""
    t = -(-percent * (n + m) // (100 + percent))
    return (100 * n >= percent * m) & (np.minimum(n - i, m - j) >= t)


def _bucket_pairs(rows: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, second, kept): candidate pairs as rows of the short lists, and the lists kept for later."""
    rows = rows[np.lexsort((rows["key"], rows["n"], rows["token"]))]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows["token"][1:] != rows["token"][:-1]) | (rows["key"][1:] != rows["key"][:-1]) | (rows["n"][1:] != rows["n"][:-1])
    rows = rows[fresh]
    at = np.flatnonzero(np.diff(rows["token"], prepend=rows["token"][:1] + U(1)))
    sizes = np.diff(np.append(at, len(rows)))
    size = np.repeat(sizes, sizes)
    rows, size = rows[size > 1], size[size > 1]
    kept = size > RUN
    firsts, seconds = [], []
    n, place = rows["n"].astype(np.int64), rows["place"].astype(np.int64)
    for d in range(1, RUN):
        if d >= len(rows):
            break
        pair = (rows["token"][d:] == rows["token"][:-d]) & ~(kept[d:] & (d > NEAREST))
        i = np.flatnonzero(pair)
        if not len(i):
            break
        i = i[_fits(n[i], n[i + d], place[i], place[i + d], percent)]
        firsts.append(i)
        seconds.append(i + d)
    long = np.flatnonzero(kept)
    for turn in range(ORDERS):  # one fixed order for all lists, so that its pairs repeat from list to list
        order = long[np.lexsort((mix(rows["key"][long].view(np.uint64) + U(turn)), rows["token"][long]))]
        i, j = order[:-1], order[1:]
        i, j = np.where(n[i] <= n[j], i, j), np.where(n[i] <= n[j], j, i)
        near = (rows["token"][i] == rows["token"][j]) & _fits(n[i], n[j], place[i], place[j], percent)
        firsts.append(i[near])
        seconds.append(j[near])
    first, second = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (firsts, seconds))
    swap = (n[first] == n[second]) & (rows["key"][first] > rows["key"][second])  # one form for each pair
    first, second = np.where(swap, second, first), np.where(swap, first, second)
    code = mix(mix(rows["key"][first].view(np.uint64)) + rows["key"][second].view(np.uint64))
    _, once = np.unique(code, return_index=True)
    return rows[first[once]], rows[second[once]], rows[kept]


FOUND = "token long, a long, n int, place int, b long, m int"


def _found(first: np.ndarray, second: np.ndarray, kept: np.ndarray) -> pa.RecordBatch:
    """Pairs (token null) and kept postings (b null) as one table."""
    pairs, posts = len(first), len(kept)
    both = np.concatenate([first, kept])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([np.zeros(pairs, np.int64), kept["token"].view(np.int64)]), pa.int64(), mask=np.arange(pairs + posts) < pairs),
            pa.array(both["key"], pa.int64()),
            pa.array(both["n"].astype(np.int32), pa.int32()),
            pa.array(np.concatenate([np.zeros(pairs, np.int32), kept["place"].astype(np.int32)]), pa.int32()),
            pa.array(np.concatenate([second["key"], np.zeros(posts, np.int64)]), pa.int64(), mask=np.arange(pairs + posts) >= pairs),
            pa.array(np.concatenate([second["n"].astype(np.int32), np.zeros(posts, np.int32)]), pa.int32(), mask=np.arange(pairs + posts) >= pairs),
        ],
        names=["token", "a", "n", "place", "b", "m"],
    )


def _candidates(postings: DataFrame, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, blobs = None, []
        for batch in batches:
            for b, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if b != bucket and blobs:
                    yield _found(*_bucket_pairs(np.frombuffer(b"".join(blobs), POSTING), percent))
                    blobs = []
                bucket = b
                blobs.append(rows)
        if blobs:
            yield _found(*_bucket_pairs(np.frombuffer(b"".join(blobs), POSTING), percent))

    return postings.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, FOUND)


# --- step 4: search


def _id_parts(value: Column) -> tuple[Column, Column]:
    """An id as two columns without nulls, for joins."""
    return F.coalesce(value, F.lit(0)).alias("_id"), value.isNull().alias("_none")


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes, a < b, without those whose parity tables rule a link out."""
    bits = classes.select(F.col("key").alias("b"), F.col("n").alias("m"), F.col("bits").alias("y"))
    own = classes.select(F.col("key").alias("a"), "n", F.col("bits").alias("x"))
    met = pairs.select("a", "b").join(own.hint("merge"), "a").join(bits.hint("merge"), "b").select("a", "b", "n", "m", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = [may_link(*row, percent) for row in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))

    return met.mapInArrow(run, "a long, b long")


def _links(docs: DataFrame, text: str, key: str, pairs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b): the pairs of classes (a < b) that link, found by searching each a's partners."""
    wanted = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).distinct()
    wanted = classes.select(F.col("key").alias("a"), "rep").join(wanted, "a").select(*_id_parts(F.col("rep")))
    # While the list of ids is small enough to be broadcast, no text is shuffled.
    texts = lookup_join(docs.select(*_id_parts(F.col(key).cast("bigint")), F.col(text).alias("_text")), wanted, ["_id", "_none"], "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # an id may stand on several texts, and a text on several rows
        for batch in batches:
            for piece in pieces(batch.column(0), TEXT):
                found = {}
                for tokens in shingle_sets(piece, k):
                    if len(tokens) and (name := _class(tokens)) not in seen:
                        seen.add(name)
                        found[name] = tokens.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())], names=["b", "tokens"])

    tokens = texts.select("_text").mapInArrow(sets, "b long, tokens binary")
    # Each query also sends its own set to itself; it comes first, as b > a for all partners.
    asked = pairs.select("a", "b").unionByName(pairs.select("a", F.col("a").alias("b")).distinct())
    met = asked.join(tokens.hint("merge"), "b").select("a", "b", "tokens").repartition("a").sortWithinPartitions("a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, mine, last, ids, partners = None, None, None, [], []
        out: list[tuple[int, int]] = []

        def ask() -> None:
            if partners:
                out.extend((query, ids[i]) for i in search(mine, partners, percent))
            ids.clear()
            partners.clear()

        for batch in batches:
            for a, b, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if a != query:
                    ask()
                    query, mine, last = a, None, None
                tokens = np.frombuffer(blob, np.uint64)
                if a == b:
                    mine = tokens
                elif mine is not None and b != last:  # several tasks may send one set
                    ids.append(b)
                    partners.append(tokens)
                    last = b
                if len(partners) == PARTNERS:
                    ask()
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])
            out = []
        ask()
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return met.mapInArrow(run, "a long, b long")


# --- step 5: kept lists


def _open_lists(kept: DataFrame, parts: DataFrame) -> DataFrame:
    """(token, a, n, place, component, _blocks, _own): the kept lists that hold several components,
    with the number of blocks of a list and each row's own."""
    named = kept.join(parts.withColumnRenamed("node", "a"), "a", "left").withColumn("component", F.coalesce("component", "a"))
    sizes = named.groupBy("token").agg(F.count("*").alias("_size"), F.min("component").alias("_low"), F.max("component").alias("_high"))
    mixed = sizes.where("_low < _high").select("token", F.ceil(F.col("_size") / BLOCK).cast("int").alias("_blocks"))
    return named.join(mixed.hint("merge"), "token").withColumn("_own", F.pmod(F.xxhash64("a"), F.col("_blocks")).cast("int"))


def _across(rows: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of different components in lists of :func:`_open_lists`."""
    met = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    met = met.select("token", F.least("_own", "_other").alias("x"), F.greatest("_own", "_other").alias("y"), "_own", "a", "n", "place", "component")
    met = met.repartition("token", "x", "y").sortWithinPartitions("token", "x", "y", "n", "a")

    def group(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        x, y = rows[0][1], rows[0][2]
        own, a, n, place, part = (np.array([r[i] for r in rows], np.int64) for i in range(3, 8))
        step = max(1, CELLS // len(rows))
        for low in range(0, len(rows), step):
            i = np.arange(low, min(low + step, len(rows)))[:, None]
            j = np.arange(len(rows))[None, :]
            fits = (j > i) & (part[i] != part[j]) & _fits(n[i], n[j], place[i], place[j], percent)
            if x != y:
                fits &= own[i] != own[j]
            p, q = np.nonzero(fits)
            first, second = a[p + low], a[q]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(first, second)), pa.array(np.maximum(first, second))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, rows = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != name and rows:
                    yield from group(rows)
                    rows = []
                name = row[:3]
                rows.append(row)
        if rows:
            yield from group(rows)

    return met.mapInArrow(run, "a long, b long").distinct()


def _united(parts: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links: the links are drawn between components, which are far fewer."""
    a, b = (parts.select(F.col("node").alias(c), F.col("component").alias(f"_{c}")) for c in "ab")
    ends = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
    merged = cut_lineage(components(ends))
    old = parts.join(merged.select(F.col("node").alias("component"), F.col("component").alias("_c")), "component", "left")
    new = merged.join(parts.select("node"), "node", "left_anti")
    return cut_lineage(old.select("node", F.coalesce("_c", "component").alias("component")).unionByName(new))


def _grouped(docs: DataFrame, text: str, key: str, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, key) per row; and per class with shingles (key, n, rep, top, first): its least id, the
    least id of its component (null if no row of it has an id), and whether it stands for the component.
    """
    spark = docs.sparkSession
    marks = cut_lineage(_signatures(docs, text, key, k))
    own = marks.where("slice is null").select("doc_id", "n", "key")
    crowded = _crowded(marks.where("slice is not null").select("slice", "bits"))
    classes = marks.where("slice is null and n > 0").groupBy("key", "n").agg(F.min("doc_id").alias("rep"), F.first("bits").alias("bits"))
    classes = cut_lineage(classes)

    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = cut_lineage(_candidates(_postings(docs, text, crowded, buckets, k, percent), percent))  # a list lies in one bucket, pairs may repeat
    pairs = found.where("token is null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = cut_lineage(pairs.where("a < b").distinct())
    likely = cut_lineage(_likely(pairs, classes, percent))
    parts = cut_lineage(components(_links(docs, text, key, likely, classes, k, percent)))

    kept = cut_lineage(found.where("token is not null").select("token", "a", "n", "place"))
    asked = _across(_open_lists(kept, parts), percent).join(pairs.hint("merge"), ["a", "b"], "left_anti")
    more, size = written(_links(docs, text, key, cut_lineage(_likely(asked, classes, percent)), classes, k, percent))
    parts = _united(parts, more) if size["n"] else parts
    members = cut_lineage(classes.select("key", "n", "rep").join(parts.withColumnRenamed("node", "key").hint("merge"), "key"))
    least = members.where("rep is not null").groupBy("component").agg(F.min(F.struct("rep", "key")).alias("_least"))
    tops = members.join(cut_lineage(least).hint("merge"), "component", "left").select("key", "_least")
    of_class = classes.select("key", "n", "rep").join(tops.hint("merge"), "key", "left")
    of_class = of_class.select("key", "n", "rep", F.coalesce("_least.rep", "rep").alias("top"), F.coalesce(F.col("_least.key") == F.col("key"), F.lit(True)).alias("first"))
    return own, cut_lineage(of_class)  # so that the next join can be split where one class has most rows


def ngram_join(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``.

    Null and empty texts have no shingles and are linked with nothing: their component is their own
    id. Copies share a class. Rows that repeat an id are kept and linked each by its own text. Rows
    without an id (null) are kept and link others, but give no name to a component. A component is
    named by its least id; components that share no text may share a name if their texts share that
    id. Other columns are left out. The result is exact up to 64-bit hashes.
    """
    bound_batches(docs)
    own, of_class = _grouped(docs, text, key, k, percent)
    return own.join(of_class.select("key", "n", "top"), ["key", "n"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("top", "doc_id").alias("component_id"))


def distinct_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Of each component one row with its least id; texts without shingles once per id; all rows without an id.

    All columns are kept. An id whose rows hold texts that do not link is kept once for each of them.
    """
    own, of_class = _grouped(docs, text, key, k, percent)
    first = of_class.where("first and rep is not null").select(F.col("rep").alias("_rep"), F.col("key").alias("_class"))
    first = cut_lineage(first.unionByName(own.where("n = 0 and doc_id is not null").select(F.col("doc_id").alias("_rep"), F.col("key").alias("_class")).distinct()))
    named = docs.where(F.col(key).isNotNull()).withColumn("_rep", F.col(key).cast("bigint"))
    rows = named.join(first.select("_rep").distinct(), "_rep", "left_semi")
    # Only where an id stands on several texts must a row's class be told anew.
    many = cut_lineage(own.where("doc_id is not null").groupBy(F.col("doc_id").alias("_rep")).agg(F.min("key").alias("_low"), F.max("key").alias("_high")).where("_low < _high").select("_rep"))
    single = rows.join(many, "_rep", "left_anti").dropDuplicates(["_rep"])
    several = rows.join(many, "_rep", "left_semi")

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(at), TEXT):
                part = batch.slice(piece.rows.start, len(piece))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([_class(s) for s in shingle_sets(piece, k)], pa.int64())], names=names)

    at, names = several.columns.index(text), [*several.columns, "_class"]
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in several.schema) + ", _class long"
    told = several.mapInArrow(tell, shape).join(first, ["_rep", "_class"], "left_semi").dropDuplicates(["_rep", "_class"])
    columns = docs.columns
    return single.select(columns).unionByName(told.select(columns)).unionByName(docs.where(F.col(key).isNull()))
