"""Mixing sources to target weights.

Every source's documents are laid end to end and cut into blocks of a fixed number of tokens. The
mix is a row of slots, grouped in output shards; each shard draws how many of its slots each
source fills (its exact share rounded down, the rest by a multinomial draw), so shards are built
independently and yet each holds the mix. The slots of a source are mapped through a pseudorandom
permutation of its block numbers, once round after the other, and blocks are joined by number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm.texts import U, mix
from topicloom.session import cut_lineage

BLOCK = 64
SLOTS_PER_SHARD = 4_096
# Pieces into which each source is cut to number its tokens.
PIECES = 4_096
# Shards whose draws are summed up in one go.
SHARDS_PER_GROUP = 1_024
# Sources pass through the driver, one row each; the weights are one per source in any case.
MAX_SOURCES = 200_000
ROUNDS = 4


def target_sizes(sizes: Sequence[int], weights: Sequence[float], most: float) -> list[float]:
    """Shares of the total size by weight; none above ``most`` times its own size, the excess going
    to the others by weight."""
    total, targets = float(sum(sizes)), [0.0] * len(sizes)
    free = [i for i in range(len(sizes)) if sizes[i] > 0]
    left = total
    while free:
        weight = sum(weights[i] for i in free)
        full = [i for i in free if left * weights[i] / weight > most * sizes[i]]
        if not full:
            for i in free:
                targets[i] = left * weights[i] / weight
            break
        for i in full:
            targets[i] = most * sizes[i]
        left -= sum(targets[i] for i in full)
        free = [i for i in free if i not in set(full)]
    return targets


def permuted(index: np.ndarray, size: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Pseudorandom permutation of 0..size-1 at ``index`` (a Feistel network over the next power of
    four; numbers outside are sent through again)."""
    bits = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (U(1) << bits) - U(1)
    x, limit = index.astype(np.uint64), size.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        v, b, m, s = x[todo], bits[todo], mask[todo], seed[todo]
        left, right = v >> b, v & m
        for r in range(ROUNDS):
            left, right = right, left ^ (mix(right + s * U(2 * r + 1)) & m)
        x[todo] = (left << b) | right
        todo = todo[x[todo] >= limit[todo]]
    return x.astype(np.int64)


def _draws(spark, shares: np.ndarray, slots: int, per_shard: int, seed: int) -> DataFrame:
    """(shard, sid, n): slots of each source in each shard."""
    shards = -(-slots // per_shard)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"]:
                size = min(per_shard, slots - shard * per_shard)
                exact = shares * size
                n = np.floor(exact).astype(np.int64)
                rest = exact - n
                if (missing := int(size - n.sum())) > 0 and rest.sum() > 0:
                    n += np.random.default_rng([seed, shard]).multinomial(missing, rest / rest.sum())
                used = np.flatnonzero(n)
                yield pd.DataFrame({"shard": np.full(len(used), shard), "sid": used.astype(np.int32), "n": n[used]})

    return spark.range(shards).mapInPandas(run, "shard long, sid int, n long")


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    most: float = 3.0,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    block: int = BLOCK,
    per_shard: int = SLOTS_PER_SHARD,
    seed: int = 20_240_607,
) -> DataFrame:
    """Per document: (key, size, source_size, target, taken).

    ``size`` is the number of words (null text: 0). Sources take the weights in turn, in the order
    of their code points, null last. ``taken`` is the number of words that the mix takes from the
    document, repeats counted: at most ``most`` times its size, as no block is used more often.
    Documents without words, and repeated rows (each counts for itself), are kept in the result.
    The same rows give the same mix, however they are partitioned.
    """
    spark = docs.sparkSession
    rows = cut_lineage(
        docs.select(
            F.col(key).alias("_key"),
            F.col(source).alias("_source"),
            F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint").alias("size"),
        )
    )
    sources = rows.groupBy("_source").agg(F.sum("size").alias("source_size")).limit(MAX_SOURCES + 1).collect()
    if len(sources) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    # Order of code points: that of UTF-8 bytes.
    sources.sort(key=lambda r: (r[0] is None, (r[0] or "").encode("utf-8", "surrogatepass")))
    sizes = [r[1] for r in sources]
    targets = target_sizes(sizes, [weights[i % len(weights)] for i in range(len(sizes))], most)
    blocks = np.array([-(-s // block) for s in sizes], np.int64)
    uses = np.array([t * b / s if s else 0.0 for t, b, s in zip(targets, blocks, sizes, strict=True)])
    slots = int(round(uses.sum()))
    shares = uses / uses.sum() if uses.sum() else uses
    known = pd.DataFrame({"sid": range(len(sizes)), "_source": [r[0] for r in sources], "source_size": sizes, "target": targets})
    table = F.broadcast(spark.createDataFrame(known.astype({"_source": object}), "sid int, _source string, source_size long, target double"))
    named = rows.join(table, rows["_source"].eqNullSafe(table["_source"])).select("_key", "sid", "size", "source_size", "target")

    # Token numbers: offsets of the pieces of a source, then running sums inside a piece.
    cut = named.withColumn("_piece", F.pmod(F.xxhash64("_key"), F.lit(PIECES)).cast("int"))
    before = Window.partitionBy("sid").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.groupBy("sid", "_piece").agg(F.sum("size").alias("_n")).select("sid", "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("sid", "_piece").orderBy("_key", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.withColumn("_from", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, ["sid", "_piece"])
    placed = cut_lineage(
        placed.select("_key", "sid", "size", "source_size", "target", (F.col("_from") + F.col("_start")).alias("_at")).withColumn("_row", F.monotonically_increasing_id())
    )

    # Slots: number of the first slot of each source in each shard, in two levels.
    draws = cut_lineage(_draws(spark, shares, slots, per_shard, seed).withColumn("_group", F.floor(F.col("shard") / SHARDS_PER_GROUP)))
    earlier = Window.partitionBy("sid").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = draws.groupBy("sid", "_group").agg(F.sum("n").alias("_n")).select("sid", "_group", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    within = Window.partitionBy("sid", "_group").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    first = draws.withColumn("_from", F.coalesce(F.sum("n").over(within), F.lit(0))).join(groups, ["sid", "_group"])
    first = first.select("shard", "sid", "n", (F.col("_from") + F.col("_start")).alias("slot"))
    limits = np.floor(most * blocks + 1e-9).astype(np.int64)

    def map_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sid, n, slot = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            of = np.repeat(np.arange(len(n)), n)
            number = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + slot[of]
            s = sid[of].astype(np.int64)
            fits = number < limits[s]  # a draw may pass the limit by a slot or two
            s, number = s[fits], number[fits]
            turn, index = np.divmod(number, blocks[s])
            code = mix(U(seed) + mix(s.astype(np.uint64)) + turn.astype(np.uint64) * U(0x9E3779B97F4A7C15))
            yield pa.RecordBatch.from_arrays([pa.array(s.astype(np.int32)), pa.array(permuted(index, blocks[s], code))], names=["sid", "_block"])

    used = first.mapInArrow(map_slots, "sid int, _block long").groupBy("sid", "_block").agg(F.count("*").alias("_times"))

    # Blocks of each document, with the words it has in them.
    of_doc = placed.where("size > 0").select(
        "_row", "sid", "size", "_at", F.explode(F.sequence(F.floor(F.col("_at") / block), F.floor((F.col("_at") + F.col("size") - 1) / block))).alias("_block")
    )
    low = F.greatest(F.col("_at"), F.col("_block") * block)
    high = F.least(F.col("_at") + F.col("size"), (F.col("_block") + 1) * block)
    shared = of_doc.select("_row", "sid", "_block", (high - low).alias("_words"))
    # The draws' table is estimated by its few shards, so the planner would broadcast all slots.
    shared = shared.join(used.hint("merge"), ["sid", "_block"])
    taken = shared.groupBy("_row").agg(F.sum(F.col("_words") * F.col("_times")).alias("taken"))
    return placed.join(taken.hint("merge"), "_row", "left").select(
        F.col("_key").alias(key), "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken")
    )
