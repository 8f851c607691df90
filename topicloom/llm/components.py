"""Connected components of a link table: contraction inside partitions, pointer jumps between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from topicloom.session import cut_lineage

# Links that one task contracts; rounds between tasks are needed only for more of them.
LINKS = 1 << 17


def written(df: DataFrame, *marks: Column) -> tuple[DataFrame, dict]:
    """``df`` written down, with its row count ``n`` and other aggregates, all in one job."""
    seen = Observation()
    out = cut_lineage(df.observe(seen, F.count(F.lit(1)).alias("n"), *marks))
    return out, seen.get


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) for all nodes of some links that are not the least themselves."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        for at in (a, b, label[a], label[b]):
            np.minimum.at(new, at, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    other = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[other], nodes[label[other]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns = [[c.to_numpy(zero_copy_only=False) for c in batch.columns] for batch in batches]
    if columns:
        u, v = stars(*(np.concatenate(c) for c in zip(*columns, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def components(links: DataFrame, rounds: int = 60, trace: list | None = None) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b): the least node it reaches.

    Each round turns the links of every task into stars around their least nodes before any shuffle
    (a node keeps at most one link per task), then gives every node one parent, the least of its
    partners; its other partners are hooked onto that parent, and every link's lower end jumps to its
    parent through a table of one row per node. So a round never holds more rows than links plus nodes,
    whatever the shape (hubs, chains, large groups). Self-links, repeated and mirrored links make no
    difference; an empty table gives an empty one. ``trace`` collects the rows of each round.

    The links are written down first and counted, so what yields them runs once and apart from the
    contraction. As many tasks take part in a round as there are ``LINKS`` links; once those that are left
    fit in one, its stars are the result and no shuffle follows.
    """
    edges, now = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    before = None
    for _ in range(rounds):
        tasks = max(1, -(-now["n"] // LINKS))
        local = edges.coalesce(tasks).mapInArrow(_contracted, "u long, v long")
        if tasks == 1:
            edges, now = written(local)
            if trace is not None:
                trace.append(now["n"])
            break
        best = local.groupBy("u").agg(F.min("v").alias("p"))
        hooked = (
            local.join(best, "u")
            .where(F.col("v") != F.col("p"))
            .select(F.greatest("v", "p").alias("u"), F.least("v", "p").alias("v"))
        )
        tied = best.select("u", F.col("p").alias("v")).unionByName(hooked)
        parents = best.select(F.col("u").alias("_u"), F.col("p").alias("_p"))
        jumped = tied.join(parents, F.col("v") == F.col("_u"), "left").select("u", F.coalesce("_p", "v").alias("v"))
        edges, now = written(jumped, F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"))
        if trace is not None:
            trace.append(now["n"])
        if now == before or now["n"] == 0:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    edges = edges.groupBy("u").agg(F.min("v").alias("v"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
