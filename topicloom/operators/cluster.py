"""Agglomeration of documents by rounds of greedy pair merging, and what hangs on clusters.

A cluster is known by ``cid``: the id of its first document, followed by a bar once it has more
members. Text order of cids equals text order of the full ids joined by bars. Membership is a
long table, because one cluster may hold any share of the documents.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from topicloom.functions.vectors import truncate6, vec_add, vec_norm, vec_normalize
from topicloom.operators.filters import drop_rule_words, min_cluster_size
from topicloom.operators.similarity import BLOCK_ROWS, best_partner
from topicloom.operators.skew import dense_index, ranked_within, salted_join
from topicloom.session import cut_lineage, scratch_path

BAR = "|"


def greedy_matching(pairs: DataFrame) -> DataFrame:
    """Accept pairs (id, partner) by ascending id when neither end was used before.

    Each id proposes at most one larger partner, so proposals form a forest in which
    ``taken(v) = some child u is not taken`` and the pair kept for ``v`` is that of the smallest
    such ``u``. Leaves are decided first; a node that waits for a single child follows it
    directly, and such links are halved by pointer doubling. The number of rounds therefore
    grows with the logarithm of the forest, also for a chain of millions of copies.
    """
    spark = pairs.sparkSession
    edges = pairs.select("id", F.col("partner").alias("parent"))
    roots = edges.select(F.col("parent").alias("id")).distinct().join(edges.select("id"), "id", "left_anti")
    state = edges.unionByName(roots.withColumn("parent", F.lit(None).cast("string"))).select(
        "id",
        "parent",
        F.lit(None).cast("string").alias("ref"),
        F.lit(False).alias("odd"),
        F.lit(None).cast("boolean").alias("taken"),
    )
    # Each round is written beside the others and all are read as one table: the plan of a round, and what
    # the driver keeps of it, is the same however many rounds went before.
    folder, shape = scratch_path(spark, "matching"), state.schema
    turn, waiting, settled = 0, True, None
    while waiting:
        path = f"{folder}/round={turn}"
        seen = Observation()
        state.observe(seen, F.count_if(F.col("taken").isNull()).alias("open")).write.parquet(path)
        waiting = seen.get["open"] > 0
        settled = spark.read.schema(shape).parquet(folder).drop("round").where(F.col("taken").isNotNull())
        state = _decide(spark.read.schema(shape).parquet(path), settled)
        turn += 1
    free = settled.where(~F.col("taken") & F.col("parent").isNotNull())
    return free.groupBy("parent").agg(F.min("id").alias("id")).select("id", F.col("parent").alias("partner"))


def _decide(state: DataFrame, settled: DataFrame | None) -> DataFrame:
    """One round. ``state`` holds the undecided nodes and those decided in the last round; links
    may lead to a node decided in any round, all of which are in ``settled`` (None before the first)."""
    below = (
        state.where("parent is not null")
        .groupBy(F.col("parent").alias("id"))
        .agg(
            F.count_if(F.col("taken").isNull()).alias("open"),
            F.min(F.when(F.col("taken").isNull(), F.col("id"))).alias("only"),
            F.bool_or(F.coalesce(~F.col("taken"), F.lit(False))).alias("struck"),
        )
    )
    open_nodes = state.where("taken is null")
    seen = (open_nodes if settled is None else open_nodes.unionByName(settled)).select(
        F.col("id").alias("ref"), F.col("ref").alias("ref_ref"), F.col("odd").alias("ref_odd"), F.col("taken").alias("ref_taken")
    )
    # Nodes without a link yet get a key of their own that meets nothing, so they spread over all tasks.
    key = F.coalesce("ref", F.concat(F.lit("\0"), F.col("id"))).alias("_key")
    # Merge joins: rounds are many, and every table sent to all executors would pass the driver and stay there.
    waiting = open_nodes.drop("taken").join(below.hint("merge"), "id", "left").select("*", key)
    live = waiting.join(seen.withColumnRenamed("ref", "_key").hint("merge"), "_key", "left").drop("_key")
    differs = F.col("odd") != F.col("ref_taken")
    taken = (
        F.when(F.col("struck"), True)
        .when(F.coalesce("open", F.lit(0)) == 0, False)
        .when(F.col("ref_taken").isNotNull(), differs)
    )
    first_link = F.col("ref").isNull() & (F.col("open") == 1)
    jump = F.col("ref_ref").isNotNull()
    return live.select(
        "id",
        "parent",
        F.when(first_link, F.col("only")).when(jump, F.col("ref_ref")).otherwise(F.col("ref")).alias("ref"),
        F.when(first_link, True).when(jump, F.col("odd") != F.col("ref_odd")).otherwise(F.col("odd")).alias("odd"),
        taken.alias("taken"),
    )


def merged_cid(cid: Column) -> Column:
    return F.when(cid.endswith(BAR), cid).otherwise(F.concat(cid, F.lit(BAR)))


def merge_pairs(docs: DataFrame, matching: DataFrame, mode: str = "sum") -> DataFrame:
    """Replace each accepted pair by one row and keep all other rows: (id, vec, norm, size).

    ``sum`` adds the vectors and recomputes the norm; ``unit`` brings the sum back to length 1
    and cuts it to six decimals.
    """
    if mode not in ("sum", "unit"):
        raise ValueError(f"unknown mode: {mode}")
    mate = docs.select(F.col("id").alias("partner"), F.col("vec").alias("_v"), F.col("size").alias("_s"))
    joined = matching.select("id", "partner").join(docs, "id").join(mate, "partner")
    total = vec_add("vec", "_v")
    vec = truncate6(vec_normalize(total)) if mode == "unit" else total
    pairs = joined.select(merged_cid(F.col("id")).alias("id"), vec.alias("vec"), (F.col("size") + F.col("_s")).alias("size"))
    used = matching.select("id").unionByName(matching.select(F.col("partner").alias("id")))
    rest = docs.join(used, "id", "left_anti").select("id", "vec", "norm", "size")
    return rest.unionByName(pairs.select("id", "vec", vec_norm("vec").alias("norm"), "size"))


@dataclass
class Clusters:
    """Result of :func:`subject_clusters`: the cluster table and the merges of each round."""

    table: DataFrame
    merges: list[DataFrame] = field(default_factory=list)

    def members(self) -> DataFrame:
        """(cid, member, place): the documents of each cluster; ``place`` sorts them as the
        joined id lists them.

        The merge tree is followed from the top, where a parent has two children: no join key
        ever has more than two rows, however large a cluster is.
        """
        level = self.table.select(F.col("id").alias("now"), F.col("id").alias("cid"), F.lit("").alias("place"))
        for merge in reversed(self.merges):
            kids = merge.select(
                merged_cid(F.col("id")).alias("now"), F.explode(F.array(F.struct("id", F.lit("0").alias("side")), F.struct(F.col("partner").alias("id"), F.lit("1").alias("side")))).alias("kid")
            )
            split = level.join(kids, "now", "left")
            level = split.select(
                F.coalesce("kid.id", "now").alias("now"), "cid", F.concat("place", F.coalesce("kid.side", F.lit("0"))).alias("place")
            )
        return level.select("cid", F.col("now").alias("member"), "place")


def subject_clusters(
    docs: DataFrame,
    thres: float,
    rounds: int = 1,
    mode: str = "sum",
    key: str = "id",
    block_rows: int = BLOCK_ROWS,
) -> Clusters:
    """Merge similar documents in rounds; stops early when no pair is left.

    ``sum``: most similar partner by cosine, vectors added. ``unit``: first similar partner by
    dot product of unit vectors, the mean brought back to length 1.
    """
    vec = F.col("vec").cast("array<double>")
    vec = truncate6(vec) if mode == "unit" else vec
    ids = F.regexp_replace(F.col(key).cast("string"), ",", BAR)
    table = cut_lineage(
        docs.select(ids.alias("id"), vec.alias("vec")).select("id", "vec", vec_norm("vec").alias("norm"), F.lit(1).cast("bigint").alias("size"))
    )
    pick, measure = ("first", "dot") if mode == "unit" else ("max", "cosine")
    merges: list[DataFrame] = []
    for _ in range(rounds):
        proposals = cut_lineage(best_partner(table, thres, pick, measure, block_rows=block_rows).select("id", "partner"))
        matching = cut_lineage(greedy_matching(proposals))
        if matching.isEmpty():
            break
        table = cut_lineage(merge_pairs(table, matching, mode))
        merges.append(matching)
    return Clusters(table, merges)


def assign_class_id(clusters: DataFrame, dense: bool = True, cid: str = "id") -> DataFrame:
    """Add ``class_id``: the place in cid order, or a stable hash of the cid."""
    if dense:
        return dense_index(clusters, [cid], "class_id")
    return clusters.withColumn("class_id", F.xxhash64(cid))


def class_members(members: DataFrame, classes: DataFrame, cid: str = "id") -> DataFrame:
    """(class_id, member, place) of clusters numbered by :func:`assign_class_id`.

    The number is joined to each cluster's first member and handed down by ``cid``; large
    clusters are cut in pieces by their known size."""
    named = classes.select(F.col(cid).alias("cid"), "class_id", "size")
    return salted_join(members, named, "cid", heat="size").select("class_id", "member", "place")


def cluster_ids_text(members: DataFrame, key: str = "class_id") -> DataFrame:
    """(class_id, ids): member ids joined by bars, for the export of clusters whose ids fit a row.

    Everything else works on the long table, which has no such bound."""
    ordered = F.sort_array(F.collect_list(F.struct("place", "member")))
    return members.groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["member"]), BAR).alias("ids"))


def doc_labels(members: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, class_id, msg, words) of the clustered documents."""
    own = members.select(F.col("member").alias("id"), "class_id")
    return own.join(docs, "id").select("id", "class_id", "msg", "words")


def lookup_doc_words(members: DataFrame, doc_words: DataFrame) -> DataFrame:
    """(class_id, member, word, weight) of members with known words; ``doc_words`` holds
    (id, words) with plain words (weight 1) or (word, weight) items."""
    weighted = "struct" in doc_words.schema["words"].dataType.simpleString()
    found = members.join(doc_words.select(F.col("id").alias("member"), "words"), "member")
    item = F.explode("words").alias("w")
    if weighted:
        return found.select("class_id", "member", item).select("class_id", "member", "w.word", "w.weight")
    return found.select("class_id", "member", item).select("class_id", "member", F.col("w").alias("word"), F.lit(1).cast("bigint").alias("weight"))


def missing_members(members: DataFrame, doc_words: DataFrame) -> DataFrame:
    """Members that have no entry in the word table."""
    return members.join(doc_words.select(F.col("id").alias("member")), "member", "left_anti").select("class_id", "member")


def cluster_words(
    members: DataFrame, doc_words: DataFrame, rules: DataFrame | None = None, min_size: int | None = None
) -> DataFrame:
    """(class_id, word, weight, rank): counts or summed weights of the words of each cluster, ranked by
    falling weight (to six digits), then by word.

    ``rules`` drops words switched off by the rule table; ``min_size`` keeps clusters of more
    members. Sums are built before the shuffle and per word, so no task holds a cluster."""
    kept = members if min_size is None else min_cluster_size(members, min_size)
    words = lookup_doc_words(kept, doc_words)
    if rules is not None:
        words = drop_rule_words(words, rules)
    sums = words.groupBy("class_id", "word").agg(F.sum("weight").alias("weight"))
    return ranked_within(sums, "class_id", [F.round("weight", 6).desc(), F.asc("word")])
