"""Source divergence audit: how far each source's term distribution lies from the others of its language.

Method (duplicate-text collapse): identical texts of one language are grouped first, with their
multiplicity per source (two 64-bit hashes name a text; map-side aggregation folds copies before any
shuffle). Each distinct text is tokenized once; its term counts are weighted by those multiplicities
into document frequencies and counts. Pairs are then evaluated from the sparse nonzero
(source, term) entries: the kept terms of a language are dealt in blocks, each block meets the list
of its language's sources, a missing entry takes its source's baseline (the p of count 0), and the
pair sums of a block are integer matrix sums in numpy. Only S^2 partial sums per block are shuffled
(S sources of the language), never one row per entry and other source.

Definitions (all arithmetic on integers): text, lang and source read null as ''. Terms are matches of
``TERM`` with A-Z lower-cased. A language keeps its ``V`` terms found in at least ``MIN_DOCS`` of its
documents (rows, copies counted). For a group (a lang and source pair, or a whole lang) and a kept
term with ``count`` occurrences, ``p = 1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V))``, ``N``
the group's occurrences of kept terms.

* part ``pair``: per group, item = each other source of the language, value = sum over kept terms of
  ``|p - q|`` (``q`` that source's p; 0 when V = 0), all ranks.
* part ``term``: item = a kept term with count > 0 in the group whose p exceeds the language's q,
  value = p - q, the first ``TOP_TERMS`` ranks.

Rank: from 1 per (lang, source, part), value descending, then item ascending in UTF-8.

Special rows: every occurring group appears, one with no terms too (its pair rows, if the language
has other sources). A language with one source has no pair rows. Empty tables give no rows. Repeated
rows count as documents each time. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from topicloom.operators.skew import lookup_join, top_per_group
from topicloom.session import cut_lineage, scratch_path

# Fixed values of the contract.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 30
SMOOTH = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
# Cells (sources x terms) of one block of the pair evaluation.
BLOCK_CELLS = 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_BIG = "decimal(38,0)"


def _p(count: Column, total: Column, vocab: Column) -> Column:
    """1 + floor(SCALE (count + SMOOTH) / (N + SMOOTH V)), exactly (integer ``div`` of decimals)."""
    num = F.lit(SCALE).cast(_BIG) * (count + SMOOTH).cast(_BIG)
    den = (total + F.lit(SMOOTH) * vocab).cast(_BIG)
    # null where N + SMOOTH V is 0, that is without kept terms
    return F.when(den > 0, F.lit(1).cast("bigint") + F.call_function("div", num, F.when(den > 0, den)).cast("bigint"))


def collapse(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(multiplicities: lang, _h, source, m), (term counts of each distinct text: lang, _h, term, tf).

    ``_h`` is a 128-bit name of the text (two 64-bit hashes)."""
    d = docs.select(
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(F.col("lang"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source"), F.lit("")).alias("source"),
    ).withColumn("_h", F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b")))
    mult = d.groupBy("lang", "_h", "source").agg(F.count(F.lit(1)).alias("m"))
    distinct = d.select("lang", "_h", "text").dropDuplicates(["lang", "_h"])
    # terms are the pieces between runs of the other characters; lower-casing A-Z first keeps classes as they are
    pieces = F.split(F.translate("text", UPPER, LOWER), GAP, -1)
    terms = (
        distinct.select("lang", "_h", F.explode(pieces).alias("term"))
        .where(F.col("term") != "")
        .groupBy("lang", "_h", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    return mult, terms


def _written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read again: texts are tokenized once."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _pair_sums(nz: DataFrame, table: DataFrame) -> DataFrame:
    """``lang, source, other, value``: sum over kept terms of |p - q| for every two sources of a language.

    The kept terms of a language are dealt in blocks of about ``BLOCK_CELLS / S`` terms (S its
    sources). A block meets the list of its language's sources with their baselines; in it, a source
    without an entry for a term takes its baseline ``p0``, and the pair sums over the block's terms
    are integer matrix sums. Every kept term has an entry somewhere, so the blocks cover all kept
    terms, and only S^2 partial sums per block are shuffled."""
    shape = table.groupBy("lang").agg(F.count(F.lit(1)).alias("S"), F.max("V").alias("V"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("V") * F.col("S") / F.lit(BLOCK_CELLS))).cast("bigint")
    shape = shape.withColumn("blocks", blocks).where(F.col("V") > 0)
    entries = lookup_join(nz.select("lang", "source", "term", "p"), shape.select("lang", "blocks"), "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), "source", "term", "p"
    )
    sources = lookup_join(table.select("lang", "source", "p0"), shape.select("lang", "blocks"), "lang").select(
        "lang", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"), "source", "p0"
    )

    def evaluate(key, e: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        if not len(e) or not len(s):
            return pd.DataFrame({"lang": [], "source": [], "other": [], "value": []})
        names = s["source"].to_numpy(dtype=object)
        place = {name: i for i, name in enumerate(names)}
        terms, column = np.unique(e["term"].to_numpy(dtype=object), return_inverse=True)
        p = np.repeat(s["p0"].to_numpy(np.int64)[:, None], len(terms), axis=1)
        p[[place[x] for x in e["source"]], column] = e["p"].to_numpy(np.int64)
        n = len(names)
        sums = np.zeros((n, n), np.int64)
        step = max(1, BLOCK_CELLS // max(1, n * len(terms)))
        for lo in range(0, n, step):
            sums[lo : lo + step] = np.abs(p[lo : lo + step, None, :] - p[None, :, :]).sum(axis=2)
        a, b = np.nonzero(~np.eye(n, dtype=bool))
        return pd.DataFrame({"lang": key[0], "source": names[a], "other": names[b], "value": sums[a, b]})

    partial = entries.groupBy("lang", "block").cogroup(sources.groupBy("lang", "block")).applyInPandas(
        evaluate, "lang string, source string, other string, value long"
    )
    return partial.groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """Rows ``lang, source, part, item, value, rank`` (see the module)."""
    mult, terms = collapse(docs)
    groups = mult.groupBy("lang", "source").agg(F.lit(1).alias("_one")).drop("_one")
    weighted = terms.join(mult, ["lang", "_h"])
    counts = weighted.groupBy("lang", "source", "term").agg(F.sum(F.col("tf") * F.col("m")).alias("count"), F.sum("m").alias("docs"))
    # a term's rows over the sources of its language (at most one per source) give its document frequency
    over = Window.partitionBy("lang", "term")
    entries = _written(
        counts.withColumn("lang_docs", F.sum("docs").over(over))
        .withColumn("lang_count", F.sum("count").over(over))
        .where(F.col("lang_docs") >= min_docs)
        .select("lang", "source", "term", "count", "lang_count"),
        "divergence",
    )
    kept = entries.select("lang", "term", "lang_count").dropDuplicates(["lang", "term"])
    vocab = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("V"), F.sum("lang_count").alias("lang_N"))
    sizes = entries.groupBy("lang", "source").agg(F.sum("count").alias("N"))
    # every occurring group, with its N (0 without kept terms) and V of its language
    table = (
        lookup_join(groups, vocab, "lang", "left")
        .join(sizes, ["lang", "source"], "left")
        .select("lang", "source", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("V", "lang_N", "N")])
        .withColumn("p0", _p(F.lit(0), F.col("N"), F.col("V")))
    )
    table = cut_lineage(table)  # one row per group; written once for the joins below
    nz = lookup_join(entries, table, ["lang", "source"]).select(
        "lang", "source", "term", "V", "p0",
        _p(F.col("count"), F.col("N"), F.col("V")).alias("p"),
        _p(F.col("lang_count"), F.col("lang_N"), F.col("V")).alias("q"),
    )
    term_part = top_per_group(
        nz.where(F.col("p") > F.col("q")).select(
            "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")
        ),
        ["lang", "source", "part"],
        [F.desc("value"), F.asc("item")],
        top,
    )
    others = table.select("lang", F.col("source").alias("other"), F.col("p0").alias("p0b"))
    sparse = _pair_sums(nz, table)
    pairs = (
        lookup_join(table.select("lang", "source"), others, "lang")
        .where(F.col("source") != F.col("other"))
        .join(sparse, ["lang", "source", "other"], "left")
        .select(
            "lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"),
            F.coalesce("value", F.lit(0)).cast("bigint").alias("value"),
        )
    )
    by = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    return pairs.withColumn("rank", F.row_number().over(by)).unionByName(term_part).select(
        "lang", "source", "part", "item", F.col("value").cast("bigint").alias("value"), F.col("rank").cast("int").alias("rank")
    )


__all__ = ["audit", "collapse"]
