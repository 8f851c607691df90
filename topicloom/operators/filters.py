"""Filters on words, documents, clusters and labels."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.operators.skew import BROADCAST_BYTES, lookup_join, salted_join, table_bytes, top_per_group
from topicloom.session import cut_lineage

# Rows that are filtered side by side when a word table is too large to be broadcast.
CHUNK_ROWS = 8192

# ---- fixed values: word lists and symbols that decide which words are dropped ----
NAME_PREFIXES = ["小", "老", "阿"]
NAME_SUFFIXES = [
    "公", "哥", "四", "小姐", "女士", "先生", "大爷", "爷", "姐", "总",
    "教授", "某", "氏", "老", "老师", "经理", "医生", "氏", "妈", "爸",
]
PLACE_SUFFIXES = ["路", "市", "区", "县", "省", "镇", "村", "乡"]
OTHER_STOP_WORDS = ["这是"]
SYMBOLS = " ´~!\\\"″”#$&'()*+`./:;<>?@^[]{}_-|%,"
SEARCH_NATURES = ["mbk", "n", "mz", "muc"]
# ----------------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _any(parts: Sequence[Column]) -> Column:
    out = F.lit(False)
    for part in parts:
        out = out | part
    return out


def keep_nature(
    word: Column | str = "word",
    nature: Column | str = "nature",
    prefixes: Sequence[str] = ("n",),
    exclude: Sequence[str] = (),
    min_len: int = 2,
) -> Column:
    """Predicate: the tag starts with a wanted prefix and no excluded one, and the word has
    at least ``min_len`` characters."""
    tag = _col(nature)
    keep = _any([tag.startswith(p) for p in prefixes]) & (F.length(_col(word)) >= min_len)
    return keep & ~_any([tag.startswith(p) for p in exclude]) if exclude else keep


def drop_affixes(
    word: Column | str = "word",
    prefixes: Sequence[str] = tuple(NAME_PREFIXES),
    suffixes: Sequence[str] = tuple(NAME_SUFFIXES + PLACE_SUFFIXES),
) -> Column:
    """Predicate: the word has none of the prefixes or suffixes."""
    w = _col(word)
    return ~(_any([w.startswith(p) for p in prefixes]) | _any([w.endswith(s) for s in dict.fromkeys(suffixes)]))


def drop_symbolic(
    word: Column | str = "word",
    nature: Column | str | None = "nature",
    tag: str = "nx",
    min_chars: int = 2,
    symbols: str = SYMBOLS,
) -> Column:
    """Predicate: not a ``tag`` word with fewer than ``min_chars`` characters besides symbols.

    ``nature=None`` tests every word."""
    short = F.length(F.translate(_col(word), symbols, "")) < min_chars
    return ~short if nature is None else ~(_col(nature).startswith(tag) & short)


def drop_words(tokens: DataFrame, words: DataFrame, key: str = "word") -> DataFrame:
    """Remove the tokens found in a word list."""
    return lookup_join(tokens, words.select(key).distinct(), key, "left_anti")


anti_words = drop_words


def semi_words(tokens: DataFrame, vocabulary: DataFrame, key: str = "word") -> DataFrame:
    """Keep only the tokens of a vocabulary; repeated tokens stay."""
    return lookup_join(tokens, vocabulary.select(key).distinct(), key, "left_semi")


def keep_words(docs: DataFrame, words: DataFrame, drop: bool = False, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with only those of their ``words`` (array) that are (with ``drop``: are not) in a word table.

    The rule depends on the word alone. While the table is small enough to be broadcast, each row's
    list is filtered where it lies. A larger one meets the distinct words of every ``CHUNK_ROWS`` rows in
    a join, and the rows of a chunk are filtered beside those of its words that were found: rows go
    through one shuffle as they are, and no token travels alone.
    """
    words = cut_lineage(words.select("word").distinct())
    if table_bytes(words) <= max_bytes:
        shared = docs.sparkSession.sparkContext.broadcast({r[0] for r in words.toLocalIterator()})

        @F.pandas_udf("array<string>")
        def kept(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            known = shared.value
            for lists in batches:
                yield lists.map(lambda items: [] if items is None else [w for w in items if (w in known) != drop])

        return docs.withColumn("words", kept("words"))
    chunks = F.lit(max(1, -(-docs.count() // CHUNK_ROWS)))
    dealt = docs.withColumn("_chunk", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), chunks))
    # The outer form keeps the words from being computed a second time for a filter on their number.
    used = dealt.select("_chunk", F.explode_outer("words").alias("word")).where(F.col("word").isNotNull()).distinct()
    known = used.join(words, "word", "left_semi").select(F.col("_chunk").alias("_of"), "word")

    def kept_rows(rows: pa.Table, found: pa.Table) -> pa.Table:
        rows, lists = rows.drop_columns(["_chunk"]), rows.column("words").combine_chunks()
        lists = lists.fill_null([]) if lists.null_count else lists
        hit = pc.is_in(lists.flatten(), value_set=found.column("word").combine_chunks())
        hit = pc.invert(hit) if drop else hit
        ends = np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]
        before = np.r_[0, np.cumsum(hit.to_numpy(zero_copy_only=False))]
        filtered = pa.ListArray.from_arrays(pa.array(before[ends], pa.int32()), lists.flatten().filter(hit))
        return rows.set_column(rows.schema.get_field_index("words"), "words", filtered)

    return dealt.groupBy("_chunk").cogroup(known.groupBy("_of")).applyInArrow(kept_rows, docs.schema)


def rare_words(word_nature: DataFrame, min_cnt: int = 3) -> DataFrame:
    """Words with any (word, nature) row below ``min_cnt``."""
    return word_nature.where(F.col("cnt") < min_cnt).select("word").distinct()


def drop_rare(tokens: DataFrame, word_nature: DataFrame, min_cnt: int = 3) -> DataFrame:
    return drop_words(tokens, rare_words(word_nature, min_cnt))


def banned_words(rules: DataFrame) -> DataFrame:
    """Words that the rule table switches off (``use_flag`` = 0)."""
    return rules.where(F.col("use_flag") == 0).select("word").distinct()


def drop_rule_words(tokens: DataFrame, rules: DataFrame) -> DataFrame:
    return drop_words(tokens, banned_words(rules))


def min_tokens(docs: DataFrame, words: str = "words", n: int = 3) -> DataFrame:
    """Documents with more than ``n`` tokens."""
    return docs.where(F.size(words) > n)


def min_df(df_table: DataFrame, n: int = 1) -> DataFrame:
    """Words found in more than ``n`` documents."""
    return df_table.where(F.col("df") > n)


def min_cluster_size(members: DataFrame, n: int = 100, key: str = "class_id") -> DataFrame:
    """Membership rows of clusters with more than ``n`` members; a huge cluster is cut in pieces."""
    sizes = members.groupBy(key).agg(F.count("*").alias("_size")).where(F.col("_size") > n)
    return salted_join(members, sizes, key, "left_semi", heat="_size")


def max_label_fanout(
    pairs: DataFrame, limit: int = 400, word: str = "word", label: str = "label", pieces: int = 32
) -> DataFrame:
    """(word, label) pairs as one row per word with its labels, for words of fewer than
    ``limit`` labels.

    No task sees more than ``limit`` pairs per word and slice, so a word with millions of
    labels is recognised by its first ``limit`` pairs and dropped whole.
    """
    order = [F.col(label).asc()]
    few = top_per_group(pairs.select(word, label).distinct(), [word], order, limit, pieces=pieces, rank="_rank")
    lists = few.groupBy(word).agg(F.sort_array(F.collect_list(label)).alias("labels"))
    return lists.where(F.size("labels") < limit)


def stopwords_by_df(df_table: DataFrame, docs: DataFrame, divisor: int = 10) -> DataFrame:
    """Words whose document count exceeds the integer quotient of all documents."""
    n = docs.agg(F.count("*")).scalar()
    return df_table.where(F.col("df") > F.floor(n / F.lit(divisor))).select("word")


def stopwords_by_rank(ranked: DataFrame, tail: float = 0.2, votes: int = 1000) -> DataFrame:
    """Each document votes for the lowest ``tail`` of its ranked words; more than ``votes``
    votes make a stop word. ``ranked`` holds (word, rank from 1, n_words of the document)."""
    voting = ranked.where(F.col("rank") > F.floor(F.col("n_words") * F.lit(1.0 - tail)))
    return voting.groupBy("word").agg(F.count("*").alias("votes")).where(F.col("votes") > votes)


def non_empty(df: DataFrame, c: str) -> DataFrame:
    return df.where(F.col(c) != "")
