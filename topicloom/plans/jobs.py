"""The jobs: each reads dated tables, computes, and replaces one partition of its output.

Tables keep arrays and long rows instead of delimited text: tokens are ``array<string>``, weighted
words arrays of (word, weight), clusters a table of (id, vec, norm, size) with a long table of
members.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.operators import cluster, docvec, embed, filters, labels, similarity, stats, textrank
from topicloom.operators.segment import explode_tokens, segment
from topicloom.operators.skew import lookup_join, salted_join
from topicloom.session import cut_lineage
from topicloom.sources import files, tables

Affixes = tuple[Sequence[str], Sequence[str]]
DEFAULT_AFFIXES: Affixes = (filters.NAME_PREFIXES, filters.NAME_SUFFIXES + filters.PLACE_SUFFIXES)


@dataclass
class Segmented:
    """Both outputs of :func:`segment_corpus`."""

    cut: DataFrame
    usable: DataFrame

    @property
    def tokens(self) -> DataFrame:
        """(id, pos, word, nature) of the words that stay."""
        return lookup_join(explode_tokens(self.cut), self.usable, "word").select("id", "pos", "word", "nature")

    @property
    def word_nature(self) -> DataFrame:
        return stats.word_nature_count(self.tokens)

    @property
    def word_seg(self) -> DataFrame:
        """(id, msg, words); a document that keeps no word stays with an empty list."""
        return filters.keep_words(self.cut, self.usable)


def segment_corpus(
    corpus: DataFrame,
    lexicon: DataFrame,
    stopwords: DataFrame,
    exclude: Sequence[str] = (),
    affixes: Affixes | None = DEFAULT_AFFIXES,
    other: Sequence[str] = tuple(filters.PLACE_SUFFIXES + filters.OTHER_STOP_WORDS),
    by_lexicon: bool = False,
) -> Segmented:
    """Cut texts to words and keep nouns that pass the affix, symbol and stop-word rules.

    Tags, affixes, symbols and stop words depend on the word alone, so they are settled on the
    lexicon; the tokens meet what is left of it in one join. ``affixes=None`` skips the affix
    and symbol rules.
    """
    keep = filters.keep_nature(exclude=exclude) & ~F.col("word").isin(list(other))
    if affixes is not None:
        keep = keep & filters.drop_affixes(prefixes=affixes[0], suffixes=affixes[1]) & filters.drop_symbolic()
    usable = lexicon.where(keep).join(stopwords.select("word").distinct(), "word", "left_anti").select("word", "nature")
    return Segmented(segment(corpus, lexicon=lexicon if by_lexicon else None), usable)


def filter_segments(word_seg: DataFrame, word_nature: DataFrame, rules: DataFrame, min_cnt: int = 3) -> DataFrame:
    """(id, words) without rare words and words switched off; emptied documents stay."""
    drop = filters.rare_words(word_nature, min_cnt).unionByName(filters.banned_words(rules))
    return filters.keep_words(word_seg.select("id", "words"), drop, drop=True)


class Jobs:
    """Jobs over the tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def read(self, name: str, dt: str | int | None = None, *cols: str) -> DataFrame:
        return tables.read_partition(self.spark, f"{self.root}/{name}", dt, cols or None)

    def save(self, df: DataFrame, name: str, dt: str | int) -> None:
        tables.save_partition(df, f"{self.root}/{name}", dt)

    # ---- loading

    def load_file(self, path: str, sep: str, table: str, fields: str, dt: str) -> None:
        self.save(files.load_delimited(self.spark, path, sep, fields.split(",")), table, dt)

    def load_class_dictionary(self, dt: str, path: str) -> None:
        self.save(files.load_typed_csv(self.spark, path), "class_words", dt)

    def load_stopwords(self, dt: str, path: str) -> None:
        self.save(files.load_words(self.spark, path), "stopwords", dt)

    def load_corpus(self, dt: str, path: str, prefix: str) -> None:
        self.save(files.load_corpus(self.spark, path, prefix), "corpus", dt)

    # ---- words

    def segment_words(self, dt: str, out_dt: str, exclude_names: bool = False) -> None:
        """Segments the whole corpus, of all dates, with the lexicon of ``dt``. With
        ``exclude_names`` places and persons go by their tag and the affix rules are off."""
        seg = segment_corpus(
            self.read("corpus", None, "id", "msg"),
            self.read("lexicon", dt, "word", "nature", "freq"),
            self.read("stopwords", None, "word"),
            exclude=("ns", "nr") if exclude_names else (),
            affixes=None if exclude_names else DEFAULT_AFFIXES,
            by_lexicon=True,
        )
        seg = Segmented(seg.cut, cut_lineage(seg.usable))
        self.save(seg.word_nature, "word_nature", out_dt)
        self.save(seg.word_seg, "word_seg", out_dt)

    def filter_words(self, dt: str) -> None:
        rules = self.read("rulewords", None, "word", "use_flag")
        nature = self.read("word_nature", None, "word", "cnt")
        self.save(filter_segments(self.read("word_seg", dt, "id", "words"), nature, rules), "word_seg_filter", dt)

    def corpus_statistics(self, dt: str) -> None:
        docs = self.read("word_seg", dt, "id", "words")
        self.save(stats.corpus_tfidf(docs), "tfidf_words", dt)
        counts = self.read("tfidf_words", dt, "word", "df")
        self.save(filters.stopwords_by_df(counts, docs), "stopwords", dt + "01")

    def document_statistics(self, dt: str) -> None:
        self.save(stats.doc_tfidf_lists(self.read("word_seg", dt, "id", "words")), "tfidf_words_more", dt)

    def keyword_ranks(self, dt: str, out_dt: str, votes: int = 1000) -> None:
        docs = self.read("word_seg", dt, "id", "msg", "words")
        self.save(textrank.textrank_by_doc(docs), "textrank_mid", out_dt)
        ranked = self.read("textrank_mid", out_dt, "id", "textrank")
        n_words = F.size("textrank").cast("bigint").alias("n_words")
        scores = ranked.select("id", n_words, F.posexplode("textrank").alias("_at", "_w"))
        scores = scores.select("id", "_w.word", "_w.score", (F.col("_at") + 1).cast("bigint").alias("rank"), "n_words")
        self.save(textrank.textrank_total(scores), "textrank_words", out_dt)
        self.save(filters.stopwords_by_rank(scores, votes=votes).select("word"), "stopwords", out_dt + "02")

    # ---- vectors

    def embed_words(self, dt: str, out_dt: str, min_count: int, size: int = 200, partitions: int = 100) -> None:
        model = embed.train_word2vec(self.read("word_seg", dt, "words"), size=size, min_count=min_count, partitions=partitions)
        self.save(embed.word_vectors(model), "word_vec", out_dt)

    def document_vectors(self, dt: str, out_dt: str, mode: str = "sum") -> None:
        vectors = self.read("word_vec", dt, "word", "vec")
        source = "tfidf_words_more" if mode == "tfidf" else "word_seg"
        ranks = self.read("textrank_words", dt, "word", "trval") if mode == "unit" else None
        made = docvec.doc_vectors(self.read(source, dt, "id", "words"), vectors, mode, ranks)
        self.save(made, f"docvec_{mode}", out_dt)

    # ---- subjects

    def subject_round(self, dt: str, out_dt: str, is_first: bool, thres: float, mode: str = "sum", source: str = "sum") -> None:
        """One round of merging. The first reads document vectors (``docvec_<source>``), later ones
        the clusters of the round before."""
        kind = f"subject_{mode}"
        if is_first:
            docs = self.read("docvec_unit" if mode == "unit" else f"docvec_{source}", dt, "id", "vec")
            found = cluster.subject_clusters(docs, thres, 1, mode)
            self.save(found.table, kind, out_dt)
            self.save(found.members(), f"{kind}_members", out_dt)
            return
        before = self.read(kind, dt, "id", "vec", "norm", "size")
        pick, measure = ("first", "dot") if mode == "unit" else ("max", "cosine")
        pairs = cut_lineage(similarity.best_partner(before, thres, pick, measure).select("id", "partner"))
        matching = cut_lineage(cluster.greedy_matching(pairs))
        after = cluster.Clusters(cluster.merge_pairs(before, matching, mode), [matching])
        self.save(after.table, kind, out_dt)
        moved = after.members().select(F.col("member").alias("cid"), F.col("cid").alias("_now"), F.col("place").alias("_side"))
        sized = moved.join(before.select(F.col("id").alias("cid"), "size"), "cid")
        members = salted_join(self.read(f"{kind}_members", dt, "cid", "member", "place"), sized, "cid", heat="size")
        named = members.select(F.col("_now").alias("cid"), "member", F.concat("_side", "place").alias("place"))
        self.save(named, f"{kind}_members", out_dt)

    def _members(self, dt: str, mode: str) -> DataFrame:
        """Cluster numbers follow the cid order, so every job of one date gives the same."""
        classes = cluster.assign_class_id(self.read(f"subject_{mode}", dt, "id", "size"))
        return cluster.class_members(self.read(f"subject_{mode}_members", dt, "cid", "member", "place"), classes)

    def label_documents(self, dt: str, out_dt: str, mode: str = "sum") -> None:
        docs = self.read("word_seg", out_dt, "id", "msg", "words")
        self.save(cluster.doc_labels(self._members(dt, mode), docs), "doc2label", out_dt)

    def label_words(self, dt: str, out_dt: str, filtered: bool = False, mode: str = "sum", source: str = "sum") -> int:
        """Words per cluster. ``filtered`` applies the rule table and keeps clusters of more than
        100 members. Returns how many members had no words."""
        words = self.read(f"docvec_{source}", out_dt, "id", "words")
        members = cut_lineage(self._members(dt, mode))
        rules = self.read("rulewords", None, "word", "use_flag") if filtered else None
        made = cluster.cluster_words(members, words, rules, 100 if filtered else None)
        self.save(made, "label2word", out_dt)
        return cluster.missing_members(members, words).count()

    def word_labels(self, dt: str, out_dt: str) -> None:
        self.save(labels.word2label(self.read("label2word", dt, "class_id", "word", "weight")), "word2label", out_dt)

    # ---- search logs

    def match_log_labels(self, dt: str, out_dt: str) -> None:
        index = self.read("word2label", out_dt, "word", "label")
        matched = labels.match_labels(self.read("search_log", dt, "imei", "key_word"), index, self._lexicon(), by_lexicon=True)
        self.save(matched.select("imei", "words", "labels"), "imei_label", out_dt)

    def match_log_classes(self, dt: str, dict_dt: str, id2label: str, classes: str) -> None:
        log = self.read("search_log", dt, "imei", "key_word")
        hierarchy = files.load_class_hierarchy(self.spark, id2label, classes)
        dictionary = self.read("class_words", dict_dt, "word", "s_id")
        self.save(labels.match_classes(log, dictionary, hierarchy, self._lexicon(), by_lexicon=True), "imei_class", dt)

    def match_log_tags(self, dt: str, tag_dt: str) -> None:
        log = self.read("search_log", dt, "imei", "key_word")
        tags = filters.non_empty(self.read("word_tags", tag_dt, "word", "taglayer"), "taglayer")
        matched = labels.match_tags(log, tags, self._lexicon(), by_lexicon=True)
        names = F.transform("labels", lambda x: x["label"]).alias("tags")
        self.save(matched.select("imei", "key_word", "words", names), "imei_tag", dt)

    def _lexicon(self) -> DataFrame:
        """The lexicon of all dates, one entry per word."""
        rows = self.read("lexicon", None, "word", "nature", "freq")
        return rows.groupBy("word").agg(F.max_by("nature", F.struct("freq", "nature")).alias("nature"), F.max("freq").alias("freq"))

    def count_labels(self, dt: str) -> None:
        self.save(labels.top_label(self.read("imei_class", dt, "class_names"), keep_empty=True), "top_label", dt)

    def count_tags(self, dt: str) -> None:
        self.save(labels.tag_rollup(self.read("imei_tag", dt, "tags"), "tags", keep_empty=True), "tag_count", dt)
