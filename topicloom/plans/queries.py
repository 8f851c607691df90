"""One query per operator, over the given tables.

Each takes (spark, sf_dir) and returns a DataFrame of plain columns, so that a SQL engine can
repeat it (see :mod:`topicloom.plans.checks`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom import functions as fn
from topicloom.functions.text import NARROW, WIDE
from topicloom.operators import cluster, docvec, embed, filters, labels, ranking, segment, similarity, stats, textrank
from topicloom.plans import inputs as src
from topicloom.plans import jobs
from topicloom.session import scratch_path
from topicloom.sources import embeddings, files, tables

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}

# Settings of the catalogue, in one place because the SQL side uses them too.
THRES = 0.3
TOP_WORDS = 1000
VOTES = 20
PREFIXES = ("th", "ver", "entr")
SUFFIXES = ("ing", "tion", "ment", "ung")
TR_DIGITS = 4


def query(f: Query) -> Query:
    CATALOG[f.__name__] = f
    return f


def _text(spark: SparkSession, lines: DataFrame, label: str) -> str:
    """Write one text column to files and name their folder."""
    path = scratch_path(spark, label)
    lines.write.text(path)
    return path


# ---------------------------------------------------------------- sources and sinks


@query
def s1_read_lines(spark, sf):
    path = _text(spark, src.corpus(spark, sf).select("msg"), "lines")
    return files.read_lines(spark, path).groupBy("line").agg(F.count("*").alias("n"))


@query
def s2_load_delimited(spark, sf):
    last = F.when(F.col("p_size") < 5, "").when(F.col("p_size") > 45, F.lit("a||b")).otherwise(F.col("p_brand"))
    lines = src.table(spark, sf, "part").select(F.concat_ws("||", F.col("p_partkey").cast("string"), "p_name", last))
    return files.load_delimited(spark, _text(spark, lines, "delimited"), r"\|\|", ["key", "name", "brand"])


@query
def s3_load_typed_csv(spark, sf):
    p = src.table(spark, sf, "part")
    lines = p.select(
        F.concat_ws(
            ",", "p_name", F.col("p_size").cast("string"), F.col("p_partkey").cast("string"), F.lit("7"), F.lit("1"),
            "p_brand", "p_type", "p_name", F.when(F.col("p_size") < 5, "").otherwise("parts"),
        )
    )
    return files.load_typed_csv(spark, _text(spark, lines, "typed"))


@query
def s4_load_corpus(spark, sf):
    path = _text(spark, src.corpus(spark, sf).select("msg"), "corpus")
    rows = files.load_corpus(spark, path, "doc_")
    return rows.groupBy("msg").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.bool_and(F.col("id").startswith("doc_")).alias("prefixed"))


@query
def s5_load_words(spark, sf):
    return files.load_words(spark, _text(spark, src.part_words(spark, sf).select("word"), "words")).groupBy("word").agg(F.count("*").alias("n"))


@query
def s6_read_partition(spark, sf):
    path = scratch_path(spark, "partitions")
    rows = src.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    for status, dt in (("F", 20240101), ("O", 20240102), ("P", 20240103)):
        tables.save_partition(rows.where(F.col("o_orderstatus") == status), path, dt)
    return tables.read_partition(spark, path, 20240102, ["o_orderkey", "o_totalprice", "stat_date"])


@query
def s7_load_class_hierarchy(spark, sf):
    id2label, classes = _hierarchy_files(spark, sf)
    return files.load_class_hierarchy(spark, id2label, classes)


def _hierarchy_files(spark, sf):
    nation, region = src.table(spark, sf, "nation"), src.table(spark, sf, "region")
    upper = region.select(F.concat_ws(",", F.col("r_regionkey").cast("string"), "r_name").alias("line"))
    lower = nation.select(F.concat_ws(",", (F.col("n_nationkey") + 100).cast("string"), "n_name").alias("line"))
    pairs = nation.select(F.concat_ws(",", F.col("n_regionkey").cast("string"), (F.col("n_nationkey") + 100).cast("string"), F.lit("x")))
    return _text(spark, upper.unionByName(lower), "id2label"), _text(spark, pairs, "classes")


@query
def s8_save_partition(spark, sf):
    """Two days, the first one written twice: the second writing replaces the first."""
    path = scratch_path(spark, "save")
    rows = src.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    tables.save_partition(rows, path, "d1", "string")
    tables.save_partition(rows.where("c_acctbal < 0"), path, "d2", "string")
    tables.save_partition(rows.where("c_acctbal >= 0"), path, "d1", "string")
    return tables.read_partition(spark, path, part_type="string")


@query
def s9_create_schema(spark, sf):
    path = scratch_path(spark, "csv")
    src.table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal", F.col("s_acctbal") > 0).write.csv(path)
    schema = tables.create_schema([("key", "BIGINT"), ("name", "string"), ("balance", "double"), ("positive", "bool")])
    return spark.read.schema(schema).csv(path)


@query
def s10_save_load_embeddings(spark, sf):
    path = scratch_path(spark, "embeddings")
    points = src.doc_points(spark, sf)
    embeddings.save_embeddings(points.withColumnRenamed("id", "word"), path)
    back = embeddings.load_embeddings(spark, path)
    return back.select("word", F.posexplode("vec").alias("i", "x")).withColumn("x", F.round("x", 6))


# ---------------------------------------------------------------- text functions


@query
def t1_to_half_width(spark, sf):
    wide = F.translate("msg", NARROW, WIDE)
    return src.corpus(spark, sf).select("id", fn.to_half_width(F.concat(wide, F.lit("｟"))).alias("half"))


@query
def t2_to_simplified(spark, sf):
    return src.corpus(spark, sf).select("id", segment.normalized("msg", src.ACCENTS).alias("plain"))


@query
def t3_segment(spark, sf):
    return src.docs(spark, sf).select("id", fn.join_tokens("words").alias("words"))


def _segment_han(spark, sf, **options):
    texts = src.corpus(spark, sf).select("id", src.han("msg").alias("msg"))
    return segment.segment(texts, lexicon=src.han_lexicon(spark, sf), **options).select("id", fn.join_tokens("words").alias("words"))


@query
def t3_segment_han(spark, sf):
    """Longest match against a broadcast word set."""
    return _segment_han(spark, sf)


@query
def t3_segment_han_joined(spark, sf):
    """The same with a lexicon that is too large to be broadcast."""
    return _segment_han(spark, sf, max_bytes=0)


@query
def t4_segment_with_nature(spark, sf):
    return segment.segment_with_nature(src.corpus(spark, sf).select("id", "msg"), src.lexicon(spark, sf).where("freq > 1"))


@query
def t5_with_user_words(spark, sf):
    user = src.part_words(spark, sf).select("word", F.lit("mbk").alias("nature"))
    return segment.with_user_words(src.lexicon(spark, sf), user)


@query
def t6_tokens_codec(spark, sf):
    parts = fn.parse_tokens("msg")
    return src.corpus(spark, sf).select("id", F.size(parts).alias("n"), fn.join_tokens(parts, ",").alias("words"))


@query
def t7_weighted_codec(spark, sf):
    text = F.concat(F.col("p_name"), F.lit(";"), F.col("p_size").cast("string"), F.lit(",bad,"), F.col("p_brand"), F.lit(";1.5,x;,"), F.col("p_type"), F.lit(";7"))
    parsed = src.table(spark, sf, "part").select("p_partkey", fn.parse_weighted(text).alias("w"))
    whole = F.transform("w", lambda x: F.struct(x["word"], F.round(x["weight"] * 10).cast("bigint").alias("weight")))
    return parsed.select("p_partkey", fn.format_weighted(whole).alias("line"), F.size("w").alias("n"))


@query
def t8_ids_codec(spark, sf):
    text = F.concat_ws(",", F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")), "o_orderstatus")
    ids = src.table(spark, sf, "orders").select("o_orderkey", fn.split_ids(text).alias("ids"))
    return ids.select("o_orderkey", F.size("ids").alias("n"), F.col("ids")[0].alias("first"), fn.join_ids("ids").alias("text"))


@query
def t9_tag_prefixes(spark, sf):
    path = F.concat_ws("-", "p_brand", "p_type", F.when(F.col("p_size") > 10, F.concat_ws("-", "p_name", F.lit("x"))))
    tags = src.table(spark, sf, "part").select("p_partkey", F.posexplode(fn.tag_prefixes(path)).alias("level", "tag"))
    return tags


@query
def t10_vector_codec(spark, sf):
    back = fn.string_to_vec(fn.vec_to_string("vec"))
    return src.doc_points(spark, sf).select("id", F.size(back).alias("width"), F.round(fn.vec_dot(back, F.col("vec")), 6).alias("dot"))


@query
def t11_truncate6(spark, sf):
    return src.doc_points(spark, sf).select("id", F.posexplode(fn.truncate6("vec")).alias("i", "x")).withColumn("x", F.round("x", 6))


# ---------------------------------------------------------------- filters


def _counted(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("word", "nature").agg(F.count("*").alias("n"))


@query
def f1_keep_nature(spark, sf):
    return _counted(src.tagged(spark, sf).where(filters.keep_nature()))


@query
def f2_keep_nature_exclude(spark, sf):
    return _counted(src.tagged(spark, sf).where(filters.keep_nature(exclude=["ns", "nr"])))


@query
def f3_keep_search_nature(spark, sf):
    return _counted(src.tagged(spark, sf).where(filters.keep_nature(prefixes=filters.SEARCH_NATURES)))


@query
def f4_drop_affixes(spark, sf):
    return _counted(src.tagged(spark, sf).where(filters.drop_affixes(prefixes=PREFIXES, suffixes=SUFFIXES)))


@query
def f5_drop_symbolic(spark, sf):
    """Chunks between blanks keep their symbols; short ones count as symbol words."""
    chunks = src.corpus(spark, sf).select(F.explode_outer(F.split("msg", " ")).alias("word")).where("word <> ''")
    marked = chunks.withColumn("nature", F.when(F.length("word") <= 3, "nx").otherwise("n"))
    return _counted(marked.where(filters.drop_symbolic()))


@query
def f6_drop_words(spark, sf):
    stop = filters.stopwords_by_df(stats.document_frequency(stats.term_frequency(src.docs(spark, sf))), src.corpus(spark, sf))
    return filters.drop_words(src.tokens(spark, sf), stop).groupBy("word").agg(F.count("*").alias("n"))


@query
def f7_drop_rare(spark, sf):
    return filters.drop_rare(src.tokens(spark, sf), src.word_nature(spark, sf)).groupBy("id").agg(F.count("*").alias("n"))


@query
def f8_drop_rule_words(spark, sf):
    return filters.drop_rule_words(src.tokens(spark, sf), src.rules(spark, sf)).groupBy("word").agg(F.count("*").alias("n"))


@query
def f9_min_tokens(spark, sf):
    return filters.min_tokens(src.docs(spark, sf), n=50).select("id", F.size("words").alias("n"))


@query
def f10_min_df(spark, sf):
    return filters.min_df(stats.document_frequency(stats.term_frequency(src.docs(spark, sf)))).select("word", "df")


@query
def f11_min_cluster_size(spark, sf):
    """Sources of documents as clusters; small ones drop out."""
    members = src.corpus(spark, sf).select(F.concat_ws("/", "source", "lang").alias("class_id"), F.col("id").alias("member"))
    return filters.min_cluster_size(members, 10)


@query
def f12_max_label_fanout(spark, sf):
    few = filters.max_label_fanout(src.label_pairs(spark, sf), 5)
    return few.select("word", F.array_join("labels", ",").alias("labels"))


@query
def f13_stopwords_by_df(spark, sf):
    return filters.stopwords_by_df(stats.document_frequency(stats.term_frequency(src.docs(spark, sf))), src.corpus(spark, sf))


@query
def f14_stopwords_by_rank(spark, sf):
    return filters.stopwords_by_rank(textrank.textrank(src.docs(spark, sf)), votes=VOTES)


@query
def f15_non_empty(spark, sf):
    tags = src.table(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") > 25, F.col("p_type")).otherwise("").alias("taglayer"))
    return filters.non_empty(tags, "taglayer")


# ---------------------------------------------------------------- joins


@query
def j1_lookup_vectors(spark, sf):
    found = docvec.lookup_vectors(src.tokens(spark, sf), src.word_vec(spark, sf))
    return found.groupBy("id").agg(F.count("*").alias("n"), F.round(F.sum(F.col("vec")[0]), 6).alias("x0"))


@query
def j2_lookup_labels(spark, sf):
    log = src.search_log(spark, sf)
    terms = segment.segment(log, "key_word").select("imei", F.explode_outer("words").alias("word"))
    return labels.lookup_labels(terms, src.label_pairs(spark, sf)).groupBy("imei", "label").agg(F.count("*").alias("n"))


@query
def j3_vocab_topk_join(spark, sf):
    total = textrank.textrank_total(textrank.textrank(src.docs(spark, sf)))
    top = docvec.vocab_topk_join(src.word_vec(spark, sf), total, TOP_WORDS)
    return top.select("word", F.round(F.col("vec")[0], 6).alias("x0"))


def _clusters(spark, sf, rounds=1):
    return cluster.subject_clusters(src.doc_points(spark, sf), THRES, rounds)


def _cluster_members(spark, sf, rounds=1):
    found = _clusters(spark, sf, rounds)
    return cluster.class_members(found.members(), cluster.assign_class_id(found.table))


def _point_docs(spark, sf):
    """Documents under the ids of the vectors: (id, msg, words)."""
    return src.docs(spark, sf).withColumn("id", F.lpad("id", 9, "0"))


@query
def j4_doc_labels(spark, sf):
    found = cluster.doc_labels(_cluster_members(spark, sf), _point_docs(spark, sf))
    return found.select("id", "class_id", F.length("msg").cast("bigint").alias("n_chars"), fn.join_tokens("words").alias("words"))


@query
def j5_lookup_doc_words(spark, sf):
    words = cluster.lookup_doc_words(_cluster_members(spark, sf), _point_docs(spark, sf).select("id", "words"))
    return words.groupBy("class_id", "member").agg(F.count("*").alias("n"), F.count_distinct("word").alias("words"))


@query
def j5_missing_members(spark, sf):
    """Members among the ids that have no label row."""
    known = src.table(spark, sf, "labels").select(F.lpad(F.col("doc_id").cast("string"), 9, "0").alias("id"))
    return cluster.missing_members(_cluster_members(spark, sf), known)


@query
def j6_anti_words(spark, sf):
    names = src.part_words(spark, sf)
    common = stats.document_frequency(stats.term_frequency(src.docs(spark, sf))).where("df > 5").select("word")
    kept = filters.anti_words(src.tokens(spark, sf), names.select("word").unionByName(common))
    return kept.groupBy("id").agg(F.count("*").alias("n"))


@query
def j7_semi_words(spark, sf):
    vocab = stats.document_frequency(stats.term_frequency(src.docs(spark, sf))).where("df between 2 and 50")
    return filters.semi_words(src.tokens(spark, sf), vocab).groupBy("id").agg(F.count("*").alias("n"))


@query
def j8_cosine_self_join(spark, sf):
    pairs = similarity.cosine_self_join(src.doc_points(spark, sf), THRES)
    return pairs.select("id", "partner", F.round("sim", 6).alias("sim"))


@query
def j8_cosine_self_join_pivots(spark, sf):
    """Blocks so small that the vectors are spread over cells around pivots."""
    pairs = similarity.cosine_self_join(src.doc_points(spark, sf), THRES, block_rows=32)
    return pairs.select("id", "partner", F.round("sim", 6).alias("sim"))


@query
def j8_cosine_self_join_lsh(spark, sf):
    """Opt-in approximate join (random projection buckets); only true pairs, some may be missed."""
    pairs = similarity.approx_self_join(src.doc_points(spark, sf), THRES)
    return pairs.select("id", "partner", F.round("sim", 6).alias("sim"))


@query
def j8_lsh_recall(spark, sf):
    """Recall of the approximate join against the exact one, over all vectors."""
    return similarity.lsh_recall(src.doc_points(spark, sf), THRES)


# ---------------------------------------------------------------- aggregations


@query
def a1_word_nature_count(spark, sf):
    return stats.word_nature_count(src.tagged(spark, sf))


@query
def a2_term_frequency(spark, sf):
    return stats.term_frequency(src.docs(spark, sf))


@query
def a3_document_frequency(spark, sf):
    return stats.document_frequency(stats.term_frequency(src.docs(spark, sf)))


@query
def a4_doc_count(spark, sf):
    return stats.doc_count(src.docs(spark, sf))


@query
def a5_doc_tfidf(spark, sf):
    return stats.doc_tfidf(src.docs(spark, sf)).withColumn("weight", F.round("weight", 6))


@query
def a5_doc_tfidf_lists(spark, sf):
    lists = stats.doc_tfidf_lists(src.docs(spark, sf))
    names = F.transform("words", lambda x: x["word"])
    total = F.aggregate("words", F.lit(0.0), lambda s, x: s + x["weight"])
    return lists.select("id", fn.join_tokens(names).alias("words"), F.round(total, 4).alias("total"))


@query
def a6_corpus_tfidf(spark, sf):
    return stats.corpus_tfidf(src.docs(spark, sf)).withColumn("tfidf", F.round("tfidf", 6))


@query
def a7_textrank_total(spark, sf):
    total = textrank.textrank_total(textrank.textrank(src.docs(spark, sf)))
    return total.select("word", F.round(F.ln("trval"), TR_DIGITS).alias("trval"))


@query
def a8_cluster_words(spark, sf):
    return cluster.cluster_words(_cluster_members(spark, sf), _point_docs(spark, sf).select("id", "words"))


@query
def a8_cluster_words_rules(spark, sf):
    words = _point_docs(spark, sf).select("id", "words")
    return cluster.cluster_words(_cluster_members(spark, sf, 2), words, src.rules(spark, sf), min_size=2)


@query
def a8_cluster_words_weighted(spark, sf):
    lists = stats.doc_tfidf_lists(src.docs(spark, sf)).withColumn("id", F.lpad("id", 9, "0"))
    return cluster.cluster_words(_cluster_members(spark, sf), lists).withColumn("weight", F.round("weight", 4))


@query
def a9_word2label(spark, sf):
    """Inverted index of words per language."""
    per = segment.segment(src.corpus(spark, sf)).select(F.col("lang").alias("class_id"), F.explode_outer("words").alias("word"))
    counts = per.where("word is not null").groupBy("class_id", "word").agg(F.count("*").alias("weight"))
    return labels.word2label(counts)


@query
def a10_label_scores(spark, sf):
    log = segment.segment(src.search_log(spark, sf), "key_word")
    terms = log.select("imei", "turn", F.explode_outer("words").alias("word"))
    return labels.label_scores(terms, src.label_pairs(spark, sf), ["imei", "turn"])


@query
def a11_top_label(spark, sf):
    return labels.top_label(c3_match_classes_raw(spark, sf))


@query
def a12_tag_rollup(spark, sf):
    words = src.lexicon(spark, sf)
    matched = labels.match_tags(src.search_log(spark, sf), src.tag_dictionary(spark, sf, words), words, key=["imei", "turn"])
    return labels.tag_rollup(matched.select(F.transform("labels", lambda x: x["label"]).alias("labels")))


@query
def a13_word_classes(spark, sf):
    pairs = src.part_words(spark, sf).join(src.table(spark, sf, "part"), "p_partkey").select("word", F.col("p_size").alias("s_id"))
    return stats.word_classes(pairs).select("word", F.array_join(F.col("class_ids").cast("array<string>"), ",").alias("class_ids"))


@query
def a14_vec_sum(spark, sf):
    points = src.table(spark, sf, "embeddings").select("label", F.col("embedding").alias("vec"), (F.col("vec_id") % 7 + 0.5).alias("w"))
    sums = points.groupBy("label").agg(fn.vec_sum("vec").alias("s"), fn.vec_sum("vec", "w").alias("ws"))
    return sums.select("label", F.posexplode(F.arrays_zip("s", "ws")).alias("i", "z")).select(
        "label", "i", F.round("z.s", 4).alias("s"), F.round("z.ws", 4).alias("ws")
    )


@query
def a15_distinct_words(spark, sf):
    return stats.distinct_words(src.tokens(spark, sf))


@query
def a16_vocabulary(spark, sf):
    return stats.vocabulary(src.tokens(spark, sf))


@query
def a17_dedupe_map(spark, sf):
    return stats.dedupe_map(src.part_words(spark, sf), "word", "p_partkey")


# ---------------------------------------------------------------- vectors


def _vector_pairs(spark, sf):
    """Each vector next to the one that follows it, the last next to the first."""
    points = src.table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("a"))
    n = points.agg(F.count("*")).scalar()
    after = points.select(((F.col("vec_id") + n - 1) % n).alias("vec_id"), F.col("a").alias("b"))
    return points.join(after, "vec_id")


@query
def v1_vec_dot(spark, sf):
    """Dense, and with the positive part of the first vector as a sparse one."""
    spots = F.filter(F.transform("a", lambda x, i: F.struct(i.alias("i"), x.alias("v"))), lambda x: x["v"] > 0)
    pairs = _vector_pairs(spark, sf).withColumn("p", spots)
    sparse = fn.sparse_dot(F.col("p.i"), F.col("p.v"), F.col("b"))
    return pairs.select("vec_id", F.round(fn.vec_dot("a", "b"), 6).alias("dense"), F.round(sparse, 6).alias("sparse"))


@query
def v2_vec_norm(spark, sf):
    return _vector_pairs(spark, sf).select("vec_id", F.round(fn.vec_norm(fn.vec_scale("a", 3.0)), 6).alias("norm"))


@query
def v3_vec_scale(spark, sf):
    scaled = fn.vec_scale("a", F.col("vec_id") + 0.5)
    rows = _vector_pairs(spark, sf).select("vec_id", scaled.alias("s"), fn.vec_normalize(scaled).alias("u"))
    return rows.select("vec_id", F.posexplode(F.arrays_zip("s", "u")).alias("i", "z")).select(
        "vec_id", "i", F.round("z.s", 5).alias("s"), F.round("z.u", 6).alias("u")
    )


@query
def v4_vec_add(spark, sf):
    rows = _vector_pairs(spark, sf).select("vec_id", fn.vec_add("a", "b").alias("s"), fn.vec_axpy(2.0, "a", "b").alias("y"))
    return rows.select("vec_id", F.posexplode(F.arrays_zip("s", "y")).alias("i", "z")).select(
        "vec_id", "i", F.round("z.s", 6).alias("s"), F.round("z.y", 6).alias("y")
    )


@query
def v5_cosine(spark, sf):
    """The vector against its successor and against a zero vector."""
    zero = fn.vec_scale("b", 0.0)
    return _vector_pairs(spark, sf).select("vec_id", F.round(fn.cosine("a", "b"), 6).alias("cos"), fn.cosine("a", zero).alias("none"))


def _vector_rows(rows: DataFrame, with_norm: bool) -> DataFrame:
    cols = ["id", fn.join_tokens("words").alias("words"), F.round(F.col("vec")[0], 4).alias("x0"), F.round(F.col("vec")[F.size("vec") - 1], 4).alias("x_last")]
    return rows.select(*cols, F.round("norm", 4).alias("norm")) if with_norm else rows.select(*cols)


@query
def v6_doc_vectors_unit(spark, sf):
    """Vocabulary: the best words by total TextRank."""
    d = src.docs(spark, sf)
    total = textrank.textrank_total(textrank.textrank(d))
    rows = docvec.doc_vectors(d, src.word_vec(spark, sf), "unit", total, k=TOP_WORDS)
    return _vector_rows(rows, False)


@query
def v7_doc_vectors_sum(spark, sf):
    return _vector_rows(docvec.doc_vectors(src.docs(spark, sf), src.word_vec(spark, sf), "sum"), True)


@query
def v8_doc_vectors_tfidf(spark, sf):
    lists = stats.doc_tfidf_lists(src.docs(spark, sf))
    rows = docvec.doc_vectors(lists, src.word_vec(spark, sf), "tfidf")
    names = fn.join_tokens(F.transform("words", lambda x: x["word"])).alias("words")
    norm = F.nullif(F.col("norm"), F.lit(0.0))
    first, last = F.col("vec")[0] / norm, F.col("vec")[F.size("vec") - 1] / norm
    return rows.select("id", names, F.round(first, 5).alias("x0"), F.round(last, 5).alias("x_last"), F.round(F.ln(norm), 6).alias("norm"))


# ---------------------------------------------------------------- graphs and clusters


@query
def g1_cooccurrence_edges(spark, sf):
    edges = textrank.cooccurrence_edges(src.docs(spark, sf), per_word=True)
    return edges.select("id", "word", fn.join_tokens("neighbours").alias("neighbours"))


@query
def g2_textrank(spark, sf):
    return textrank.textrank(src.docs(spark, sf)).select("id", "word", F.round(F.ln("score"), TR_DIGITS).alias("score"))


@query
def g2_textrank_degree(spark, sf):
    """Scores shared out over the neighbours."""
    return textrank.textrank(src.docs(spark, sf), degree_norm=True).select("id", "word", F.round("score", 6).alias("score"))


@query
def g3_textrank_by_doc(spark, sf):
    rows = textrank.textrank_by_doc(src.docs(spark, sf))
    return rows.select("id", F.length("msg").cast("bigint").alias("n_chars"), F.array_join(F.transform("textrank", lambda x: x["word"]), ",").alias("ranked"))


@query
def g4_best_partner_max(spark, sf):
    return similarity.best_partner(src.doc_points(spark, sf), THRES).withColumn("sim", F.round("sim", 6))


@query
def g5_best_partner_first(spark, sf):
    points = src.doc_points(spark, sf).withColumn("vec", fn.truncate6("vec"))
    return similarity.best_partner(points, THRES, "first", "dot").withColumn("sim", F.round("sim", 5))


@query
def g6_greedy_matching(spark, sf):
    return cluster.greedy_matching(similarity.best_partner(src.doc_points(spark, sf), THRES))


def _merged(rows: DataFrame) -> DataFrame:
    return rows.select("id", "size", F.round("norm", 5).alias("norm"), F.round(F.col("vec")[0], 5).alias("x0"))


@query
def g7_merge_pairs(spark, sf):
    points = src.doc_points(spark, sf).select("id", "vec", fn.vec_norm("vec").alias("norm"), F.lit(1).cast("bigint").alias("size"))
    return _merged(cluster.merge_pairs(points, cluster.greedy_matching(similarity.best_partner(points, THRES))))


@query
def g7_merge_pairs_unit(spark, sf):
    points = src.doc_points(spark, sf).select("id", fn.truncate6("vec").alias("vec"), fn.vec_norm("vec").alias("norm"), F.lit(1).cast("bigint").alias("size"))
    found = similarity.best_partner(points, THRES, "first", "dot")
    merged = cluster.merge_pairs(points, cluster.greedy_matching(found), "unit")
    return merged.select("id", "size", F.round("norm", 5).alias("norm"), F.round(F.col("vec")[0], 6).alias("x0"))


@query
def g8_subject_clusters(spark, sf):
    """Two rounds."""
    return _merged(_clusters(spark, sf, 2).table)


@query
def g8_cluster_members(spark, sf):
    """The long table, members numbered in the order of the joined id."""
    members = _clusters(spark, sf, 2).members()
    return ranking.ranked_within(members, "cid", [F.asc("place")]).select("cid", "member", "rank")


@query
def g9_assign_class_id(spark, sf):
    return cluster.assign_class_id(_clusters(spark, sf).table).select("id", "class_id", "size")


# ---------------------------------------------------------------- embeddings and term vectors


def _model(spark, sf):
    return embed.train_word2vec(src.docs(spark, sf), size=16, min_count=20, partitions=4)


@query
def m1_train_word2vec(spark, sf):
    """The vocabulary of a trained model and the width of its vectors."""
    return embed.word_vectors(_model(spark, sf)).select("word", F.size("vec").alias("width"))


@query
def m2_word_vectors(spark, sf):
    return embed.word_vectors(_model(spark, sf)).select("word", F.posexplode("vec").alias("i", "x"))


@query
def m3_word_vector(spark, sf):
    """The vector stored for the first id."""
    points = src.doc_points(spark, sf).withColumnRenamed("id", "word")
    first = points.agg(F.min("word")).first()[0]
    vec = embed.word_vector(points, first)
    return points.where(F.col("word") == first).select("word", F.posexplode(F.array(*map(F.lit, vec))).alias("i", "x")).withColumn("x", F.round("x", 6))


@query
def m4_find_synonyms(spark, sf):
    points = src.doc_points(spark, sf).withColumnRenamed("id", "word")
    return embed.find_synonyms(points, "000000007", 20).withColumn("similarity", F.round("similarity", 6))


@query
def m5_term_vectors(spark, sf):
    d = src.docs(spark, sf)
    index = stats.term_index(d)
    vectors = stats.term_vectors(d, index=index)
    cells = vectors.select("id", "num_features", F.explode(F.arrays_zip("indices", "values")).alias("c"))
    named = cells.select("id", "num_features", F.col("c.indices").alias("index"), F.col("c.values").cast("bigint").alias("tf"))
    return named.join(index.select("index", "word"), "index").select("id", "word", "index", "tf", "num_features")


# ---------------------------------------------------------------- ranks and limits


def _doc_counts(spark, sf):
    return stats.term_frequency(src.docs(spark, sf))


@query
def l1_top_k(spark, sf):
    counts = stats.document_frequency(_doc_counts(spark, sf))
    return ranking.top_k(counts, [F.desc("tf"), F.asc("word")], TOP_WORDS)


def _scores(spark, sf):
    return a10_label_scores(spark, sf)


@query
def l2_top_labels(spark, sf):
    best = ranking.top_labels(_scores(spark, sf), ["imei", "turn"])
    return best.select("imei", "turn", F.concat_ws("|", "label", F.col("n").cast("string")).alias("label"), "rank")


@query
def l3_top_label_names(spark, sf):
    best = ranking.top_labels(_scores(spark, sf), ["imei", "turn"])
    lists = best.groupBy("imei", "turn").agg(F.sort_array(F.collect_list(F.struct("rank", "label"))).alias("l"))
    return lists.select("imei", "turn", F.array_join(F.transform("l", lambda x: x["label"]), ",").alias("labels"))


@query
def l4_rank_drop_last(spark, sf):
    return ranking.rank_drop_last(_doc_counts(spark, sf), ["id"], [F.desc("tf"), F.asc("word")])


@query
def l5_rank_tail(spark, sf):
    return ranking.rank_tail(_doc_counts(spark, sf), ["id"], [F.desc("tf"), F.asc("word")])


@query
def l6_sample_limit(spark, sf):
    return ranking.sample_limit(src.search_log(spark, sf), ["imei", "turn"], 100)


@query
def l7_similar_top_k(spark, sf):
    points = src.doc_points(spark, sf).withColumnRenamed("id", "word")
    query_vec = embed.word_vector(points, "000000003")
    return ranking.similar_top_k(points, query_vec, 10).withColumn("similarity", F.round("similarity", 6))


@query
def l8_rank_words(spark, sf):
    return ranking.rank_words(_doc_counts(spark, sf), ["id"], "tf")


# ---------------------------------------------------------------- composed operators


def _labels_text(rows: DataFrame, counts: bool) -> DataFrame:
    def one(x):
        return F.concat_ws("|", x["label"], x["n"].cast("string")) if counts else x["label"]

    return rows.select("imei", "turn", fn.join_tokens("words").alias("words"), F.array_join(F.transform("labels", one), ",").alias("labels"))


@query
def c1_match_labels(spark, sf):
    matched = labels.match_labels(src.search_log(spark, sf), src.label_pairs(spark, sf), src.lexicon(spark, sf), fanout=20, key=["imei", "turn"])
    return _labels_text(matched, True)


def _match_labels_han(spark, sf, **options):
    """Every search text comes twice, from two users."""
    log = src.search_log(spark, sf).withColumn("key_word", src.han("key_word"))
    log = log.unionByName(log.withColumn("imei", F.concat("imei", F.lit("again"))))
    index = src.label_pairs(spark, sf).withColumn("word", src.han("word"))
    matched = labels.match_labels(log, index, src.han_lexicon(spark, sf), fanout=20, key=["imei", "turn"], by_lexicon=True, **options)
    return _labels_text(matched, True)


@query
def c1_match_labels_han(spark, sf):
    return _match_labels_han(spark, sf)


@query
def c1_match_labels_han_joined(spark, sf):
    return _match_labels_han(spark, sf, max_bytes=0)


@query
def c2_match_tags(spark, sf):
    words = src.lexicon(spark, sf)
    matched = labels.match_tags(src.search_log(spark, sf), src.tag_dictionary(spark, sf, words), words, key=["imei", "turn"])
    return _labels_text(matched, False)


def c3_match_classes_raw(spark, sf):
    hierarchy, words = s7_load_class_hierarchy(spark, sf), src.lexicon(spark, sf)
    return labels.match_classes(src.search_log(spark, sf), src.class_dictionary(spark, sf, words), hierarchy, words, key=["imei", "turn"])


@query
def c3_match_classes(spark, sf):
    rows = c3_match_classes_raw(spark, sf)
    ids = F.array_join(F.col("class_ids").cast("array<string>"), ",")
    return rows.select("imei", "turn", fn.join_tokens("words").alias("words"), ids.alias("class_ids"), F.array_join("class_names", ",").alias("class_names"))


@query
def c4_segment_corpus(spark, sf):
    seg = jobs.segment_corpus(
        src.corpus(spark, sf).select("id", "msg"), src.lexicon(spark, sf), f13_stopwords_by_df(spark, sf), affixes=(PREFIXES, SUFFIXES)
    )
    return seg.word_seg.select("id", fn.join_tokens("words").alias("words"))


@query
def c4_segment_corpus_natures(spark, sf):
    seg = jobs.segment_corpus(src.corpus(spark, sf).select("id", "msg"), src.lexicon(spark, sf), f13_stopwords_by_df(spark, sf), exclude=("ns", "nr"), affixes=None)
    return seg.word_nature


@query
def c5_filter_segments(spark, sf):
    kept = jobs.filter_segments(src.docs(spark, sf).select("id", "words"), src.word_nature(spark, sf), src.rules(spark, sf))
    return kept.select("id", fn.join_tokens("words").alias("words"))

