"""Inverted label index and matching of search logs to labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.functions.text import tag_prefixes
from topicloom.operators.filters import SEARCH_NATURES, keep_nature, max_label_fanout
from topicloom.operators.segment import segment
from topicloom.operators.skew import dense_index, lookup_join, ranked_within
from topicloom.operators.stats import dedupe_map
from topicloom.session import cut_lineage

TOP_LABELS = 5


def word2label(label2word: DataFrame, word: str = "word", label: str = "class_id", cnt: str = "weight") -> DataFrame:
    """(word, label, cnt, rank): the inverted index as a long table; labels of a word by falling count."""
    sums = label2word.groupBy(F.col(word).alias("word"), F.col(label).alias("label")).agg(F.sum(cnt).alias("cnt"))
    return ranked_within(sums, "word", [F.desc("cnt"), F.asc("label")])


def lookup_labels(tokens: DataFrame, index: DataFrame) -> DataFrame:
    """Tokens with each of their labels: one row per token and label.

    ``index`` holds (word, label); a word may have very many labels."""
    return lookup_join(tokens, index.select("word", "label"), "word")


def label_scores(terms: DataFrame, index: DataFrame, group: Sequence[str]) -> DataFrame:
    """(group.., label, n): term counts of a group summed per label."""
    counts = terms.groupBy(*group, "word").agg(F.count("*").alias("cnt"))
    return lookup_labels(counts, index).groupBy(*group, "label").agg(F.sum("cnt").alias("n"))


def _score_log(
    log: DataFrame,
    dictionary: DataFrame,
    k: int,
    key: Sequence[str] | None,
    lexicon: DataFrame | None,
    simplify: Mapping[str, str] | None,
    names: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Words found in ``dictionary``(word, labels array) and the best labels per log row.

    Without a ``key`` equal rows are handled once and handed out as often as they occur. Rows are
    numbered and written down; only (row, place, word) meets the dictionary, and only the terms
    found there travel back to their row: no text is copied to its terms. With ``names``(label, code),
    codes in the order of the labels, the dictionary holds codes, and the ``k`` best get their names back.
    """
    repeated = F.count("*").alias("_copies")
    if key is None:
        key = ["imei", "key_word"]
        rows = log.groupBy(*key).agg(repeated).withColumn("_times", F.lit(1).cast("bigint"))
    else:
        # Rows that agree in all of these are one row with the terms of each.
        key = list(dict.fromkeys([*key, "imei", "key_word"]))
        rows = log.groupBy(*key).agg(repeated).withColumns({"_times": F.col("_copies"), "_copies": F.lit(1).cast("bigint")})
    rows = cut_lineage(rows.withColumn("_row", F.monotonically_increasing_id()))
    cut = segment(rows.select("_row", "_times", "key_word"), "key_word", "_words", lexicon=lexicon, simplify=simplify, key="_row", **options)
    terms = cut.select("_row", "_times", F.posexplode_outer("_words").alias("pos", "word")).where(F.col("word").isNotNull())
    found = lookup_join(terms, dictionary, "word").where(F.col("labels").isNotNull())
    # One row per term, not one per label of a term: counting goes on inside the row.
    together = found.repartition("_row").groupBy("_row").agg(
        F.min("_times").alias("_times"),
        F.sort_array(F.collect_list(F.struct("pos", "word", "_times"))).alias("_words"),
        F.collect_list("labels").alias("_hits"),
    )
    best = together.select("_row", "_words", _best_labels(F.flatten("_hits"), F.col("_times"), k).alias("_labels"))
    if names is not None:
        best = _named(best, names)
    rows = rows.join(best, "_row", "left")
    label = best.schema["_labels"].dataType.elementType["label"].dataType.simpleString()
    every_time = F.transform("_words", lambda x: F.array_repeat(x["word"], x["_times"].cast("int")))
    counted = F.transform("_labels", lambda x: F.struct(x["label"].alias("label"), (-x["o"]).alias("n")))
    return rows.select(
        *key,
        F.coalesce(F.flatten(every_time), F.array().cast("array<string>")).alias("words"),
        F.coalesce(counted, F.array().cast(f"array<struct<label:{label},n:bigint>>")).alias("labels"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))).alias("_copy"),
    ).drop("_copy")


def _best_labels(hits: Column, times: Column, k: int) -> Column:
    """The ``k`` most frequent labels of an array as (o, label), ``o`` the negative count; each hit counts ``times``.

    Equal labels stand together once sorted, so a count is the distance from one first place to the next."""

    def counted(found: Column) -> Column:
        places = F.transform(found, lambda x, i: F.when((i == 0) | ~x.eqNullSafe(F.get(found, i - 1)), i))
        firsts = F.filter(places, lambda i: i.isNotNull())
        return F.transform(F.array(firsts), lambda at: _runs(found, at))[0]

    def _runs(found: Column, at: Column) -> Column:
        end = F.size(found)
        return F.transform(at, lambda i, nth: F.struct((-(F.coalesce(F.get(at, nth + 1), end) - i) * times).alias("o"), F.get(found, i).alias("label")))

    # The array of one binds the sorted labels, which would be sorted again at each place otherwise.
    ordered = F.sort_array(F.filter(hits, lambda x: x.isNotNull()))
    return F.slice(F.sort_array(F.transform(F.array(ordered), counted)[0]), 1, k)


def _named(best: DataFrame, names: DataFrame) -> DataFrame:
    """The names of the best labels in place of their codes."""
    listed = best.select("_row", "_words", F.posexplode_outer("_labels").alias("_at", "_l")).select(
        "_row", F.when(F.coalesce("_at", F.lit(0)) == 0, F.col("_words")).alias("_words"), F.col("_l.o").alias("o"), F.col("_l.label").alias("code")
    )
    named = lookup_join(listed, names, "code", "left")
    item = F.when(F.col("code").isNotNull(), F.struct("o", "label"))
    return named.groupBy("_row").agg(F.max("_words").alias("_words"), F.sort_array(F.collect_list(item)).alias("_labels"))


def _coded(dictionary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The dictionary with numbers for its labels, and their names: (word, labels), (code, label).

    Terms carry all labels of their word through a shuffle; numbers take a tenth of the names."""
    entries = cut_lineage(dictionary.select("word", "labels").withColumn("_entry", F.monotonically_increasing_id()))
    pairs = entries.select("_entry", "word", F.explode_outer("labels").alias("label"))
    kinds = pairs.select("label").where(F.col("label").isNotNull()).distinct()
    names = cut_lineage(dense_index(kinds, ["label"], "code").withColumn("code", F.col("code").cast("int")))
    coded = lookup_join(pairs, names, "label", "left").groupBy("_entry").agg(F.min("word").alias("word"), F.collect_list("code").alias("labels"))
    return coded.select("word", "labels"), names


def _tagged(lexicon: DataFrame, keep: Column) -> DataFrame:
    return lexicon.where(keep).select("word")


def match_labels(
    log: DataFrame,
    index: DataFrame,
    lexicon: DataFrame,
    k: int = TOP_LABELS,
    fanout: int = 400,
    key: Sequence[str] | None = None,
    simplify: Mapping[str, str] | None = None,
    by_lexicon: bool = False,
    **options,
) -> DataFrame:
    """(imei, key_word, words, labels): the noun terms of each log row that are in the index
    (word, label) and the row's ``k`` best labels as (label, n).

    Words of ``fanout`` or more labels are not used; ``options`` go to the segmentation."""
    nouns = _tagged(lexicon, keep_nature(min_len=1))
    dictionary, names = _coded(max_label_fanout(index, fanout).join(nouns, "word"))
    return _score_log(log, dictionary, k, key, lexicon if by_lexicon else None, simplify, names, **options)


def match_tags(
    log: DataFrame,
    tags: DataFrame,
    lexicon: DataFrame,
    k: int = TOP_LABELS,
    key: Sequence[str] | None = None,
    simplify: Mapping[str, str] | None = None,
    by_lexicon: bool = False,
) -> DataFrame:
    """(imei, key_word, words, labels): all terms with a search tag, and the ``k`` most frequent
    tag paths of the terms found in ``tags``(word, taglayer)."""
    own = dedupe_map(tags.where(F.col("taglayer") != ""), "word", "taglayer")
    terms = _tagged(lexicon, keep_nature(prefixes=SEARCH_NATURES))
    labels = F.when(F.col("taglayer").isNotNull(), F.array("taglayer")).otherwise(F.array().cast("array<string>"))
    dictionary = terms.join(own, "word", "left").select("word", labels.alias("labels"))
    return _score_log(log, dictionary, k, key, lexicon if by_lexicon else None, simplify)


def _class_sets(dictionary: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """(word, labels): the distinct classes of each word with their names, by id.

    Names are added to the dictionary, which is far smaller than the log. It is dealt out by word once,
    for the distinct pairs, the lists and the join that follows."""
    names = hierarchy.groupBy("id").agg(F.min("name").alias("name"))
    pairs = dictionary.select("word", F.col("s_id").alias("id")).repartition("word").distinct()
    named = lookup_join(pairs, names, "id", "left")
    return named.groupBy("word").agg(F.sort_array(F.collect_list(F.struct("id", "name"))).alias("labels"))


def match_classes(
    log: DataFrame,
    dictionary: DataFrame,
    hierarchy: DataFrame,
    lexicon: DataFrame,
    k: int = TOP_LABELS,
    key: Sequence[str] | None = None,
    simplify: Mapping[str, str] | None = None,
    by_lexicon: bool = False,
    fail_on_unknown: bool = True,
) -> DataFrame:
    """(imei, key_word, words, class_ids, class_names): noun terms found in
    ``dictionary``(word, s_id), the ``k`` best class ids and their two-level names from
    ``hierarchy``(id, name). An id without a name is an error unless told otherwise."""
    nouns = _tagged(lexicon, keep_nature())
    sets = _class_sets(dictionary, hierarchy)
    scored = _score_log(log, sets.join(nouns, "word"), k, key, lexicon if by_lexicon else None, simplify)

    def name_of(x: Column) -> Column:
        name = x["label"]["name"]
        if not fail_on_unknown:
            return name
        unknown = F.raise_error(F.concat(F.lit("class without a name: "), x["label"]["id"].cast("string"))).cast("string")
        return F.when(name.isNotNull(), name).otherwise(unknown)

    return scored.withColumns(
        {
            "class_ids": F.transform("labels", lambda x: x["label"]["id"]),
            "class_names": F.transform("labels", name_of),
        }
    ).drop("labels")


def top_label(matched: DataFrame, labels: str = "class_names", keep_empty: bool = False) -> DataFrame:
    """(label, imei_count): log rows per label. ``keep_empty`` counts rows without a label as ''."""
    listed = F.when(F.size(labels) > 0, F.col(labels)).otherwise(F.array(F.lit(""))) if keep_empty else F.col(labels)
    return matched.select(F.explode(listed).alias("label")).groupBy("label").agg(F.count("*").alias("imei_count"))


def tag_rollup(matched: DataFrame, tags: str = "labels", depth: int = 3, keep_empty: bool = False) -> DataFrame:
    """(tag, cnt): counts at each of the first ``depth`` levels of the tag paths."""
    listed = F.when(F.size(tags) > 0, F.col(tags)).otherwise(F.array(F.lit(""))) if keep_empty else F.col(tags)
    paths = matched.select(F.explode(listed).alias("path"))
    levels = paths.groupBy("path").agg(F.count("*").alias("n")).select(F.explode(tag_prefixes("path", depth)).alias("tag"), "n")
    return levels.groupBy("tag").agg(F.sum("n").alias("cnt"))

