import math

import pytest
from pyspark.ml.feature import Normalizer
from pyspark.sql import functions as F

from topicloom.operators import embed, filters, labels, segment, stats, textrank


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "id string, msg string, words array<string>")


def test_doc_tfidf(spark):
    docs = docs_of(spark, [("1", "", ["a", "b", "b", "c"]), ("2", "", ["a", "b"]), ("3", "", ["a", "only"])])
    got = {(r.id, r.word): (r.weight, r["rank"]) for r in stats.doc_tfidf(docs).collect()}
    n = math.log(4)
    assert set(got) == {("1", "b"), ("2", "b")}
    assert got[("1", "b")] == (pytest.approx(n / 3 * 2 * 1000), 1)
    lists = {r.id: r.words for r in stats.doc_tfidf_lists(docs).collect()}
    assert lists["3"] == [] and [w.word for w in lists["1"]] == ["b"]


def test_tfidf_tie_goes_by_word(spark):
    docs = docs_of(spark, [("1", "", ["b", "a", "c"]), ("2", "", ["c", "b", "a"])])
    assert [r.word for r in stats.doc_tfidf(docs).where("id = '1'").orderBy("rank").collect()] == ["a", "b"]


def test_tfidf_lists_equal_ranked_words(spark):
    """Also where ids repeat or are null; no term of an id with one row is shuffled by itself."""
    rows = [(str(i), "", [f"w{i * j % 7}" for j in range(i % 9)] + ["b"] * (i % 3)) for i in range(40)]
    docs = docs_of(spark, [*rows, ("3", "", ["b", "w1"]), (None, "", ["b", "w2"]), (None, "", ["w2", "own"]), ("none", "", None)])
    for drop in (True, False):
        ranked = {}
        for r in stats.doc_tfidf(docs, drop_last=drop).orderBy("id", "rank").collect():
            ranked.setdefault(r.id, []).append((r.word, r.weight))
        lists = {r.id: [(w.word, w.weight) for w in r.words] for r in stats.doc_tfidf_lists(docs, drop_last=drop).collect()}
        assert {k: v for k, v in lists.items() if v} == ranked and None in lists and "none" not in lists
    own = stats.doc_tfidf_lists(docs.where("id <> '3'"))
    assert "collect_list" not in own._jdf.queryExecution().toString()


def plain_textrank(tokens):
    """The scores by definition, one word at a time."""
    near = {}
    for i, w in enumerate(tokens):
        near.setdefault(w, set()).update(tokens[max(0, i - 5) : i] + tokens[i + 1 : i + 5])
    score = dict.fromkeys(near, 0.0)
    for _ in range(20):
        score = {w: 0.15 + 0.85 * sum(score[o] for o in near[w] if o != w) for w in near}
    return score


@pytest.mark.parametrize("text", ["solo", "a b", "a b c d e f g", "x y x z y x q w e r t x", "a a a"])
def test_textrank(spark, text):
    tokens = text.split()
    rows = textrank.textrank(docs_of(spark, [("1", "", tokens)])).collect()
    want = plain_textrank(tokens)
    assert {r.word: pytest.approx(r.score) for r in rows} == want
    assert rows[0].n_words == len(want)
    assert [r.word for r in sorted(rows, key=lambda r: r["rank"])] == sorted(want, key=lambda w: (-round(math.log(want[w]), 9), w))


def test_textrank_empty_and_by_doc(spark):
    docs = docs_of(spark, [("1", "m", []), ("2", "n", ["b", "a"]), ("3", "o", None)])
    got = {r.id: [t.word for t in r.textrank] for r in textrank.textrank_by_doc(docs).collect()}
    assert got == {"1": [], "2": ["a", "b"], "3": []}


def test_edges_reach_five_back_four_ahead(spark):
    tokens = list("abcdefg")
    got = {(r.word, r.neighbour) for r in textrank.cooccurrence_edges(docs_of(spark, [("1", "", tokens)])).collect()}
    assert ("f", "a") in got and ("a", "f") not in got and ("a", "e") in got and ("g", "a") not in got


def test_neighbour_lists_equal_grouped_edges(spark):
    """Also where ids repeat or are null; lists of ids with one row are made without shuffling pairs."""
    rows = [("1", "", list("abcab")), ("2", "", ["é", "z", "Z", "\U0001f600", "\uffff"]), ("2", "", ["z", "é"]), (None, "", ["x", "y"]), (None, "", ["y", "x"]), ("3", "", ["one"]), ("4", "", None)]
    docs = docs_of(spark, rows)
    edges = textrank.cooccurrence_edges(docs).groupBy("id", "word").agg(F.sort_array(F.collect_list("neighbour")).alias("neighbours"))
    listed = textrank.cooccurrence_edges(docs, per_word=True)
    assert sorted(map(repr, listed.collect())) == sorted(map(repr, edges.collect()))
    own = textrank.cooccurrence_edges(docs.where("id in ('1', '3', '4')"), per_word=True)
    assert own.count() == 3 and "collect_list" not in own._jdf.queryExecution().toString()


HAN = ["我喜欢科学技术和abc大学生活", "科学技术大学", "plain words only", "Ｘ中国人民 mixed 中国", ""]


def test_han_segmentation_paths_agree(spark):
    lexicon = ["科学", "科学技术", "技术", "大学", "大学生", "生活", "喜欢", "中国", "人民", "中国人"]
    words = spark.createDataFrame([(w,) for w in lexicon], "word string")
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(HAN)], "id string, msg string")
    by_set = {r.id: r.words for r in segment.segment(rows, lexicon=words).collect()}
    by_join = {r.id: r.words for r in segment.segment(rows, lexicon=words, max_bytes=0).collect()}
    assert by_set == by_join
    assert by_set["0"] == ["我", "喜欢", "科学技术", "和", "abc", "大学生", "活"]
    assert by_set["3"] == ["x", "中国人", "民", "mixed", "中国"]
    assert by_set["4"] == []


def test_han_paths_take_long_words_and_obey_the_pattern(spark):
    long = "一二三四五六七八九十"
    words = spark.createDataFrame([(long,), ("科技",)], "word string")
    rows = spark.createDataFrame([("1", f"x{long}科技 9科技"), ("1", f"x{long}科技 9科技"), ("2", None), ("3", "々一")], "id string, msg string")
    for pattern, want in ((r"[\p{L}]+", ["x", long, "科技", "科技"]), (r"[\p{L}0-9]+", ["x", long, "科技", "9", "科技"])):
        for max_bytes in (0, 1 << 20):
            got = segment.segment(rows, lexicon=words, pattern=pattern, max_bytes=max_bytes).select("id", "words").collect()
            assert sorted((r.id, r.words) for r in got if r.id == "1") == [("1", want)] * 2
            assert [r.words for r in got if r.id == "2"] == [None] and len(got) == 4


def test_repeated_search_texts_keep_their_own_words(spark):
    """Three users search the same; both paths give each of them the same words and counts."""
    log = spark.createDataFrame([(f"u{i}", "科技,camera") for i in range(3)], "imei string, key_word string")
    index = spark.createDataFrame([("camera", "c1"), ("科技", "c2")], "word string, label string")
    lexicon = spark.createDataFrame([("camera", "n", 1), ("科技", "n", 1)], "word string, nature string, freq long")
    for key in (None, ["imei"]):
        for max_bytes in (0, 1 << 20):
            got = labels.match_labels(log, index, lexicon, key=key, by_lexicon=True, max_bytes=max_bytes).collect()
            assert sorted(r.imei for r in got) == ["u0", "u1", "u2"]
            assert all(r.words == ["科技", "camera"] and [tuple(x) for x in r.labels] == [("c1", 1), ("c2", 1)] for r in got)


def test_user_words_win(spark):
    lexicon = spark.createDataFrame([("a", "n", 5000), ("b", "n", 1)], "word string, nature string, freq bigint")
    user = spark.createDataFrame([("a", "mbk"), ("c", "mbk")], "word string, nature string")
    got = {r.word: (r.nature, r.freq) for r in segment.with_user_words(lexicon, user).collect()}
    assert got == {"a": ("mbk", 1024), "b": ("n", 1), "c": ("mbk", 1024)}


def test_term_vectors(spark):
    docs = docs_of(spark, [("1", "", ["b", "a", "b"]), ("2", "", []), ("3", "", ["b"])])
    got = {r.id: (r.num_features, r.indices, r["values"]) for r in stats.term_vectors(docs).collect()}
    assert got == {"1": (2, [0, 1], [2.0, 1.0]), "2": (2, [], []), "3": (2, [0], [1.0])}
    stage = stats.TermVectors(inputCol="words", outputCol="f")
    made = stage.transform(docs)
    rows = {r.id: r.f for r in made.collect()}
    assert rows["1"].values.tolist() == [2.0, 1.0] and rows["1"].size == stage.getNumFeatures() == 2
    assert "scaled" in Normalizer(inputCol="f", outputCol="scaled").transform(made).columns
    with pytest.raises(TypeError):
        stats.TermVectors(inputCol="msg").transform(docs)


def test_term_vectors_stage_saves(spark, tmp_path):
    stats.TermVectors(inputCol="words", outputCol="f").save(str(tmp_path / "stage"))
    assert stats.TermVectors.load(str(tmp_path / "stage")).getOutputCol() == "f"


def test_word2vec(spark):
    docs = docs_of(spark, [(str(i), "", ["a", "b", "c"] * 5 + ["rare"]) for i in range(3)])
    vectors = embed.word_vectors(embed.train_word2vec(docs, size=4, min_count=5, partitions=1))
    assert sorted(r.word for r in vectors.collect()) == ["a", "b", "c"]
    near = embed.find_synonyms(vectors, "a", 5).collect()
    assert {r.word for r in near} == {"b", "c"} and near[0].similarity >= near[1].similarity
    assert len(embed.word_vector(vectors, "a")) == 4
    with pytest.raises(KeyError):
        embed.word_vector(vectors, "rare")


@pytest.fixture(scope="module")
def lexicon(spark):
    rows = [(w, "n", 10) for w in ("phone", "case", "song")] + [("run", "v", 5), ("brand", "mbk", 2)]
    return spark.createDataFrame(rows, "word string, nature string, freq bigint")


def test_match_labels(spark, lexicon):
    log = spark.createDataFrame([("u1", "phone case,phone"), ("u1", "phone case,phone"), ("u2", "run zzz"), ("u3", "")], "imei string, key_word string")
    index = spark.createDataFrame([("phone", i) for i in range(7)] + [("case", 6), ("run", 1)], "word string, label int")
    rows = labels.match_labels(log, index, lexicon).collect()
    assert sorted(r.imei for r in rows) == ["u1", "u1", "u2", "u3"]
    first = [r for r in rows if r.imei == "u1"][0]
    assert first.words == ["phone", "case", "phone"]
    assert [(x.label, x.n) for x in first.labels] == [(6, 3), (0, 2), (1, 2), (2, 2), (3, 2)]
    assert all(r.words == [] and r.labels == [] for r in rows if r.imei != "u1")


def test_match_tags_and_rollup(spark, lexicon):
    log = spark.createDataFrame([("u1", "phone brand case"), ("u2", "song")], "imei string, key_word string")
    tags = spark.createDataFrame([("phone", "A-B-C-D"), ("case", "A-B"), ("song", "")], "word string, taglayer string")
    rows = labels.match_tags(log, tags, lexicon)
    got = {r.imei: (r.words, [x.label for x in r.labels]) for r in rows.collect()}
    assert got == {"u1": (["phone", "brand", "case"], ["A-B", "A-B-C-D"]), "u2": (["song"], [])}
    named = rows.select(F.transform("labels", lambda x: x["label"]).alias("labels"))
    assert {r.tag: r.cnt for r in labels.tag_rollup(named).collect()} == {"A": 2, "A-B": 2, "A-B-C": 1}
    assert {r.tag: r.cnt for r in labels.tag_rollup(named, keep_empty=True).collect()}[""] == 1


def test_match_classes(spark, lexicon):
    from pyspark.errors import PySparkException

    log = spark.createDataFrame([("u1", "phone phone case")], "imei string, key_word string")
    words = spark.createDataFrame([("phone", 1), ("phone", 2), ("case", 2)], "word string, s_id int")
    names = spark.createDataFrame([(1, "X-one"), (2, "X-two")], "id int, name string")
    row = labels.match_classes(log, words, names, lexicon).first()
    assert (row.class_ids, row.class_names) == ([2, 1], ["X-two", "X-one"])
    with pytest.raises(PySparkException):
        labels.match_classes(log, words, names.where("id = 1"), lexicon).collect()
    assert labels.match_classes(log, words, names.where("id = 1"), lexicon, fail_on_unknown=False).first().class_names == [None, "X-one"]


def test_inverted_index_round_trip(spark):
    rows = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "a", 5)], "class_id int, word string, weight bigint")
    index = labels.word2label(rows)
    back = labels.word2label(index.select(F.col("label").alias("word"), F.col("word").alias("class_id"), F.col("cnt").alias("weight")))
    assert {(r.word, r.label, r.cnt) for r in back.collect()} == {(1, "a", 2), (1, "b", 1), (2, "a", 5)}


def test_terms_of_a_search_travel_without_its_text(spark, lexicon):
    """Equal rows of one key add up; only numbers and words are dealt out, never a text with each of its terms."""
    log = spark.createDataFrame([("u1", "phone case", 1)] * 2 + [("u2", None, 1)], "imei string, key_word string, turn int")
    index = spark.createDataFrame([("phone", "b"), ("phone", "a"), ("case", "b")], "word string, label string")
    found = labels.match_labels(log, index, lexicon, key=["imei", "turn"])
    got = {r.imei: (r.words, [tuple(x) for x in r.labels]) for r in found.collect()}
    assert got == {"u1": (["phone", "phone", "case", "case"], [("b", 4), ("a", 2)]), "u2": ([], [])}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    dealt = next(line for line in plan.splitlines() if "RepartitionByExpression" in line)
    assert "_row" in dealt and "key_word" not in dealt


@pytest.mark.parametrize("mode", ["sum", "unit", "tfidf"])
def test_vectors_too_large_to_broadcast(spark, mode):
    """Both paths agree on repeated rows, null keys, repeated words and gaps in vectors; no partial sums are dealt."""
    from topicloom.operators.docvec import doc_vectors

    plain = [("a", ["x", "y", "x", "z"]), ("b", None), ("c", []), ("a", ["x", "y", "x", "z"]), (None, ["x", "z"]), ("d", ["zz"]), ("e", ["n", "n"])]
    listed = [("a", [("x", 1.0), ("q", 2.0), ("z", 3.0)]), ("b", [("q", 1.0), ("r", 2.0)]), ("n", [("n", 2.0), ("n", 2.0)]), (None, [("x", 1.0), ("y", 1.0)])]
    kind = "id string, words array<string>" if mode != "tfidf" else "id string, words array<struct<word:string,weight:double>>"
    docs = spark.createDataFrame(plain if mode != "tfidf" else listed, kind)
    vectors = [("x", [1.0, 2.0]), ("y", [0.5, -1.0]), ("x", [1.0, 1.0]), ("z", [None, 4.0]), ("n", [None, 1.0]), ("m", None)]
    known = spark.createDataFrame(vectors, "word string, vec array<double>")
    large = doc_vectors(docs, known, mode, min_tokens=1, max_bytes=0)
    assert sorted(map(str, large.collect())) == sorted(map(str, doc_vectors(docs, known, mode, min_tokens=1).collect()))
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "sum(" not in plan


@pytest.mark.parametrize("drop", [False, True])
def test_lists_meet_a_large_word_table_by_chunks(spark, drop):
    rows = [("a", ["x", "y", "x", "z"]), ("b", None), ("c", []), ("a", ["x", "y", "x", "z"]), (None, ["q", "z"]), ("d", ["zz"])]
    docs = spark.createDataFrame(rows, "id string, words array<string>")
    words = spark.createDataFrame([("x",), ("z",), ("x",)], "word string")
    large = filters.keep_words(docs, words, drop, max_bytes=0)
    assert sorted(map(str, large.collect())) == sorted(map(str, filters.keep_words(docs, words, drop).collect()))
    assert "collect_list" not in large._jdf.queryExecution().optimizedPlan().toString()


def test_a_run_is_cut_once_however_many_texts_hold_it(spark):
    docs = spark.createDataFrame([(str(i), "天地玄 天地") for i in range(5)] + [("x", None), ("y", "ab")], "id string, msg string")
    lexicon = spark.createDataFrame([("天地", "n", 1)], "word string, nature string, freq long")
    found = segment.segment(docs, lexicon=lexicon, max_bytes=0)
    got = {r.id: r.words for r in found.collect()}
    assert got == {**{str(i): ["天地", "玄", "天地"] for i in range(5)}, "x": None, "y": ["ab"]}
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    longest = [line for line in plan if "max_by(" in line]
    assert longest and all("_text" in line and "_key" not in line for line in longest)


def test_classes_of_a_dictionary_are_dealt_out_by_word_once(spark):
    rows = [("x", 2), ("x", 1), ("x", 2), ("y", None), ("y", 9), (None, 1)]
    dictionary = spark.createDataFrame(rows, "word string, s_id int")
    names = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (None, "z")], "id int, name string")
    sets = labels._class_sets(dictionary, names)
    assert {r.word: [tuple(x) for x in r.labels] for r in sets.collect()} == {"x": [(1, "a"), (2, "c")], "y": [(None, None), (9, None)], None: [(1, "a")]}
    plan = sets._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    dealt = [line for line in plan.splitlines() if "hashpartitioning(word" in line]
    assert len(dealt) == 1 and "REPARTITION_BY_COL" in dealt[0]


@pytest.mark.parametrize("name", ["c2_match_tags", "c3_match_classes", "a11_top_label", "a12_tag_rollup"])
def test_the_lexicon_is_stored_once(spark, tmp_path, monkeypatch, name):
    from topicloom.plans import inputs, queries

    tables = {
        "documents": ([(1, "bridge paper bridge", "en", "web"), (2, None, None, "web")], "doc_id long, text string, lang string, source string"),
        "conversations": ([(1, 0, "user", "paper bridge bridge to"), (1, 1, "user", None)], "conv_id long, turn int, role string, text string"),
        "nation": ([(0, "ONLY", 3)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(3, "PART")], "r_regionkey int, r_name string"),
    }
    for table, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{table}.parquet"))
    stored, lexicon = [], inputs.lexicon
    monkeypatch.setattr(inputs, "lexicon", lambda *given: stored.append(given) or lexicon(*given))
    got = sorted(tuple(r) for r in queries.CATALOG[name](spark, str(tmp_path)).collect())
    want = {
        "c2_match_tags": [("1", 0, "paper,bridge,bridge", "b-br-bridge"), ("1", 1, "", "")],
        "c3_match_classes": [("1", 0, "paper,bridge,bridge", "100", "PART-ONLY"), ("1", 1, "", "", "")],
        "a11_top_label": [("PART-ONLY", 1)],
        "a12_tag_rollup": [("b", 1), ("b-br", 1), ("b-br-bridge", 1)],
    }
    assert got == want[name] and len(stored) == 1


def test_labels_are_counted_inside_a_row(spark, lexicon):
    """No row per label of a term is made; ties go by id, repeated rows and repeated terms add up."""
    log = spark.createDataFrame([("u1", "phone case phone song", 1)] * 2 + [("u2", "phone", 1), ("u3", "to", 1), ("u4", None, 1)], "imei string, key_word string, turn int")
    classes = spark.createDataFrame([("phone", 3), ("phone", 2), ("case", 2), ("song", 5), ("song", 4)], "word string, s_id int")
    names = spark.createDataFrame([(i, f"n{i}") for i in range(2, 6)], "id int, name string")
    found = labels.match_classes(log, classes, names, lexicon, k=3, key=["imei", "turn"])
    got = {r.imei: (r.words, r.class_ids) for r in found.collect()}
    one = ["phone", "phone", "case", "case", "phone", "phone", "song", "song"]
    assert got == {"u1": (one, [2, 3, 4]), "u2": (["phone"], [2, 3]), "u3": ([], []), "u4": ([], [])}
    index = spark.createDataFrame([("phone", "b"), ("phone", "a"), ("case", "b")], "word string, label string")
    counts = labels.match_labels(log, index, lexicon, key=["imei", "turn"])
    assert {r.imei: [tuple(x) for x in r.labels] for r in counts.collect()} == {"u1": [("b", 6), ("a", 4)], "u2": [("a", 1), ("b", 1)], "u3": [], "u4": []}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(concat" not in plan and plan.count("Generate") == 2


@pytest.mark.parametrize("size", [1, 8 << 20])
def test_a_lexicon_that_is_joined_gives_the_longest_words_however_many_substrings_pass(spark, monkeypatch, size):
    """With a filter of 8 bits nearly all substrings pass; words are those of the broadcast set, and no word of a text is dealt out."""
    monkeypatch.setattr(segment, "FILTER_BYTES", size)
    monkeypatch.setattr(segment, "CHUNK_CHARS", 40)
    words = spark.createDataFrame([("天地",), ("地玄黄",), ("玄黄宇宙",), ("宇",), ("𠀀𠀁",), ("plain",)], "word string")
    texts = ["天地玄黄宇宙", "地玄黄宇宙ab天地", "x𠀀𠀁𠀀地玄", "", None, "only letters", "宇宙 宇 洪荒"]
    rows = spark.createDataFrame([(i % 5, t) for i, t in enumerate(texts * 4)], "id int, msg string")
    want = segment.segment(rows, lexicon=words)
    found = segment.segment(rows, lexicon=words, max_bytes=0)
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect())) and found.schema == want.schema
    assert "posexplode" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_documents_are_dealt_out_once_to_their_vectors(spark, monkeypatch):
    """Large vectors: lists are filtered in the one chunk pass that sums, weighted lists are made once, and vectors travel in single precision only if nothing is lost."""
    from topicloom.operators import docvec

    docs = spark.createDataFrame([("a", ["x", "q", "y", "x"]), ("b", ["x", "q", "q"]), ("c", None), (None, ["x", "y"])], "id string, words array<string>")
    for exact, cell in ((0.5, "float"), (0.1, "double")):
        known = spark.createDataFrame([("x", [1.0, 2.0]), ("y", [exact, -1.0])], "word string, vec array<double>")
        made = docvec.doc_vectors(docs, known, "sum", min_tokens=1, max_bytes=0)
        assert [(r.id, r.words, r.vec) for r in made.collect()] == [("a", ["x", "y", "x"], [2.0 + exact, 3.0])]
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("FlatMapCoGroupsInArrow") == 1 and ("as float" in plan) == (cell == "float")
    lists = stats.doc_tfidf_lists(docs.where("id is not null"), min_df=0)
    made = docvec.doc_vectors(lists, known, "tfidf", min_tokens=0, max_bytes=0)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("FlatMapCoGroupsInArrow") == 1 and made.count() == 2
