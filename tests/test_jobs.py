"""All jobs in order, from text files to label counts."""

from pyspark.sql import functions as F

from topicloom.__main__ import main
from topicloom.plans.jobs import Jobs


def lines(path, rows):
    path.write_text("\n".join(rows) + "\n", encoding="utf-8")
    return str(path)


TOPICS = {"phone": "phone screen battery camera charger display", "music": "guitar melody concert singer album rhythm"}


def test_jobs(spark, tmp_path):
    jobs = Jobs(spark, str(tmp_path / "store"))
    texts = [" ".join([w.split()[(i + k) % 6] for k in range(20)] + ["stopper"]) for i in range(6) for w in TOPICS.values()]
    jobs.load_corpus("1", lines(tmp_path / "corpus", texts), "d")
    jobs.load_stopwords("1", lines(tmp_path / "stop", ["stopper"]))
    jobs.load_file(lines(tmp_path / "rules", ["camera;0", "album;1"]), ";", "rulewords", "word,use_flag", "1")
    words = " ".join(TOPICS.values()).split() + ["stopper"]
    lexicon = spark.createDataFrame([(w, "n", 10) for w in words], "word string, nature string, freq bigint")
    jobs.save(lexicon, "lexicon", "1")

    jobs.segment_words("1", "1")
    seg = jobs.read("word_seg", "1").collect()
    assert len(seg) == 12 and all(len(r.words) == 20 and "stopper" not in r.words for r in seg)
    jobs.filter_words("1")
    assert "camera" not in {w for r in jobs.read("word_seg_filter", "1").collect() for w in r.words}
    jobs.corpus_statistics("1")
    assert jobs.read("tfidf_words", "1").count() == 12 and jobs.read("stopwords", "101").count() == 12
    jobs.document_statistics("1")
    assert {len(r.words) for r in jobs.read("tfidf_words_more", "1").collect()} == {5}
    jobs.keyword_ranks("1", "1", votes=5)
    assert jobs.read("textrank_words", "1").count() == 12 and jobs.read("textrank_mid", "1").count() == 12

    sound = {w: [1.0, 0.1] for w in TOPICS["phone"].split()} | {w: [0.1, 1.0] for w in TOPICS["music"].split()}
    jobs.save(spark.createDataFrame(list(sound.items()), "word string, vec array<double>"), "word_vec", "1")
    for mode in ("sum", "unit", "tfidf"):
        jobs.document_vectors("1", "1", mode)
        assert jobs.read(f"docvec_{mode}", "1").count() == 12

    jobs.subject_round("1", "2", True, 0.9)
    for dt in (2, 3):
        jobs.subject_round(str(dt), str(dt + 1), False, 0.9)
    table = jobs.read("subject_sum", "4").collect()
    assert sorted(r["size"] for r in table) == [6, 6]
    members = jobs.read("subject_sum_members", "4")
    assert members.select("member").distinct().count() == members.count() == 12

    jobs.label_documents("4", "1")
    labelled = {r.id: r.class_id for r in jobs.read("doc2label", "1").collect()}
    assert len(labelled) == 12 and set(labelled.values()) == {0, 1}
    assert jobs.label_words("4", "1") == 0
    jobs.word_labels("1", "1")
    assert jobs.read("word2label", "1").groupBy("word").count().where("count > 1").count() == 0

    log = spark.createDataFrame([("u1", "phone,battery guitar"), ("u2", "nothing")], "imei string, key_word string")
    jobs.save(log, "search_log", "7")
    jobs.match_log_labels("7", "1")
    assert {r.imei: [x.n for x in r.labels] for r in jobs.read("imei_label", "1").collect()} == {"u1": [2, 1], "u2": []}

    jobs.load_class_dictionary("7", lines(tmp_path / "classes", [f"{w},0,5,0,1,a,b,c,d" for w in words]))
    names = lines(tmp_path / "names", ["1,top", "5,sub"]), lines(tmp_path / "pairs", ["1,5"])
    jobs.match_log_classes("7", "7", *names)
    jobs.count_labels("7")
    assert {r.label: r.imei_count for r in jobs.read("top_label", "7").collect()} == {"top-sub": 1, "": 1}
    jobs.save(spark.createDataFrame([("phone", "A-B"), ("guitar", "A-C")], "word string, taglayer string"), "word_tags", "7")
    jobs.match_log_tags("7", "7")
    jobs.count_tags("7")
    assert {r.tag: r.cnt for r in jobs.read("tag_count", "7").collect()} == {"A": 2, "A-B": 1, "A-C": 1, "": 1}


def test_command_line(spark, tmp_path, capsys):
    jobs = Jobs(spark, str(tmp_path))
    jobs.save(spark.createDataFrame([("1", ["a", "b"]), ("2", ["a", "b"])], "id string, words array<string>"), "word_seg", 1)
    assert main(["document_statistics", f"root={tmp_path}", "dt=1"]) == 0
    assert jobs.read("tfidf_words_more", 1).select(F.size("words")).first()[0] == 1
    assert main(["no_such_job", "root=x"]) == 2
    assert "segment_words" in capsys.readouterr().out
