import random

import pytest
from pyspark.sql import functions as F

from topicloom.operators import filters, ranking
from topicloom.operators.skew import dense_index, hot_keys, lookup_join, ranked_within, salted_join, table_bytes, top_per_group


@pytest.fixture(scope="module")
def sides(spark):
    random.seed(3)
    keys = ["hot"] * 60 + [f"k{random.randrange(12)}" for _ in range(60)]
    left = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, key string")
    right = spark.createDataFrame([("hot", "a", 60), ("hot", "b", 60), ("k1", "c", 5), ("k2", "d", 5), ("zz", "e", 1)], "key string, v string, heat int")
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("heat", [None, "heat"])
def test_salted_join_equals_join(sides, how, heat):
    left, right = sides
    want = sorted(map(str, left.join(right, "key", how).collect()))
    got = sorted(map(str, salted_join(left, right, "key", how, heat, rows_per_salt=7).collect()))
    assert got == want


def test_lookup_join_falls_back(sides):
    left, right = sides
    for max_bytes in (0, 1 << 20):
        assert lookup_join(left, right, "key", max_bytes=max_bytes).count() == left.join(right, "key").count()
    assert table_bytes(right) > table_bytes(right.where("v = 'a'")) > 0 == table_bytes(right.where("false"))


def test_every_hot_key_is_split(spark):
    """More hot keys than any fixed list would hold; each piece stays below the larger of both bounds."""
    counts = spark.range(3_000).select(F.col("id").cast("string").alias("key"), (F.col("id") % 3 * 50 + 5).alias("n"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum("n")).first()[0]
    assert hot_keys(counts, "key", "n", 10).count() == 0 and total / (4 * partitions) > 105
    one = counts.unionByName(spark.createDataFrame([("big", 10 * total)], "key string, n long"))
    found = hot_keys(one, "key", "n", 10).collect()
    assert [r["key"] for r in found] == ["big"] and found[0]["_pieces"] >= 3 * partitions
    spark.conf.set("spark.sql.shuffle.partitions", "1000")
    try:
        assert hot_keys(counts, "key", "n", 10).count() == 2_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))


def test_ranked_within(spark):
    rows = spark.range(300).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    got = {(r.g, r.v): r["rank"] for r in ranked_within(rows, "g", [F.desc("v")]).collect()}
    assert got == {(i % 3 or None, i): (299 - i) // 3 + 1 for i in range(300)}


def test_large_top_k_needs_no_single_task(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SMALL_K", 5)
    rows = spark.range(1_000).select((F.col("id") * 7919 % 1000).alias("x"))
    top = ranking.top_k(rows, [F.desc("x")], 20)
    assert sorted(r.x for r in top.collect()) == list(range(980, 1000))
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "SinglePartition" not in plan.split("Window")[0]


def test_dense_index(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(7)
    got = dense_index(rows, ["x"], "n").collect()
    assert all(r.x == r.n for r in got) and len(got) == 1000


@pytest.mark.parametrize("pieces", [1, 4])
def test_top_per_group(spark, pieces):
    rows = spark.range(200).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    got = top_per_group(rows, ["g"], [F.desc("v")], 2, pieces).collect()
    assert sorted((r.g, r.v, r["rank"]) for r in got) == [(0, 195, 2), (0, 198, 1), (1, 196, 2), (1, 199, 1), (2, 194, 2), (2, 197, 1)]


def test_label_fanout_edges(spark):
    pairs = spark.range(400).select(F.lit("many").alias("word"), F.col("id").alias("label"))
    few = spark.range(399).select(F.lit("few").alias("word"), F.col("id").alias("label"))
    got = filters.max_label_fanout(pairs.unionByName(few).unionByName(few)).collect()
    assert [(r.word, r.labels) for r in got] == [("few", list(range(399)))]


def test_cluster_size_edges(spark):
    members = spark.range(101).select(F.lit("a").alias("class_id"), "id").unionByName(spark.range(100).select(F.lit("b").alias("class_id"), "id"))
    assert filters.min_cluster_size(members, 100).groupBy("class_id").count().collect()[0][:] == ("a", 101)


def test_rank_tail_and_drop_last(spark):
    rows = spark.range(10).select(F.lit(1).alias("g"), F.col("id").alias("v"))
    assert sorted(r.v for r in ranking.rank_tail(rows, ["g"], [F.asc("v")]).collect()) == [8, 9]
    assert sorted(r.v for r in ranking.rank_drop_last(rows, ["g"], [F.asc("v")]).collect()) == list(range(9))


def test_stop_words_by_df_divides_integers(spark):
    docs = spark.range(29)
    counts = spark.createDataFrame([("a", 2), ("b", 3)], "word string, df bigint")
    assert [r.word for r in filters.stopwords_by_df(counts, docs).collect()] == ["b"]


def test_word_rules(spark):
    words = spark.createDataFrame([("小明", "nr"), ("王先生", "nr"), ("南京路", "ns"), ("科技", "n"), ("a!", "nx"), ("ab", "nx"), ("x", "n")], "word string, nature string")
    kept = words.where(filters.keep_nature() & filters.drop_affixes() & filters.drop_symbolic())
    assert sorted(r.word for r in kept.collect()) == ["ab", "科技"]
    assert [r.word for r in words.where(filters.keep_nature(exclude=["nr", "ns", "nx"])).collect()] == ["科技"]
