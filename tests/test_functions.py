from pyspark.sql import functions as F

from topicloom import functions as fn


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


def test_half_width(spark):
    row = one(spark, fn.to_half_width(F.lit("ＮＩＡ　ｚ～｟中")), fn.to_half_width(fn.to_half_width(F.lit("ａ！"))))
    assert row[0] == "NIA z~｟中"
    assert row[1] == "a!"


def test_simplified(spark):
    assert one(spark, fn.to_simplified(F.lit("漢語abc"), {"漢": "汉", "語": "语"}))[0] == "汉语abc"


def test_split_java(spark):
    row = one(spark, *[fn.split_java(F.lit(t), ",") for t in ("a,b,,", "", ",", "a,,b", "q")])
    assert list(row) == [["a", "b"], [""], [], ["a", "", "b"], ["q"]]


def test_weighted_codec(spark):
    parsed = one(spark, fn.parse_weighted(F.lit("w;1.5,bad,;2,x;")))[0]
    assert [tuple(p) for p in parsed] == [("w", 1.5), ("", 0.0), ("", 2.0), ("", 0.0)]
    assert one(spark, fn.format_weighted(fn.parse_weighted(F.lit("w|1.5,x|2"), "|"), "|"))[0] == "w|1.5,x|2.0"


def test_weighted_strict(spark):
    import pytest
    from pyspark.errors import PySparkException

    with pytest.raises(PySparkException):
        one(spark, fn.parse_weighted(F.lit("bad"), strict=True))


def test_tag_prefixes(spark):
    row = one(spark, *[fn.tag_prefixes(F.lit(t)) for t in ("A", "A-B", "A-B-C", "A-B-C-D", "")])
    assert list(row) == [["A"], ["A", "A-B"], ["A", "A-B", "A-B-C"], ["A", "A-B", "A-B-C"], [""]]


def test_ids(spark):
    assert one(spark, fn.split_ids(F.lit("a,b|c")), fn.join_ids(F.array(F.lit("a"), F.lit("b"))))[:] == (["a", "b", "c"], "a|b")


def vec(*xs):
    return F.array(*[F.lit(float(x)) for x in xs])


def test_vectors(spark):
    row = one(
        spark,
        fn.vec_dot(vec(1, 2), vec(3, 4)),
        fn.vec_norm(vec(3, 4)),
        fn.vec_normalize(vec(3, 4)),
        fn.vec_axpy(2.0, vec(1, 1), vec(0, 5)),
        fn.cosine(vec(1, 0), vec(0, 0)),
        fn.truncate6(vec(-0.1234567, 0.9999999)),
        fn.string_to_vec(fn.vec_to_string(vec(1.25, -3))),
        fn.sparse_dot(F.array(F.lit(0), F.lit(2)), vec(5, 7), vec(1, 10, 2)),
        fn.sparse_to_dense(3, F.array(F.lit(0), F.lit(2)), vec(5, 7)),
    )
    assert row[0] == 11 and row[1] == 5 and row[2] == [0.6, 0.8] and row[3] == [2, 7] and row[4] is None
    assert row[5] == [-0.123456, 0.999999] and row[6] == [1.25, -3] and row[7] == 19 and row[8] == [5, 0, 7]


def test_vec_sum(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0], 2.0), (1, [3.0, 4.0], 0.5), (2, [1.0, 1.0], 0.0)], "k int, v array<double>, w double")
    got = {r.k: (r.s, r.ws) for r in rows.groupBy("k").agg(fn.vec_sum("v").alias("s"), fn.vec_sum("v", "w").alias("ws")).collect()}
    assert got[1] == ([4, 6], [3.5, 6])
    assert got[2][0] == [1, 1]


def test_size_mismatch(spark):
    import pytest
    from pyspark.errors import PySparkException

    with pytest.raises(PySparkException):
        one(spark, fn.vec_dot(vec(1, 2), vec(1)))
