import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from topicloom.sources import embeddings, files, tables


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_load_delimited(spark, tmp_path):
    path = write(tmp_path / "f", "a||b||c", "a||b", "a||b||c||d", "a||b||", "x||||z")
    got = files.load_delimited(spark, path, r"\|\|", ["p", "q", "r"]).collect()
    assert [tuple(r) for r in got] == [("a", "b", "c"), ("x", "", "z")]
    seven = write(tmp_path / "g", "1,2,3,4,5,6,7", "1,2")
    assert [tuple(r) for r in files.load_delimited(spark, seven, ",", list("abcdefg")).collect()] == [tuple("1234567")]


def test_load_typed_csv(spark, tmp_path):
    path = write(tmp_path / "f", "w,1,2,3,4,a,b,c,d", "short,1", "v,x,2,3,4,a,b,c,d")
    with pytest.raises(PySparkException):
        files.load_typed_csv(spark, path).collect()
    assert [r.f_id for r in files.load_typed_csv(spark, path, strict=False).collect()] == [1, None]


def test_load_corpus(spark, tmp_path):
    path = write(tmp_path / "f", "x" * 100, "y" * 101, "z" * 300)
    rows = files.load_corpus(spark, path, "p_").collect()
    assert sorted(r.msg[0] for r in rows) == ["y", "z"]
    assert len({r.id for r in rows}) == 2 and all(r.id.startswith("p_") for r in rows)


def test_hierarchy(spark, tmp_path):
    labels = write(tmp_path / "l", "1,top ", "2,sub", "bad", "3,x,y")
    classes = write(tmp_path / "c", "1,2,whatever", "1")
    assert [tuple(r) for r in files.load_class_hierarchy(spark, labels, classes).collect()] == [(2, "top-sub")]
    with pytest.raises(PySparkException):
        files.load_class_hierarchy(spark, labels, write(tmp_path / "d", "1,9")).collect()


def test_save_partition(spark, tmp_path):
    table = str(tmp_path / "t")
    rows = spark.range(5).withColumn("s", F.lit("x"))
    tables.save_partition(rows, table, "20240101")
    tables.save_partition(rows, table, 20240102)
    tables.save_partition(rows.where("id > 7").toDF("other", "names"), table, 20240101)
    assert tables.read_partition(spark, table, 20240101).count() == 0
    back = tables.read_partition(spark, table)
    assert back.count() == 5 and back.columns == ["id", "s", "stat_date"] and dict(back.dtypes)["stat_date"] == "bigint"
    with pytest.raises(ValueError):
        tables.save_partition(rows.select("s"), table, 1)


def test_save_partition_keeps_old_rows_when_the_write_fails(spark, tmp_path):
    table = str(tmp_path / "t")
    rows = spark.range(6).withColumn("s", F.lit("x"))
    tables.save_partition(rows, table, 1)
    failing = rows.withColumn("id", F.when(F.col("id") > 3, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).cast("bigint"))
    with pytest.raises(Exception, match="boom"):
        tables.save_partition(failing, table, 1)
    assert sorted(r.id for r in tables.read_partition(spark, table, 1).collect()) == list(range(6))
    # rows computed from the partition they replace
    tables.save_partition(tables.read_partition(spark, table, 1, ["id", "s"]).where("id % 2 = 0"), table, 1)
    assert sorted(r.id for r in tables.read_partition(spark, table, 1).collect()) == [0, 2, 4]
    assert tables.read_partition(spark, table).count() == 3  # no staging folder is read


def test_schema():
    assert tables.create_schema([("a", "INT"), ("b", "Bool")]).simpleString() == "struct<a:int,b:boolean>"
    assert tables.create_string_schema(["a"]).simpleString() == "struct<a:string>"
    with pytest.raises(ValueError):
        tables.create_schema([("a", "decimal")])


def test_embeddings(spark, tmp_path):
    rows = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [0.5, 0.25])], "word string, vec array<double>")
    path = str(tmp_path / "e")
    embeddings.save_embeddings(rows, path)
    assert {r.word: r.vec for r in embeddings.load_embeddings(spark, path).collect()} == {"a": [1, 2], "b": [0.5, 0.25]}
    rows.limit(1).withColumnRenamed("vec", "vector").select("word", F.col("vector").cast("array<float>")).write.mode("append").parquet(path + "/data")
    with pytest.raises(ValueError):
        embeddings.load_embeddings(spark, path)
