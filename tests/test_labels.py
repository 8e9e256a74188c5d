import pytest
from pyspark.sql import functions as F

from shelfmark.functions import labels


def test_classes_are_sorted():
    assert len(labels.CATEGORIES) == 22
    assert list(labels.CATEGORIES) == sorted(labels.CATEGORIES)


def test_encode_and_decode(spark):
    df = spark.createDataFrame([(c,) for c in reversed(labels.CATEGORIES)], "c string")
    ids = df.withColumn("i", labels.encode(F.col("c"), labels.CATEGORIES))
    rows = ids.withColumn("d", labels.decode(F.col("i"), labels.CATEGORIES)).collect()
    assert [r.i for r in rows] == list(reversed(range(22)))
    assert all(r.c == r.d for r in rows)


def test_encode_sorts_the_classes(spark):
    df = spark.createDataFrame([("b",), ("a",)], "c string")
    rows = df.select(labels.encode(F.col("c"), ["b", "a", "b"]).alias("i")).collect()
    assert [r.i for r in rows] == [1, 0]


@pytest.mark.parametrize("bad", ["Electronics", None])
def test_unseen(spark, bad):
    df = spark.createDataFrame([(bad,)], "c string")
    lenient = df.select(labels.encode(F.col("c"), labels.CATEGORIES, "null").alias("i"))
    assert lenient.first().i is None
    with pytest.raises(Exception, match="Unseen label"):
        df.select(labels.encode(F.col("c"), labels.CATEGORIES)).collect()


def test_decode_out_of_range(spark):
    df = spark.createDataFrame([(-1,), (22,), (None,)], "i int")
    rows = df.select(labels.decode(F.col("i"), labels.CATEGORIES).alias("c")).collect()
    assert [r.c for r in rows] == [None] * 3


def test_slug(spark):
    df = spark.createDataFrame([("Arts, Crafts & Sewing",), ("Movies & TV",)], "c string")
    rows = df.select(labels.slug(F.col("c")).alias("s")).collect()
    assert [r.s for r in rows] == ["Arts_Crafts_and_Sewing", "Movies_and_TV"]


def test_argmax_takes_the_first(spark):
    df = spark.createDataFrame([([0.1, 0.5, 0.5],), ([2.0],)], "s array<double>")
    assert [r.a for r in df.select(labels.argmax(F.col("s")).alias("a")).collect()] == [1, 0]
