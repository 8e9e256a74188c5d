import hashlib
import math

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import splits
from shelfmark.sources.readers import read_parquet


def draw(salt, key):
    return int(hashlib.md5(f"{salt}:{key}".encode()).hexdigest()[:8], 16) / 2**32


@pytest.fixture(scope="module")
def frame(spark):
    return spark.range(5000).select("id", (F.col("id") % 7).alias("v"))


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_key_sample_is_stable(frame):
    expected = [i for i in range(5000) if draw(9, i) < 0.25]
    assert ids(splits.sample(frame, 0.25, 9, "id")) == expected
    assert ids(splits.sample(frame.repartition(3, "v"), 0.25, 9, "id")) == expected


@pytest.mark.parametrize("key", [None, "id"])
def test_sample_bounds(frame, key):
    assert splits.sample(frame, 1.0, 1, key).count() == 5000
    assert splits.sample(frame, 0.0, 1, key).count() == 0
    assert abs(splits.sample(frame, 0.5, 1, key).count() - 2500) < 200
    for bad in (-0.1, 1.1):
        with pytest.raises(ValueError, match="fraction lies between"):
            splits.sample(frame, bad, 1, key)


@pytest.mark.parametrize("key", [None, "id"])
def test_three_way_is_a_partition(frame, key):
    parts = splits.three_way(frame, 42, key)
    sizes = [p.count() for p in parts]
    assert sorted(i for p in parts for i in ids(p)) == list(range(5000))
    for size, share in zip(sizes, (0.64, 0.16, 0.2)):
        assert abs(size - 5000 * share) < 150
    assert all(p.columns == frame.columns for p in parts)


def test_split_does_not_depend_on_partitions(frame):
    def marks(df):
        return {r.id: r.split for r in splits.assign_split(df, "id", 3).collect()}

    once = marks(frame)
    assert once == marks(frame.repartition(11, "v"))
    expected = {
        i: "test" if draw("3:1", i) >= 0.8 else "val" if draw("3:2", i) >= 0.8 else "train"
        for i in range(5000)
    }
    assert once == expected


def test_copies_share_a_split(spark):
    df = spark.range(3000).select((F.col("id") % 10).cast("string").alias("text"))
    marked = splits.assign_split(df, ["text"], 1)
    assert marked.distinct().count() == 10


@pytest.mark.parametrize("mode", ["global", "scatter"])
@pytest.mark.parametrize("key", [None, "id"])
def test_shuffle_keeps_rows_and_changes_order(frame, mode, key):
    def order(seed):
        return [r.id for r in splits.shuffle(frame, seed, key, mode).collect()]

    first, again, other = order(1), order(1), order(2)
    assert sorted(first) == list(range(5000)) and first != sorted(first)
    assert first == again and first != other


def test_keyed_order_does_not_depend_on_partitions(frame):
    def order(df):
        return [r.id for r in splits.shuffle(df, 1, "id").collect()]

    assert order(frame) == order(frame.repartition(3, "v"))


def test_shuffle_mode(frame):
    with pytest.raises(ValueError):
        splits.shuffle(frame, mode="other")


def test_scatter_splits_a_hot_partition(spark):
    """All rows under one key still spread over several tasks."""
    conf = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.range(0, 200000, 1, 8).select("id", F.lit("same").alias("key"))
        out = splits.shuffle(df, 1, "key", mode="scatter")
        per_task = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in per_task) == 200000
        assert out.rdd.getNumPartitions() > 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_plan_steps(frame):
    marked = splits.assign_split(frame, "id", 42)
    counts = {r.split: r["count"] for r in marked.groupBy("split").count().collect()}
    for r in splits.plan_steps(marked, 32, 3, 100).collect():
        batch = 100 if r.split == "test" else 32
        batches = math.ceil(counts[r.split] / batch)
        assert (r.n_rows, r.n_batches) == (counts[r.split], batches)
        assert r.total_steps == batches * 3
        assert r.warmup_steps == int(0.1 * batches * 3)


def test_export_shards(spark, frame, tmp_path):
    path = str(tmp_path / "shards")
    splits.export_shards(splits.assign_split(frame, "id", 42), path, 10, batches_per_file=5, key="id")
    back = read_parquet(spark, path)
    assert ids(back) == list(range(5000))
    files = back.filter("split = 'train'").groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in files) <= 50


def test_rows_without_a_key_are_drawn_apart(spark):
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 > 0 THEN id END AS key", "concat('t', id) AS text")
    marked = splits.assign_split(df, "key", 42)
    shares = {r.split: r["count"] / 1000 for r in marked.filter("key IS NULL").groupBy("split").count().collect()}
    assert 0.55 < shares["train"] < 0.73 and 0.1 < shares["val"] < 0.22 and 0.14 < shares["test"] < 0.26
    kept = splits.sample(df, 0.5, 7, "key").filter("key IS NULL").count()
    assert 400 < kept < 600
    assert marked.repartition(5).orderBy("text").collect() == splits.assign_split(df.repartition(3), "key", 42).orderBy("text").collect()
