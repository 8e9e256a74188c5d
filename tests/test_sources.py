import gzip
import json

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import prep
from shelfmark.session import scratch_path, shared_dir
from shelfmark.sources import readers, writers

DDL = "asin string, title string, feature array<string>"


@pytest.fixture
def jsonl(tmp_path):
    path = tmp_path / "records.jsonl.gz"
    good = [{"asin": str(i), "title": f"t{i}", "feature": ["a", "b"][: i % 3]} for i in range(300)]
    with gzip.open(path, "wt", encoding="utf-8") as out:
        for row in good[:150]:
            out.write(json.dumps(row) + "\n")
        out.write('{"asin": "broken", \n')
        for row in good[150:]:
            out.write(json.dumps(row) + "\n")
    return str(path)


def test_read_with_schema(spark, jsonl):
    df = readers.read_jsonl(spark, jsonl, schema=DDL)
    assert df.columns == ["asin", "title", "feature", readers.CORRUPT_COLUMN]
    assert df.count() == 301
    # One gzip file is one task; the rows are dealt out when the caller says so.
    assert df.rdd.getNumPartitions() == 1
    assert readers.read_jsonl(spark, jsonl, schema=DDL, partitions=5).rdd.getNumPartitions() == 5
    valid, rejected = prep.conform(
        df, {"asin": "str", "title": "str", "feature": "list"}, readers.CORRUPT_COLUMN
    )
    assert valid.count() == 300
    assert [r.reject_reason for r in rejected.collect()] == [
        "malformed line; asin: null; title: null; feature: null"
    ]


def test_read_with_inference(spark, jsonl):
    df = readers.read_jsonl(spark, jsonl)
    assert dict(df.dtypes)["feature"] == "array<string>"
    assert df.filter(F.col("asin").isNotNull()).count() == 300


def test_fraction_is_checked_before_reading(spark):
    with pytest.raises(ValueError, match="fraction lies between"):
        readers.read_jsonl(spark, "/nowhere/at/all.jsonl.gz", fraction=1.5)


def test_sampled_reading(spark, jsonl):
    some = readers.read_jsonl(spark, jsonl, 0.4, 7, DDL, key="asin")
    again = readers.read_jsonl(spark, jsonl, 0.4, 7, DDL, key="asin", partitions=3)
    assert {r.asin for r in some.collect()} == {r.asin for r in again.collect()}
    assert 60 < some.count() < 180
    assert readers.read_jsonl(spark, jsonl, 0.0, 7, DDL).isEmpty()


def test_empty_sample_fails_validation(spark, jsonl):
    with pytest.raises(ValueError, match="empty"):
        prep.validate_input(readers.read_jsonl(spark, jsonl, 0.0), ["asin"], "title")


def test_parquet_roundtrip_overwrites(spark, records, tmp_path):
    path = str(tmp_path / "out")
    writers.write_parquet(records, path)
    writers.write_parquet(records, path, partitions=1)
    assert sorted(readers.read_parquet(spark, path).collect()) == sorted(records.collect())
    assert len(readers.read_parquet(spark, path).inputFiles()) == 1


def test_take_rows(records):
    assert readers.take_rows(records, 2).count() == 2
    rows = readers.take_rows(records, 2, ["asin", "nothing"], order_by="asin").collect()
    assert [r.asin for r in rows] == ["123B", "123C"]
    assert rows[0].__fields__ == ["asin"]
    for bad in (0, -1):
        with pytest.raises(ValueError, match="takes one at least"):
            readers.take_rows(records, bad)


def test_ordered_take_keeps_n_per_task(records):
    plan = readers.take_rows(records, 2, order_by="asin")._jdf.queryExecution().executedPlan()
    assert "TakeOrderedAndProject" in plan.toString()


def test_filters_and_columns_reach_the_scan(spark):
    df = readers.read_parquet(spark, "/root/testdata/sf0.001/documents.parquet")
    plan = df.filter(F.col("lang") == "de").select("doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(lang,de)" in plan and "text" not in plan.split("ReadSchema")[1]


def test_scratch_paths_are_fresh(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(shared_dir(spark))


def test_rows_are_dealt_out_only_where_the_files_are_uneven(spark, tmp_path):
    even, single = str(tmp_path / "even"), str(tmp_path / "single")
    spark.range(4_000, numPartitions=8).write.parquet(even)
    spark.range(4_000, numPartitions=1).write.parquet(single)
    for path, dealt in ((even, False), (single, True)):
        spark.conf.set("spark.sql.files.openCostInBytes", "16m")
        try:
            df = readers.spread(spark.read.parquet(path), 4)
        finally:
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert df.count() == 4_000
        assert ("Repartition" in df._jdf.queryExecution().optimizedPlan().toString()) == dealt
    assert readers.spread(spark.range(0), 4).count() == 0
