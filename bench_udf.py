"""Yardstick: operators against row-at-a-time Python UDFs on the same session and data."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from shelfmark.operators import prep, tokens
from shelfmark.queries import views

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def row_encode(df, vocab, length):
    ids = {r.token: r.id for r in vocab.collect()}

    @F.udf("struct<input_ids:array<int>,attention_mask:array<int>>")
    def encode(text):
        real = [2, *(ids.get(w, 1) for w in text.lower().split()[: length - 2]), 3]
        pad = [0] * (length - len(real))
        return real + pad, [1] * len(real) + pad

    return df.select("main_cat", encode("combined_text").alias("e")).select("main_cat", "e.*")


def best_of(df, runs: int = 3) -> float:
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - start)
    return round(min(seconds), 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    df = views.products(spark, SF_DIR).cache()
    df.count()
    text = prep.preprocess(df).cache()
    vocab = tokens.build_vocab(text, "combined_text", 30_000).cache()
    vocab.count()
    pairs = {
        "encode": (tokens.encode(text, vocab), row_encode(text, vocab, 512)),
    }
    for name, (ours, rows) in pairs.items():
        print(json.dumps({"operator": name, "ours": best_of(ours), "row_udf": best_of(rows)}))
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
