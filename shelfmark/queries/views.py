"""Views that turn the test tables into records, labels and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import labels
from shelfmark.operators import splits
from shelfmark.sources import readers
from shelfmark.sources.readers import read_parquet

LANGUAGES = ("de", "en", "es", "fr")
RECORD = {
    "asin": "str",
    "brand": "str",
    "description": "list[str]",
    "feature": "list[str]",
    "image": "list[str]",
    "price": "str",
    "title": "str",
}


def cores(spark: SparkSession) -> int:
    """Partitions for the heavy queries: the test tables are a few row groups."""
    return spark.sparkContext.defaultParallelism


def documents(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    df = read_parquet(spark, f"{sf_dir}/documents.parquet")
    return readers.spread(df, cores(spark)) if spread else df


def products(spark: SparkSession, sf_dir: str, spread: bool = True) -> DataFrame:
    """Product records made of the documents, with nulls and empty values."""
    doc_id = F.col("doc_id")
    lines = F.split("text", "\n")
    empty = F.array().cast("array<string>")
    return documents(spark, sf_dir, spread).select(
        "doc_id",
        doc_id.cast("string").alias("asin"),
        lines[0].alias("title"),
        F.when(doc_id % 13 != 0, F.when(doc_id % 11 == 0, empty).otherwise(lines)).alias(
            "description"
        ),
        F.when(doc_id % 3 != 0, F.slice(lines, 2, 2)).alias("feature"),
        F.when(doc_id % 5 != 0, F.when(doc_id % 7 == 0, "").otherwise(F.col("source"))).alias(
            "brand"
        ),
        F.col("lang").alias("main_cat"),
        F.slice(lines, 1, 1).alias("image"),
        F.when(doc_id % 17 != 0, F.concat(F.lit("$"), F.col("n_chars").cast("string"))).alias(
            "price"
        ),
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product category for every document."""
    position = (F.col("doc_id") % len(labels.CATEGORIES)).cast("int")
    return documents(spark, sf_dir).select(
        "doc_id", F.get(F.array(*map(F.lit, labels.CATEGORIES)), position).alias("category")
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A language label, scores of the four classes and a split for every document.

    Every third prediction is right, the others are the best-scored class.
    """
    doc_id = F.col("doc_id")
    weights = [(doc_id * (3 + 2 * i) + 7 * i) % 11 + 1 for i in range(len(LANGUAGES))]
    total = sum(weights[1:], weights[0])
    df = documents(spark, sf_dir).select(
        "doc_id",
        labels.encode(F.col("lang"), LANGUAGES).alias("label"),
        F.array(*[(w / total) for w in weights]).alias("scores"),
    )
    df = df.withColumn(
        "prediction",
        F.when(doc_id % 3 == 0, F.col("label")).otherwise(labels.argmax(F.col("scores"))),
    )
    return splits.assign_split(df, "doc_id", seed=42)

# A small merge list, best first, and the tokens before its bytes.
MERGES = (
    (b"e", b"r"),
    (b"t", b"h"),
    (b"e", b"n"),
    (b" ", b"th"),
    (b"i", b"n"),
    (b" th", b"e"),
    (b"\xc3", b"\xa9"),
    (b"a", b"n"),
    (b" ", b"d"),
    (b"an", b"d"),
    (b" d", b"e"),
    (b"en", b"t"),
    (b"o", b"n"),
    (b"\n", b"\n"),
    (b"l", b"l"),
)
