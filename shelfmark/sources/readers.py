"""JSON-lines and Parquet readers, first-rows preview."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.operators.splits import Key, check_fraction, sample

CORRUPT_COLUMN = "_corrupt_record"


def jsonl_schema(schema: T.StructType | str, corrupt_column: str = CORRUPT_COLUMN) -> T.StructType:
    """The schema with a column for the text of lines that do not parse."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if corrupt_column in schema.names:
        return schema
    return T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])


def read_jsonl(
    spark: SparkSession,
    path: str | list[str],
    fraction: float = 1.0,
    seed: int = 42,
    schema: T.StructType | str | None = None,
    key: Key = None,
    partitions: int | None = None,
) -> DataFrame:
    """Read JSON-lines, gzipped or not, and sample.

    With ``schema`` the data are read once and lines that do not parse come with their
    text in ``_corrupt_record``; without it a first pass infers the types. A gzip file is one
    task however large: ``partitions`` deals the rows out to so many before heavy work. A probe
    for a first row belongs before that.
    """
    check_fraction(fraction)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(jsonl_schema(schema)).option(
            "columnNameOfCorruptRecord", CORRUPT_COLUMN
        )
    return dealt(sample(reader.json(path), fraction, seed, key), partitions)


def read_lines(spark: SparkSession, path: str | list[str], partitions: int | None = None) -> DataFrame:
    """Lines of text files, gzipped or not, as column ``value``, for checks of each line's own types."""
    return dealt(spark.read.text(path), partitions)


def read_parquet(
    spark: SparkSession, path: str | Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Read Parquet; filters and column choice made later reach the scan.

    ``partitions`` is for heavy work on a few files of few row groups, which would leave most
    cores idle.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return dealt(spark.read.parquet(*paths), partitions)


def dealt(df: DataFrame, partitions: int | None) -> DataFrame:
    """The rows dealt out to a number of partitions, if one is given."""
    return df.repartition(partitions) if partitions else df


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """The rows of a scan over that many partitions at least: dealt out, which shuffles whole rows, only
    where the scan itself leaves half of so many tasks without work. Counting needs no column's data."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    if sizes and max(sizes) * partitions <= 2 * sum(sizes):
        return df
    return dealt(df, partitions)


def take_rows(
    df: DataFrame,
    n: int,
    fields: Sequence[str] | None = None,
    order_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """The first ``n`` rows with the declared fields that exist.

    Without ``order_by`` these are any ``n`` rows, found without reading all input; with it
    each task keeps only its own best ``n``.
    """
    if n <= 0:
        raise ValueError(f"Asked for {n} rows; it takes one at least.")
    if order_by is not None:
        df = df.orderBy(*([order_by] if isinstance(order_by, str) else order_by))
    limited = df.limit(n)
    return limited.select(*[f for f in fields if f in df.columns]) if fields else limited
