"""Parquet and JSON-lines writers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write Parquet, replacing what is there; ``partitions`` sets the number of files."""
    (df.repartition(partitions) if partitions else df).write.mode("overwrite").parquet(path)


def write_jsonl(df: DataFrame, path: str, compression: str | None = "gzip") -> None:
    """Write JSON-lines files; null fields are left out."""
    writer = df.write.mode("overwrite")
    (writer.option("compression", compression) if compression else writer).json(path)
