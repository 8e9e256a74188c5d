"""Sampling, three-way splits, shuffling, step planning and training shards.

With a ``key`` every draw is a hash of the key: the same row gets the same draw under any
partitioning, on a retry after a lost executor, and in every later run. Without one the
draws are Spark's own, which repeat only for the same partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.hashing import key_text, unit_hash

SPLITS = ("train", "val", "test")
Key = str | Sequence[str] | None


def check_fraction(fraction: float) -> None:
    if not 0.0 <= fraction <= 1.0:
        raise ValueError(f"A fraction lies between 0 and 1, not at {fraction}.")


def sample(df: DataFrame, fraction: float, seed: int = 42, key: Key = None) -> DataFrame:
    """Bernoulli sample without replacement; fraction 1 keeps everything."""
    check_fraction(fraction)
    if fraction == 1.0:
        return df
    if key is None:
        return df.sample(fraction=float(fraction), seed=seed)
    return df.filter(unit_hash(df, key, str(seed)) < float(fraction))


def assign_split(
    df: DataFrame,
    key: str | Sequence[str],
    seed: int = 42,
    test_share: float = 0.2,
    val_share: float = 0.2,
    out: str = "split",
) -> DataFrame:
    """Add the split of each row: a test share, then a validation share of the rest."""
    in_test = unit_hash(df, key, f"{seed}:1") >= 1.0 - test_share
    in_val = unit_hash(df, key, f"{seed}:2") >= 1.0 - val_share
    split = F.when(in_test, "test").when(in_val, "val").otherwise("train")
    return df.withColumn(out, split)


def three_way(
    df: DataFrame,
    seed: int = 42,
    key: Key = None,
    test_share: float = 0.2,
    val_share: float = 0.2,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test frames; 64, 16 and 20 % in expectation."""
    if key is None:
        rest, test = df.randomSplit([1.0 - test_share, test_share], seed=seed)
        train, val = rest.randomSplit([1.0 - val_share, val_share], seed=seed)
        return train, val, test
    marked = assign_split(df, key, seed, test_share, val_share, out="_split")
    train, val, test = (marked.filter(F.col("_split") == s).drop("_split") for s in SPLITS)
    return train, val, test


def _draw(df: DataFrame, seed: int, key: Key) -> Column:
    if key is None:
        return F.rand(seed)
    return F.xxhash64(F.concat(F.lit(f"{seed}:"), key_text(df, key)))


def shuffle(df: DataFrame, seed: int = 42, key: Key = None, mode: str = "global") -> DataFrame:
    """Random order of rows; another seed gives another order.

    ``global`` is one total order. ``scatter`` puts rows into random partitions and orders
    each one, which needs no sampling pass over the input and is as random to a consumer
    that reads whole files. The key should be unique: rows that share one stay together,
    in as many tasks as their size asks for. Without a key the input should come straight
    from files, so that a retried task draws the same numbers.
    """
    draw = _draw(df, seed, key)
    if mode == "global":
        return df.orderBy(draw)
    if mode != "scatter":
        raise ValueError("mode must be 'global' or 'scatter'")
    return _scatter(df.withColumn("_draw", draw), ["_draw"]).drop("_draw")


def _scatter(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Partitions of even size by ``_draw``: small ones merge and large ones split."""
    return df.hint("rebalance", "_draw").sortWithinPartitions(*order)


def plan_steps(
    df: DataFrame,
    batch_size: int,
    epochs: int,
    test_batch_size: int | None = None,
    split: str = "split",
) -> DataFrame:
    """Rows, batches, steps and warm-up steps (a tenth) of every split, in one pass."""
    counts = df.groupBy(split).agg(F.count("*").alias("n_rows"))
    return steps_of_counts(counts, batch_size, epochs, test_batch_size, split)


def steps_of_counts(
    counts: DataFrame,
    batch_size: int,
    epochs: int,
    test_batch_size: int | None = None,
    split: str = "split",
) -> DataFrame:
    """:func:`plan_steps` from ``n_rows`` per split."""
    size = F.when(F.col(split) == "test", F.lit(test_batch_size or batch_size)).otherwise(
        F.lit(batch_size)
    )
    batches = counts.withColumn("n_batches", F.ceil(F.col("n_rows") / size))
    steps = batches.withColumn("total_steps", F.col("n_batches") * F.lit(epochs))
    return steps.withColumn("warmup_steps", F.floor(F.col("total_steps") * F.lit(0.1)))


def export_shards(
    df: DataFrame,
    path: str,
    batch_size: int,
    batches_per_file: int | None = 64,
    seed: int = 42,
    key: Key = None,
    split: str = "split",
) -> None:
    """Write shuffled training files, one folder per split, whole batches per file.

    Without ``batches_per_file`` files are as large as their partitions.

    Rows are scattered over the partitions as by :func:`shuffle`, so no split and no hot
    category ends up in one task; a reader of one split opens that folder only.
    """
    writer = (
        _scatter(df.withColumn("_draw", _draw(df, seed, key)), [split, "_draw"])
        .drop("_draw")
        .write.mode("overwrite")
        .partitionBy(split)
    )
    if batches_per_file:
        writer = writer.option("maxRecordsPerFile", batch_size * batches_per_file)
    writer.parquet(path)
