"""Training by epochs: mini-batch steps with warm-up, validation after each epoch, the best one kept.

Training rows are drawn once into ``rounds`` and, within these, into shards of bounded size. An epoch
goes through its rounds one after the other and so reads every row once. In a round each shard takes
the weights as they are and makes its steps, batch after batch in the order of the draw; what the
shards have changed is averaged by their rows. A shard sends only rows of weights that its texts
touch, and their sums are combined before and after the shuffle; the driver holds the weights,
features times classes, which ``max_coefficients`` bounds.

The learning rate rises linearly over the first tenth of the training and then falls linearly to 0.

With a state path, weights are stored after every epoch; a training that was broken off goes on
behind the last epoch stored, if its settings are the same.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.text import words
from shelfmark.session import exists, read_note, remove, scratch_path, write_note
from shelfmark.sources.readers import read_parquet

#: Share of the training in which the learning rate rises.
WARM_UP = 0.1


@dataclass(frozen=True)
class EpochSettings:
    num_epochs: int = 2
    batch_size: int = 32
    learning_rate: float = 2.0
    rounds: int = 4
    #: Rows of a shard, which a task holds at once.
    shard_rows: int = 8_192
    num_features: int = 1 << 16
    seed: int = 42
    max_coefficients: int = 10_000_000


def learning_rate(settings: EpochSettings, progress: float) -> float:
    """The rate after a share of all steps."""
    if progress < WARM_UP:
        return settings.learning_rate * progress / WARM_UP
    return settings.learning_rate * (1 - progress) / (1 - WARM_UP)


def feature_ids(spec, num_features: int) -> Column:
    """A feature per term: words by their hash, tokens (without frame and padding) by their id."""
    if spec.encoded:
        real = F.size(F.filter("attention_mask", lambda m: m == 1))
        terms = F.slice("input_ids", F.lit(2), F.greatest(real - 2, F.lit(0)))
        return F.transform(terms, lambda t: F.pmod(t, F.lit(num_features)).cast("int"))
    terms = words(F.lower(F.coalesce(F.col(spec.text), F.lit(""))))
    return F.transform(terms, lambda t: F.pmod(F.xxhash64(t), F.lit(num_features)).cast("int"))


class Rows:
    """Texts as sparse rows: 1 + ln of a feature's number, rows of length 1, and a constant."""

    def __init__(self, lists: pa.Array, num_features: int):
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(sizes)), sizes)
        ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        pairs, n = np.unique(row * (num_features + 1) + ids, return_counts=True)
        row, column = np.divmod(pairs, num_features + 1)
        value = 1 + np.log(n)
        norm = np.sqrt(np.bincount(row, value**2, len(sizes)))
        value = value / norm[row] if len(row) else value
        self.n = len(sizes)
        at = np.arange(self.n)
        order = np.argsort(np.concatenate((row, at)), kind="stable")
        self.row = np.concatenate((row, at))[order]
        self.column = np.concatenate((column, np.full(self.n, num_features)))[order]
        self.value = np.concatenate((value, np.ones(self.n)))[order]
        self.starts = np.searchsorted(self.row, at)

    def probabilities(self, weights: np.ndarray, a: int = 0, b: int | None = None, column=None) -> np.ndarray:
        """Class shares of the rows from a to b."""
        b = self.n if b is None else b
        if a == b:
            return np.zeros((0, weights.shape[1]))
        part = self.part(a, b)
        column = self.column if column is None else column
        parts = self.value[part, None] * weights[column[part]]
        logits = np.add.reduceat(parts, self.starts[a:b] - part.start, axis=0)
        logits = np.exp(logits - logits.max(axis=1, keepdims=True))
        return logits / logits.sum(axis=1, keepdims=True)

    def part(self, a: int, b: int) -> slice:
        return slice(self.starts[a], self.starts[b] if b < self.n else len(self.row))

    def gradient(self, weights: np.ndarray, labels: np.ndarray, a: int, b: int, column: np.ndarray) -> np.ndarray:
        """Of the mean loss of the rows from a to b."""
        error = self.probabilities(weights, a, b, column)
        error[np.arange(b - a), labels[a:b]] -= 1
        part, out = self.part(a, b), np.zeros_like(weights)
        np.add.at(out, column[part], self.value[part, None] * error[self.row[part] - a])
        return out / (b - a)


def steps(rows: Rows, labels: np.ndarray, weights: np.ndarray, settings: EpochSettings, begun: float, share: float):
    """The features that a shard touches and their weights after its steps.

    ``begun`` is the part of the training that lies behind, ``share`` what the round is of it.
    """
    touched, column = np.unique(rows.column, return_inverse=True)
    own = weights[touched].copy()
    n = math.ceil(rows.n / settings.batch_size)
    for i in range(n):
        a = i * settings.batch_size
        rate = learning_rate(settings, begun + share * i / n)
        own -= rate * rows.gradient(own, labels, a, min(a + settings.batch_size, rows.n), column)
    return touched, own


class HashedLinear:
    """A multinomial linear model over hashed terms."""

    def __init__(self, weights: np.ndarray, encoded: bool):
        self.weights, self.encoded = weights, encoded

    def transform(self, df: DataFrame, spec) -> DataFrame:
        """Add ``scores`` and ``prediction``, the class of the best one (the first of equal ones)."""
        num_features = len(self.weights) - 1
        shared = df.sparkSession.sparkContext.broadcast(self.weights)

        @F.arrow_udf("array<double>")
        def score(terms: pa.Array) -> pa.Array:
            found = Rows(terms, num_features).probabilities(shared.value)
            offsets = np.arange(len(found) + 1) * shared.value.shape[1]
            return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(found.ravel()))

        scored = df.withColumn("scores", score(feature_ids(spec, num_features)))
        best = F.array_position("scores", F.array_max("scores")) - 1
        return scored.withColumn("prediction", best.cast("double"))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = pa.table(
            {
                "feature": pa.array(np.arange(len(self.weights))),
                "weights": pa.array(list(self.weights), pa.list_(pa.float64())),
            }
        )
        held = spark.createDataFrame(rows).withColumn("encoded", F.lit(self.encoded))
        held.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> HashedLinear:
        table = read_parquet(spark, path).orderBy("feature").toArrow()
        weights = np.array(table["weights"].combine_chunks().flatten()).reshape(table.num_rows, -1)
        return cls(weights, table["encoded"][0].as_py())


def prepared(df: DataFrame, spec, label: Column, settings: EpochSettings) -> DataFrame:
    """``draw, label, terms``: the draw is a hash of the row's content and seed."""
    content = "input_ids" if spec.encoded else spec.text
    draw = F.xxhash64(F.lit(settings.seed), F.col(content), F.col(spec.label_column))
    return df.select(draw.alias("draw"), label.cast("int").alias("label"), feature_ids(spec, settings.num_features).alias("terms"))


def train(
    train_df: DataFrame, val_df: DataFrame, spec, label: Column, n_classes: int, settings: EpochSettings,
    state_path: str | None = None,
) -> tuple[HashedLinear, list[dict]]:
    """The weights of the epoch with the strictly lowest validation loss, and ``epoch, train_rows,
    val_loss, val_accuracy`` of each.

    ``label`` is the class number. Equal rows, which share a draw, are dealt by position in it.
    """
    if (settings.num_features + 1) * n_classes > settings.max_coefficients:
        raise ValueError("features times classes are more than max_coefficients.")
    spark = train_df.sparkSession
    paths = [scratch_path(spark, n) for n in ("train-rows", "val-rows")]
    try:
        rows = prepared(train_df, spec, label, settings).withColumn("round", F.pmod("draw", F.lit(settings.rounds)).cast("int"))
        # Copies of one row share a draw: their order within it spreads them.
        rows = rows.withColumn("place", F.monotonically_increasing_id())
        rows.write.partitionBy("round").parquet(paths[0])
        val = prepared(val_df, spec, label, settings)
        val.write.parquet(paths[1])
        rows, val = (spark.read.schema(df.schema).parquet(p) for df, p in zip((rows, val), paths))
        sizes = dict(rows.groupBy("round").count().collect())
        model, losses, best = HashedLinear(np.zeros((settings.num_features + 1, n_classes)), spec.encoded), [], None
        asked = {"settings": asdict(settings), "rows": {str(k): v for k, v in sorted(sizes.items())}}
        if state_path and exists(spark, f"{state_path}/state"):
            stored = json.loads(read_note(spark, f"{state_path}/state"))
            if stored["asked"] == asked:
                losses = stored["losses"]
                model = HashedLinear.load(spark, f"{state_path}/epoch-{len(losses)}")
                best = HashedLinear.load(spark, f"{state_path}/epoch-{_best(losses)}")
        for epoch in range(len(losses), settings.num_epochs):
            for r in range(settings.rounds):
                if sizes.get(r):
                    part = rows.filter(F.col("round") == r)
                    model = _round(part, sizes[r], model, settings, epoch * settings.rounds + r)
            n, loss, right = _validated(val, model)
            losses.append(
                {
                    "epoch": epoch + 1,
                    "train_rows": sum(sizes.values()),
                    "val_loss": loss / n if n else None,
                    "val_accuracy": right / n if n else None,
                }
            )
            if best is None or _best(losses) == epoch + 1:
                best = model
            if state_path:
                model.save(spark, f"{state_path}/epoch-{epoch + 1}")
                write_note(spark, f"{state_path}/state", json.dumps({"asked": asked, "losses": losses}))
        return best or model, losses
    finally:
        remove(spark, paths)


def _best(losses: list[dict]) -> int:
    """The first epoch of the lowest loss; without validation rows the first."""
    return min(losses, key=lambda x: (math.inf if x["val_loss"] is None else x["val_loss"], x["epoch"]))["epoch"]


def _round(rows: DataFrame, n_rows: int, model: HashedLinear, settings: EpochSettings, number: int) -> HashedLinear:
    """The model after a round of all shards."""
    spark, (n_weights, n_classes) = rows.sparkSession, model.weights.shape
    share = 1 / (settings.num_epochs * settings.rounds)
    shards = math.ceil(n_rows / settings.shard_rows)
    shared = spark.sparkContext.broadcast(model.weights)

    def run(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by([("draw", "ascending"), ("place", "ascending")])
        texts = Rows(shard["terms"].combine_chunks(), settings.num_features)
        before = shared.value
        touched, own = steps(texts, shard["label"].to_numpy(), before, settings, number * share, share)
        change = (own - before[touched]) * texts.n
        columns = {f"c{i}": pa.array(change[:, i]) for i in range(n_classes)}
        return pa.table({"feature": pa.array(touched), **columns})

    schema = ", ".join(["feature long", *(f"c{i} double" for i in range(n_classes))])
    shard = F.pmod(F.xxhash64("draw", "place"), F.lit(shards))
    changes = rows.groupBy(shard.alias("shard")).applyInArrow(run, schema)
    summed = changes.groupBy("feature").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(n_classes)]).toArrow()
    weights = model.weights.copy()
    at = summed["feature"].to_numpy()
    for i in range(n_classes):
        weights[at, i] += summed[f"c{i}"].to_numpy() / n_rows
    shared.destroy()
    return HashedLinear(weights, model.encoded)


def _validated(val: DataFrame, model: HashedLinear) -> tuple[int, float, int]:
    """Rows, summed loss and right predictions."""
    shared = val.sparkSession.sparkContext.broadcast(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch["label"].to_numpy()
            scores = Rows(batch["terms"], len(shared.value) - 1).probabilities(shared.value)
            loss = -np.log(np.maximum(scores[np.arange(len(labels)), labels], 1e-15)).sum()
            right = int((scores.argmax(axis=1) == labels).sum())
            yield pa.record_batch([pa.array([len(labels)]), pa.array([loss]), pa.array([right])], ["n", "loss", "right"])

    parts = val.select("label", "terms").mapInArrow(run, "n long, loss double, right long")
    row = parts.agg(F.sum("n"), F.sum("loss"), F.sum("right")).first()
    shared.destroy()
    return row[0] or 0, row[1] or 0.0, row[2] or 0
