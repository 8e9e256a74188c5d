import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.functions import labels
from shelfmark.plans import epochs, jobs, model

CLASSES = ("a", "b", "c")


def texts(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        label = rng.choice(CLASSES)
        words = [rng.choice([label * 2, label * 3, "x", "y", "z", "common"]) for _ in range(rng.randint(0, 12))]
        out.append((f"{' '.join(words)}", label))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "combined_text string, main_cat string")


def spec(**more):
    return model.TextSpec(classes=CLASSES, label_column="main_cat", **more)


def dense(rows, num_features):
    """The same rows as a plain matrix."""
    out = np.zeros((len(rows), num_features + 1))
    for i, terms in enumerate(rows):
        for t in set(terms):
            out[i, t] = 1 + math.log(terms.count(t))
        norm = np.linalg.norm(out[i])
        if norm:
            out[i] /= norm
    out[:, -1] = 1
    return out


def plain(table, settings, n_classes):
    """Shard after shard, batch after batch, with dense arrays."""
    weights, out = np.zeros((settings.num_features + 1, n_classes)), []
    total = settings.num_epochs * settings.rounds
    for epoch in range(settings.num_epochs):
        for r in range(settings.rounds):
            rows = [x for x in table if x["round"] == r]
            change = np.zeros_like(weights)
            for shard in {x["shard"] for x in rows}:
                own = sorted((x for x in rows if x["shard"] == shard), key=lambda x: (x["draw"], x["place"]))
                x, y = dense([o["terms"] for o in own], settings.num_features), [o["label"] for o in own]
                w, n = weights.copy(), math.ceil(len(own) / settings.batch_size)
                for i in range(n):
                    part = slice(i * settings.batch_size, (i + 1) * settings.batch_size)
                    done = (epoch * settings.rounds + r + i / n) / total
                    rate = settings.learning_rate * (done / 0.1 if done < 0.1 else (1 - done) / 0.9)
                    z = np.exp(x[part] @ w)
                    p = z / z.sum(axis=1, keepdims=True) - np.eye(n_classes)[y[part]]
                    w -= rate * x[part].T @ p / len(p)
                change += (w - weights) * len(own)
            weights = weights + change / max(1, len(rows))
        out.append(weights)
    return out


SETTINGS = epochs.EpochSettings(
    num_epochs=3, batch_size=7, learning_rate=3.0, rounds=2, shard_rows=40, num_features=64
)


def drawn(df, settings):
    """The training rows as the training deals them, for the plain loop."""
    label = labels.encode(F.col("main_cat"), CLASSES)
    rows = epochs.prepared(df, spec(), label, settings)
    rows = rows.withColumn("round", F.pmod("draw", F.lit(settings.rounds)).cast("int"))
    rows = rows.withColumn("place", F.monotonically_increasing_id()).collect()
    sizes = {r: sum(x["round"] == r for x in rows) for r in range(settings.rounds)}
    table = df.sparkSession.createDataFrame([(x["draw"], x["place"], x["round"]) for x in rows], "draw long, place long, round int")
    counts = F.create_map(*[F.lit(v) for k, n in sizes.items() for v in (k, math.ceil(n / settings.shard_rows))])
    shard = F.pmod(F.xxhash64("draw", "place"), counts[F.col("round")])
    shards = {(x["draw"], x["place"]): x["s"] for x in table.withColumn("s", shard).collect()}
    return [{**x.asDict(), "shard": shards[x["draw"], x["place"]]} for x in rows]


def test_training_equals_a_plain_loop(spark):
    train, val = frame(spark, texts(200)).coalesce(2), frame(spark, texts(60, 2))
    classifier = model.train_epochs(train, val, spec(), SETTINGS)
    known = plain(drawn(train, SETTINGS), SETTINGS, 3)
    best = min(range(3), key=lambda i: classifier.validation[i][1])
    np.testing.assert_allclose(classifier.model.weights, known[best], atol=1e-9)
    assert [x["epoch"] for x, _ in classifier.validation] == [1, 2, 3]
    assert classifier.validation[-1][1] < math.log(3)
    scored = model.predict(classifier, val).collect()
    wanted = [[int(t) for t in row["terms"]] for row in val.select(epochs.feature_ids(spec(), 64).alias("terms")).collect()]
    z = np.exp(dense(wanted, 64) @ known[best])
    np.testing.assert_allclose([r.scores for r in scored], z / z.sum(axis=1, keepdims=True), atol=1e-9)
    assert all(r.predicted == CLASSES[r.prediction] for r in scored)
    loss = np.mean([-math.log(r.scores[CLASSES.index(r.main_cat)]) for r in scored])
    assert loss == pytest.approx(classifier.validation[best][1])


def test_broken_off_training_goes_on(spark, tmp_path):
    train, val = frame(spark, texts(80)).coalesce(1), frame(spark, texts(30, 2))
    whole = model.train_epochs(train, val, spec(), SETTINGS, f"{tmp_path}/a")
    # As if it had ended after its first epoch.
    import json

    from shelfmark.session import read_note, write_note

    stored = json.loads(read_note(spark, f"{tmp_path}/a/state"))
    stored["losses"] = stored["losses"][:1]
    write_note(spark, f"{tmp_path}/a/state", json.dumps(stored))
    again = model.train_epochs(train, val, spec(), SETTINGS, f"{tmp_path}/a")
    np.testing.assert_allclose(again.model.weights, whole.model.weights, atol=1e-12)
    assert [loss for _, loss in again.validation] == [loss for _, loss in whole.validation]
    # Finished: nothing is left to do, and other settings start anew.
    assert model.train_epochs(train, val, spec(), SETTINGS, f"{tmp_path}/a").validation == again.validation
    other = epochs.EpochSettings(**{**SETTINGS.__dict__, "num_epochs": 1})
    assert len(model.train_epochs(train, val, spec(), other, f"{tmp_path}/a").validation) == 1


def test_learning_rate_rises_and_falls():
    rates = [epochs.learning_rate(SETTINGS, p) for p in (0, 0.05, 0.1, 0.55, 1)]
    assert rates == pytest.approx([0, 1.5, 3, 1.5, 0])


def test_gradient_equals_differences():
    rng = np.random.default_rng(3)
    rows = epochs.Rows(pa.array([[1, 1, 2], [], [0, 3, 3, 3]], pa.list_(pa.int32())), 4)
    labels_, weights = np.array([0, 2, 1]), rng.normal(size=(5, 3))

    def loss(w):
        return -np.log(rows.probabilities(w)[np.arange(3), labels_]).mean()

    got = rows.gradient(weights, labels_, 0, 3, rows.column)
    for i, j in np.ndindex(5, 3):
        step = np.zeros((5, 3))
        step[i, j] = 1e-6
        assert got[i, j] == pytest.approx((loss(weights + step) - loss(weights - step)) / 2e-6, abs=1e-6)


def test_few_rows_and_bounds(spark):
    one = frame(spark, [("", "a")])
    none = frame(spark, [])
    assert model.train_epochs(one, none, spec(), SETTINGS).validation[0][1] is None
    empty = model.train_epochs(none, one, spec(), SETTINGS)
    assert empty.validation[0][1] == pytest.approx(math.log(3))
    with pytest.raises(ValueError, match="max_coefficients"):
        model.train_epochs(one, one, spec(), epochs.EpochSettings(max_coefficients=10))


def test_job_saves_and_scores(spark, tmp_path):
    frame(spark, texts(300)).write.parquet(f"{tmp_path}/in")
    settings = {
        "input_data_path": f"{tmp_path}/in", "classes": CLASSES, "trainer": "epochs", "num_epochs": 2,
        "batch_size": 8, "num_features": 256, "model_path": f"{tmp_path}/model", "text_columns": ["combined_text"],
    }
    result = jobs.run_train(spark, settings)
    loss = {r.split: r.avg_loss for r in result.metrics.collect()}
    assert loss["val"] == pytest.approx(min(x for _, x in result.classifier.validation))
    df = frame(spark, texts(20, 5))
    first, second = (jobs.score(c, df).collect() for c in (result.classifier, model.load(spark, f"{tmp_path}/model")))
    assert [r.scores for r in first] == [r.scores for r in second]
