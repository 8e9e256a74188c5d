import math
import random
from collections import Counter

import pytest

from shelfmark.operators import evaluate


def brute(pairs):
    """Metrics by definition, class by class."""
    n = len(pairs)
    out = {"accuracy": sum(a == p for a, p in pairs) / n, "precision": 0.0, "recall": 0.0, "f1_score": 0.0}
    for c in {x for pair in pairs for x in pair}:
        hits = sum(a == c and p == c for a, p in pairs)
        support, predicted = sum(a == c for a, _ in pairs), sum(p == c for _, p in pairs)
        precision = hits / predicted if predicted else 0.0
        recall = hits / support if support else 0.0
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
        for name, value in (("precision", precision), ("recall", recall), ("f1_score", f1)):
            out[name] += value * support / n
    return out


@pytest.fixture(scope="module")
def rows():
    """Class 4 is never predicted, class 5 never true."""
    draw = random.Random(3)
    rows = []
    for _ in range(900):
        label = draw.choices([0, 1, 2, 4], [60, 20, 15, 5])[0]
        prediction = label if label != 4 and draw.random() < 0.7 else draw.choice([0, 1, 2, 5])
        scores = [draw.random() for _ in range(6)]
        scores = [s / sum(scores) for s in scores]
        if draw.random() < 0.02:
            scores[label] = 0.0
        rows.append((draw.choice(["train", "val", "test"]), label, prediction, scores))
    return rows


@pytest.fixture(scope="module")
def frame(spark, rows):
    schema = "split string, label int, prediction int, scores array<double>"
    return spark.createDataFrame(rows, schema).repartition(4)


def test_metrics(frame, rows):
    got = evaluate.metrics(frame).first().asDict()
    assert got.pop("n_rows") == len(rows)
    assert got == pytest.approx(brute([(r[1], r[2]) for r in rows]))


def test_by_split(frame, rows):
    for r in evaluate.by_split(frame).collect():
        own = [x for x in rows if x[0] == r.split]
        loss = sum(-math.log(max(x[3][x[1]], 1e-15)) for x in own) / len(own)
        expected = {**brute([(x[1], x[2]) for x in own]), "avg_loss": loss}
        assert {k: r[k] for k in expected} == pytest.approx(expected)
        assert r.n_rows == len(own)


def test_by_split_reads_the_rows_once(frame):
    plan = evaluate.by_split(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ExistingRDD") == 1


def test_log_loss(frame, rows):
    total = sum(-math.log(max(x[3][x[1]], 1e-15)) for x in rows) / len(rows)
    assert evaluate.log_loss(frame).first().avg_loss == pytest.approx(total)


def test_confusion(frame, rows):
    expected = Counter((r[1], r[2]) for r in rows)
    supports = Counter(r[1] for r in rows)
    got = evaluate.confusion(frame, normalize=True).collect()
    assert {(r.label, r.prediction): r.n for r in got} == expected
    assert all(r.share == pytest.approx(r.n / supports[r.label]) for r in got)


def test_confusion_wide_has_all_classes(frame, rows):
    expected = Counter((r[1], r[2]) for r in rows)
    got = {r.label: r for r in evaluate.confusion_wide(frame, 6).collect()}
    assert sorted(got) == list(range(6))
    assert all(got[a][f"p{p}"] == expected[a, p] for a in range(6) for p in range(6))
    shares = {r.label: r for r in evaluate.confusion_wide(frame, 6, percent=True).collect()}
    assert sum(shares[0][f"p{p}"] for p in range(6)) == pytest.approx(100)
    assert sum(shares[5][f"p{p}"] for p in range(6)) == 0


def test_ids_outside_the_classes_fail_the_matrix(spark):
    for label, prediction in ((None, 0), (0, None), (2, 0), (0, 2), (-1, 0)):
        df = spark.createDataFrame([(0, 0), (label, prediction)], "label int, prediction int")
        with pytest.raises(Exception, match="none of 2 classes"):
            evaluate.confusion_wide(df, 2).collect()


def test_labels_without_a_score_fail_the_loss(spark):
    for label in (None, 2, -1):
        df = spark.createDataFrame([(0, 0, [0.5, 0.5]), (label, 0, [0.5, 0.5])], "label int, prediction int, scores array<double>")
        with pytest.raises(Exception, match="No score for label"):
            evaluate.log_loss(df).collect()
        with pytest.raises(Exception, match="No score for label"):
            evaluate.by_split(df.selectExpr("*", "'test' AS split")).collect()
