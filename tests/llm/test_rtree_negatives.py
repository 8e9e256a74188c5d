import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import rtree_negatives as m
from shelfmark.llm.common import Workspace
from tests.llm.samples import frame

SCHEMA = "vec_id long, embedding array<float>, label int"


def nulls_last(value):
    return (value is None, value or 0)


def plain(rows, n_positives=5, n_negatives=10):
    taken = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        taken.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v], label))
    out = []
    anchors = {(i, tuple(v), label) for i, v, label in taken if i is not None and i % 100 == 0}
    for a, av, label in anchors:
        scored = [(-sum(x * y for x, y in zip(av, v)), nulls_last(i), i, c) for i, v, c in taken if i != a]
        scored.sort(key=lambda x: x[:2])
        for s, _, p, _ in [x for x in scored if x[3] == label][:n_positives]:
            low, high = 30 * -s, 90 * -s
            hard = [x for x in scored if x[3] != label and low <= 100 * -x[0] <= high]
            out += [(a, p, r, x[2], -s, -x[0]) for r, x in enumerate(hard[:n_negatives], 1)]
    return sorted(out, key=repr)


def mined(spark, rows, **options):
    df = frame(spark, rows, SCHEMA).withColumns({n: F.lit("x") for n in ("vector", "anchor", "block", "x")})
    vectors = m.vectors(df)
    found = m.mine(vectors, vectors.filter(F.col("vec_id") % 100 == 0), Workspace(spark), **options)
    names = "anchor_id positive_id rank negative_id positive_score negative_score".split()
    return sorted((tuple(r[n] for n in names) for r in found.collect()), key=repr)


def clustered(n, dims, seed, labels=4):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(labels, dims))
    label = rng.integers(0, labels, n)
    points = centers[label] + rng.normal(size=(n, dims)) * 0.8
    return [(i, [float(x) for x in p], int(c)) for i, (p, c) in enumerate(zip(points, label))]


def test_equals_brute_force(spark):
    rows = clustered(900, 8, 1)
    assert len(plain(rows)) > 100
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, rows, lot_components=16) == plain(rows)


def test_ties_copies_and_hot_labels(spark):
    rows = clustered(300, 3, 2)
    vector = [0.5, 0.25, -0.5]
    rows += [(1000 + i, vector, 1) for i in range(120)] + [(2000 + i, vector, 2) for i in range(120)]
    rows += [(300 + i, [0.5 * (i % 3), 0.0, 0.0], 1 + i % 2) for i in range(60)]
    random.Random(1).shuffle(rows)
    assert mined(spark, rows) == plain(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(60, 3, 3, 2)
    rows += [
        (100, [1.0, 1.0, 1.0], None),
        (200, None, 1),
        (300, [nan, 1.0, 1.0], 1),
        (400, [inf, 1.0, 1.0], 1),
        (500, [None, 1.0, 1.0], 1),
        (600, [], 1),
        (700, [1.0], 1),
        (800, [0.0, 0.0, 0.0], 0),
        (None, [1.0, 1.0, 1.0], 0),
        (None, [1.0, 1.0, 1.0], 1),
        (900, [1.0, 0.5, 1.0], 1),
        (900, [1.0, 0.5, 1.0], 1),
        (5, [2.0, 0.5, 1.0], 0),
        (5, [2.0, 0.5, 1.0], 0),
    ]
    assert mined(spark, rows) == plain(rows)


def test_empty_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, None, 1)]) == []
    assert mined(spark, [(101, [1.0], 1)]) == []
    assert mined(spark, [(100, [1.0], 1)]) == []


def test_large_components(spark):
    big = [(i, [1000.0 * (i % 7 + 1), 90_000.0], i % 2) for i in range(101)]
    assert mined(spark, big) == plain(big)
    with pytest.raises(Exception, match="too large"):
        mined(spark, [(0, [1e30], 1), (1, [1.0], 1)])


def tree(rows, leaf):
    labels = np.array([r[2] for r in rows])
    matrix = np.array([[int(np.floor(256 * x)) for x in r[1]] for r in rows])
    order = m.str_order(labels, matrix, leaf)
    sizes = [min(leaf, len(rows) - a) for a in range(0, len(rows), leaf)]
    return m.Tree([rows[i][0] for i in order], labels[order], matrix[order], sizes)


def test_boxes_bound_the_scores_of_their_rows():
    rows = clustered(500, 6, 4)
    packed = tree(rows, 16)
    anchor = packed.matrix[17]
    scores = packed.matrix @ anchor
    low, high = packed.bounds(0, slice(None), anchor)
    for leaf, (a, b) in enumerate(zip(packed.starts, packed.ends)):
        assert low[leaf] <= scores[a:b].min() and scores[a:b].max() <= high[leaf]


def test_packing_keeps_rows_and_separates_labels():
    rows = clustered(1000, 6, 5)
    packed = tree(rows, 16)
    assert sorted(packed.ids) == list(range(1000))
    _, _, least, most = packed.levels[0]
    assert (least != most).sum() <= 3
    assert len(packed.levels[-1][0]) == 1


def test_search_leaves_boxes_out():
    rows = clustered(4000, 2, 6)
    packed = tree(rows, 16)
    anchor, label = packed.matrix[5], int(packed.labels[5])
    scores = (packed.matrix @ anchor).astype(int)
    top = m.Best(-(2**62), 2**62, 5)
    read = packed.search(anchor, label, True, packed.ids[5], [top])
    same = sorted(((-s, i) for s, i, c in zip(scores, packed.ids, packed.labels) if c == label and i != packed.ids[5]))
    assert [(-s, i) for s, i in top.top] == same[:5]
    assert read < len(packed.starts) / 8
    middle = m.Best(100, 5000, 10)
    packed.search(anchor, label, False, None, [middle])
    other = sorted((-s, i) for s, i, c in zip(scores, packed.ids, packed.labels) if c != label and 100 <= s <= 5000)
    assert [(-s, i) for s, i in middle.top] == other[:10]
