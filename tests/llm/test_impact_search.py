import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import impact_search as m
from shelfmark.llm.common import Workspace
from tests.llm.samples import ODD, frame, sentences, with_clashes


def plain_terms(text):
    kept = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in text or "")
    return "".join(c if ord(c) > 127 or c in "0123456789abcdefghijklmnopqrstuvwxyz" else " " for c in kept).split(" ")


def plain_search(docs, items, k):
    counted = [(i, Counter(t for t in plain_terms(text) if t)) for i, text in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in counted:
            score = 0
            for t in set(plain_terms(text)) & set(c):
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                size = 100 - 90 + (90 * sum(c.values()) * n) // total
                score += weight * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * size))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def searched(spark, docs, items, k, block_docs=8_192, **options):
    index = m.build_index(with_clashes(frame(spark, docs)), Workspace(spark), block_docs)
    asked = frame(spark, items, "item_id long, text string")
    found = m.search(index, asked, Workspace(spark), k, **options).collect()
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found), key=repr)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(40)] + ["Süß", "的字", "a-b"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 30)))) for i in range(300)]
    copies = [(1000 + i, rows[0][1]) for i in range(150)]
    return rows + copies + ODD + [(5000, sentences(6000)), (None, "w1 w2 w3")]


ITEMS = [
    (1, "w1 w2 w3 w30 w31"),
    (2, "w39 W38 süß"),
    (3, "Süß 的字 a b"),
    (4, None),
    (5, "!!! --"),
    (6, "absent words only"),
    (1, "w5 w5 w5"),
    (None, "text rows lorem1 w0"),
    (8, " ".join(f"w{i}" for i in range(40))),
]


@pytest.mark.parametrize("block_docs, options", [(8_192, {}), (7, {}), (64, {"lot_terms": 10})])
def test_ranking_equals_brute_force(spark, docs, block_docs, options):
    assert searched(spark, docs, ITEMS, 10, block_docs, **options) == plain_search(docs, ITEMS, 10)


def test_fewer_documents_than_wanted(spark):
    rows = [(3, "a b"), (1, "a b"), (2, "a"), (9, "other")]
    assert searched(spark, rows, [(7, "b a")], 10, 1) == plain_search(rows, [(7, "b a")], 10)


def test_empty_tables(spark):
    assert searched(spark, [], ITEMS, 10) == []
    assert searched(spark, ODD, [], 10) == []


def test_text_ids(spark):
    rows = frame(spark, [("b", "x y"), ("a", "x y"), (None, "x y"), ("c", "z")], "doc_id string, text string")
    index = m.build_index(rows, Workspace(spark), 2)
    items = frame(spark, [(1, "x")], "item_id long, text string")
    assert [r.doc_id for r in m.search(index, items, Workspace(spark)).orderBy("rank").collect()] == ["a", "b", None]


def test_lists_are_in_the_order_of_impact(spark, docs):
    index = m.build_index(frame(spark, docs), Workspace(spark), 50)
    unsorted = F.expr("exists(sequence(2, size(impacts)), i -> impacts[i - 2] < impacts[i - 1])")
    long = index.lists.filter(F.size("impacts") > 1)
    assert long.count() > 0 and long.filter(unsorted).count() == 0


def test_search_stops_before_the_lists_end():
    rng = np.random.default_rng(2)
    n = 5_000
    impacts = [np.sort(rng.pareto(1, n) * 1000).astype(np.int64)[::-1] for _ in range(3)]
    docs = [rng.permutation(n) for _ in range(3)]
    block = m._Lists(["a", "b", "c"], [n] * 3, docs, impacts, list(range(n)))
    found, scores, met = block.best(np.arange(3), np.array([3, 2, 1]), 10, [])
    total = np.zeros(n, np.int64)
    for d, i, w in zip(docs, impacts, (3, 2, 1)):
        total[d] += i * w
    assert sorted(scores)[-10:] == sorted(total)[-10:]
    assert (total[found] == scores).all()
    assert met < n / 2
    # Nothing here beats what is known: one round.
    assert block.best(np.arange(3), np.array([3, 2, 1]), 10, [10**9] * 10)[2] <= 3 * m.FIRST_STEP


def test_equal_bounds_go_on():
    """All scores tie: the smallest numbers win, so no document may be left out."""
    n = 100
    docs, impacts = np.arange(n)[::-1].copy(), np.full(n, 5)
    block = m._Lists(["a"], [n], [docs], [impacts], list(range(n)))
    found, _, met = block.best(np.array([0]), np.array([1]), 10, [])
    assert met == n and set(range(10)) <= set(found.tolist())
