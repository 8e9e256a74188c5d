import random

import pytest

from shelfmark.llm import tiling as t
from tests.llm.samples import ODD, frame, sentences, with_clashes

ITEM = "the quick brown fox jumps over the lazy dog while seven wizards quietly boxed up my old jugs near the river"


def items(spark, rows=((7, ITEM), (8, sentences(40, 9)), (9, "too short"), (10, None), (None, ""))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def pairs(spark, rows, **options):
    found = t.contaminated(with_clashes(frame(spark, rows)), items(spark), **options)
    return sorted((r.doc_id, r.item_id) for r in found.collect())


def brute_tiles(doc, item, min_tile):
    """Greedy tiling by looking at all pairs of places anew for each tile."""
    doc, item, tiles = list(doc), list(item), []
    while True:
        best = (min_tile - 1, 0, 0)
        for a in range(len(doc)):
            for b in range(len(item)):
                n = 0
                while a + n < len(doc) and b + n < len(item) and doc[a + n] is not None and doc[a + n] == item[b + n]:
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        n, a, b = best
        if n < min_tile:
            return tiles
        doc[a : a + n], item[b : b + n] = [None] * n, [None] * n
        tiles.append(best)


@pytest.mark.parametrize("seed", range(30))
def test_tiles_equal_brute_force(seed):
    rng = random.Random(seed)
    words = [chr(97 + k) for k in range(rng.randint(2, 6))]
    doc = [rng.choice(words) for _ in range(rng.randint(0, 40))]
    item = [rng.choice(words) for _ in range(rng.randint(0, 20))]
    doc = [None if rng.random() < 0.1 else w for w in doc]
    assert t.greedy_tiles(doc, item, 3) == brute_tiles(doc, item, 3)
    assert t.greedy_tiles(doc, item, 1) == brute_tiles(doc, item, 1)


def test_repeated_words_end():
    import time

    start = time.perf_counter()
    assert t.greedy_tiles(["a"] * 5000, ["a"] * 500) == [(500, 0, 0)]
    assert t.greedy_tiles(["a", "b"] * 2500, ["b", "a"] * 250) == [(500, 1, 0)]
    assert time.perf_counter() - start < 10


def brute_pairs(rows, benchmark, min_tile=3, share=0.8):
    import math
    import re

    def words(text):
        return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())

    out = set()
    for doc, text in rows:
        for item, passage in benchmark:
            wanted = words(passage)
            if wanted:
                tiles = brute_tiles(words(text), wanted, min(min_tile, len(wanted)))
                covered = sum(n for n, _, _ in tiles)
                if covered >= math.ceil(len(wanted) * share):
                    out.add((doc, item, len(wanted), covered, len(tiles)))
    return out


def test_pairs_equal_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [chr(97 + k) * 2 for k in range(9)]
    benchmark = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 14)))) for i in range(40)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(60)]
    for i in range(40):
        pieces = [p.split() for _, p in benchmark if p]
        words = rng.choice(pieces)
        parts = [words[a : a + 4] for a in range(0, len(words), 4)]
        rng.shuffle(parts)
        rows.append((100 + i, " x ".join(" ".join(p) for p in parts)))
    names = ("doc_id", "item_id", "n_item_words", "n_covered", "n_tiles")
    for options in ({}, {"max_broadcast_words": 1}):
        found = t.contaminated(frame(spark, rows), items(spark, benchmark), **options).collect()
        assert {tuple(r[n] for n in names) for r in found} == brute_pairs(rows, benchmark)


def test_short_items_and_reordered_pieces(spark):
    short = [(1, "forty two"), (2, "fish"), (3, "a b c d"), (4, "the answer")]
    pieces = " ".join(f"w{i}" for i in range(20))
    rows = [
        (1, "the answer is Forty-two"),
        (2, "fishy"),
        (3, "so long, fish!"),
        (4, "; ".join(" ".join(f"w{i}" for i in range(a, a + 4)) for a in (12, 0, 16, 8, 4))),
    ]
    found = t.contaminated(frame(spark, rows), items(spark, [*short, (5, pieces)])).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 1), (1, 4), (3, 2), (4, 5)]


def test_a_word_repeated_throughout(spark):
    rows = [(1, "a " * 20_000), (2, "a b " * 9_000)]
    found = t.contaminated(frame(spark, rows), items(spark, [(1, "a " * 240), (2, "b a " * 100)])).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 1), (2, 2)]


def test_whole_and_edited_passages(spark):
    words = ITEM.split()
    rows = ODD + [
        (20, sentences(50) + " " + ITEM.upper().replace(" ", ", ") + " " + sentences(50, 4)),
        (21, " ".join(words[11:] + ["and", "then"] + words[:11])),
        (22, " ".join(words[:8])),
        (23, " ".join(sorted(words))),
        (24, " ".join(words[:10] + ["red"] + words[11:])),
        (25, sentences(500, 5)),
    ]
    assert pairs(spark, rows) == [(20, 7), (21, 7), (24, 7)]


def test_reordered_sentences(spark):
    words = ITEM.split()
    parts = [words[0:3], words[3:9], words[9:13], words[13:]]
    random.Random(1).shuffle(parts)
    text = " . ".join(" ".join(p) for p in parts)
    assert pairs(spark, [(1, "intro " + text + " outro")]) == [(1, 7)]


def test_large_benchmarks_take_the_shuffle_join(spark):
    rows = [(1, "so " + ITEM), (2, sentences(60)), (3, None)]
    assert pairs(spark, rows, max_broadcast_words=1) == pairs(spark, rows) == [(1, 7)]


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, ITEM), (1, ITEM), (None, ITEM + " x")]
    found = t.contaminated(frame(spark, rows), items(spark)).collect()
    assert sorted(((r.doc_id, r.item_id) for r in found), key=repr) == [(1, 7), (None, 7)]


def test_empty_tables(spark):
    assert pairs(spark, []) == []
    none = items(spark, [])
    assert t.contaminated(frame(spark, [(1, ITEM)]), none).count() == 0


