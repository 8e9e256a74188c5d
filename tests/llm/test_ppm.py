import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfmark.llm import ppm
from tests.llm.samples import ODD, frame, sentences, with_clashes


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def plain_probability(contexts, symbol):
    """Counts after the longest context first; escape and exclusion symbol by symbol."""
    excluded, p = set(), 1.0
    for counts in contexts:
        left = {s: n for s, n in counts.items() if s not in excluded}
        total = sum(left.values())
        if not total:
            continue
        excluded |= set(left)
        escapes = len(left) if len(excluded) < 256 else 0
        if symbol in left:
            return p * left[symbol] / (total + escapes)
        p *= escapes / (total + escapes)
    return p / (256 - len(excluded))


def brute_force(rows):
    words, trie = Counter(), defaultdict(Counter)
    for i, text in rows:
        if not held_out(i):
            words.update([*(text or "").encode().lower().split(), b""])
            data = b"\n\n\n" + (text or "").encode() + b"\xff"
            for at in range(3, len(data)):
                for k in range(4):
                    trie[data[at - k : at]][data[at]] += 1
    n, v, out = sum(words.values()), len(words), []
    for i, text in rows:
        tokens = [*(text or "").encode().lower().split(), b""]
        data = b"\n\n\n" + (text or "").encode() + b"\xff"
        score = sum(
            math.log10(plain_probability([trie[data[at - k : at]] for k in range(3, -1, -1)], data[at]))
            for at in range(3, len(data))
        )
        base = sum(math.log10((words[t] + 1) / (n + v + 1)) for t in tokens)
        out.append((i, held_out(i), len(tokens), sum(words[t] > 0 for t in tokens), n, base, score))
    return out


@pytest.mark.parametrize("keys", [1 << 22, 20])
def test_scores_equal_brute_force(spark, keys):
    rows = ODD + [(i, sentences(30, i % 11) + " Upper É") for i in range(20, 50)] + [(60, "zzz qqq")]
    got = ppm.score(with_clashes(frame(spark, rows)), keys).collect()
    for a, b in zip(sorted(map(tuple, got), key=repr), sorted(brute_force(rows), key=repr), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], abs=1e-6)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    for _ in range(50):
        counts = [np.where(rng.random(256) < share, rng.integers(1, 9, 256), 0) for share in (0.01, 0.1, 0.5, 1)]
        for k in range(5):
            assert ppm.symbol_probabilities(counts[:k]).sum() == pytest.approx(1)


def test_gram_keys():
    keys, at = ppm.gram_keys(np.frombuffer(b"abc", np.uint8), np.array([0, 2, 2, 3]))
    raw = [int(k).to_bytes(4, "big") for k in keys]
    assert raw == [b"\n\n\na", b"\n\nab", b"\nab\xff", b"\n\n\n\xff", b"\n\n\nc", b"\n\nc\xff"]
    assert at.tolist() == [0, 3, 4, 6]


def test_adaptive_code_learns_repetition():
    once, twice = sentences(20, 1), sentences(20, 1) + sentences(20, 1)
    assert ppm.adaptive_code_length(twice) > 1.7 * ppm.adaptive_code_length(once)
    assert ppm.adaptive_code_length("") == pytest.approx(-math.log10(256))


def test_empty_table_and_no_training_texts(spark):
    assert ppm.score(frame(spark, [])).count() == 0
    only = next(i for i in range(100) if held_out(i))
    row = ppm.score(frame(spark, [(only, "ab")])).first()
    assert (row.train_tokens, row.n_known, row.n_tokens) == (0, 0, 2)
    assert row.score == pytest.approx(-3 * math.log10(256)) and row.base_score == pytest.approx(0)


@pytest.mark.parametrize("order, keys", [(5, 1 << 22), (5, 20), (7, 20)])
def test_long_contexts_equal_brute_force(spark, order, keys):
    rows = ODD + [(i, sentences(30, i % 11) + " Upper É") for i in range(20, 50)] + [(60, "zzz qqq")]
    data = [b"\n" * order + (text or "").encode() + b"\xff" for _, text in rows]
    trie = defaultdict(Counter)
    for (i, _), raw in zip(rows, data):
        for at in range(order, len(raw) if not held_out(i) else 0):
            for k in range(order + 1):
                trie[raw[at - k : at]][raw[at]] += 1
    want = [
        (repr(i), sum(
            math.log10(plain_probability([trie[raw[at - k : at]] for k in range(order, -1, -1)], raw[at]))
            for at in range(order, len(raw))
        ))
        for (i, _), raw in zip(rows, data)
    ]
    got = [(repr(r.doc_id), r.score) for r in ppm.score(with_clashes(frame(spark, rows)), keys, order=order).collect()]
    for a, b in zip(sorted(got), sorted(want), strict=True):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1], abs=1e-6)


def test_order_is_bounded_by_the_key(spark):
    with pytest.raises(ValueError):
        ppm.score(frame(spark, []), order=8)
