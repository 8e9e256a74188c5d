from itertools import product

import numpy as np
import pytest

from shelfmark.llm import crf


def field(rng, n=3):
    return crf.Field(
        [str(k) for k in range(n)], rng.normal(size=(8, n)), rng.normal(size=(n, n)), rng.normal(size=n), rng.normal(size=n)
    )


def paths(f, scores):
    """Every path with its score."""
    n = len(scores)
    for path in product(range(len(f.labels)), repeat=n):
        value = f.start[path[0]] + f.end[path[-1]] + sum(scores[i][p] for i, p in enumerate(path))
        yield path, value + sum(f.transition[a, b] for a, b in zip(path, path[1:]))


@pytest.mark.parametrize("seed", range(5))
def test_marginals_and_viterbi_equal_enumeration(seed):
    rng = np.random.default_rng(seed)
    f, lengths = field(rng), np.array([3, 0, 1, 5, 2])
    scores = rng.normal(size=(lengths.sum(), 3)) * 2
    chains = crf.Chains(lengths)
    likely, expected = crf.marginals(f, scores, chains, pairs=True)
    best = crf.viterbi(f, scores, chains)
    want_pairs, at = np.zeros((3, 3)), 0
    for n in lengths:
        if not n:
            continue
        found = list(paths(f, scores[at : at + n]))
        weights = np.exp([v for _, v in found])
        weights /= weights.sum()
        want = np.zeros((n, 3))
        for (path, _), w in zip(found, weights):
            for i, p in enumerate(path):
                want[i, p] += w
            for a, b in zip(path, path[1:]):
                want_pairs[a, b] += w
        assert likely[at : at + n] == pytest.approx(want)
        assert tuple(best[at : at + n]) == max(found, key=lambda x: x[1])[0]
        at += n
    assert expected == pytest.approx(want_pairs)


def test_training_learns_transitions_and_features():
    rng = np.random.default_rng(0)
    labels = np.repeat(rng.integers(0, 2, 300), 10)
    types = np.where(rng.random(len(labels)) < 0.7, labels, 1 - labels)
    features = crf.Features(np.array([0, 1]), np.array([0, 1, 2]))
    f = crf.train(features, types, labels, np.full(30, 100), ["a", "b"], 2, steps=150, rate=0.1)
    scores = features.scores(f.emission)[types]
    got = crf.viterbi(f, scores, crf.Chains(np.full(30, 100)))
    assert f.transition[0, 0] > f.transition[0, 1] and f.transition[1, 1] > f.transition[1, 0]
    assert np.mean(got == labels) > np.mean(types == labels) + 0.05


def test_no_sequences():
    f = field(np.random.default_rng(1))
    chains = crf.Chains(np.array([0, 0]))
    assert crf.marginals(f, np.zeros((0, 3)), chains)[0].shape == (0, 3)
    assert len(crf.viterbi(f, np.zeros((0, 3)), chains)) == 0
