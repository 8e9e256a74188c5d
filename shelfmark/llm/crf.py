"""Linear-chain conditional random fields in numpy: training, forward-backward and Viterbi.

Sequences of any length are worked on side by side, ordered by length, so a step of the chain is
one array operation over all sequences that still run. Emissions come from hashed binary features
of *types* (words, or blocks with the same features); a position refers to its type, so features
are summed once per type.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Field:
    """A trained field: emission weights per feature and label, transitions, starts and ends."""

    labels: list[str]
    emission: np.ndarray  # features x labels
    transition: np.ndarray  # label before x label after
    start: np.ndarray
    end: np.ndarray

    @property
    def n_features(self) -> int:
        return len(self.emission)


@dataclass
class Features:
    """Feature numbers of all types, one after the other; type n has ``flat[at[n]:at[n + 1]]``."""

    flat: np.ndarray
    at: np.ndarray

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Sum of the weights of each type's features, a label at a time."""
        out = np.empty((len(self.at) - 1, weights.shape[1]))
        sums = np.zeros(len(self.flat) + 1)
        for k in range(weights.shape[1]):
            np.cumsum(weights[:, k][self.flat], out=sums[1:])
            out[:, k] = sums[self.at[1:]] - sums[self.at[:-1]]
        return out

    def spread(self, gradient: np.ndarray, n_features: int) -> np.ndarray:
        """Sum, for each feature, of its types' gradients."""
        sizes = np.diff(self.at)
        out = np.empty((n_features, gradient.shape[1]))
        for k in range(gradient.shape[1]):
            out[:, k] = np.bincount(self.flat, np.repeat(gradient[:, k], sizes), n_features)
        return out


class Chains:
    """Positions of sequences that lie one after the other, visited step by step."""

    def __init__(self, lengths: np.ndarray):
        lengths = np.asarray(lengths, np.int64)
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] > 0]
        self.first, self.lengths = first[order], lengths[order]
        self.last = self.first + self.lengths - 1
        longest = int(self.lengths[0]) if len(self.lengths) else 0
        #: Number of sequences that have a position at each step.
        self.running = np.searchsorted(-self.lengths, -np.arange(longest), "left")
        self.size = int(lengths.sum())


def _weights(field: Field, scores: np.ndarray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials of the transitions and of the emissions, the latter scaled per position."""
    local = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(dtype)
    return np.exp(field.transition).astype(dtype), local


def marginals(
    field: Field, scores: np.ndarray, chains: Chains, dtype=np.float64, pairs: bool = False
) -> tuple[np.ndarray, np.ndarray | None]:
    """Forward-backward: each position's label probabilities, and expected transitions if asked."""
    n_labels = len(field.labels)
    step, local = _weights(field, scores, dtype)
    alpha = np.empty((chains.size, n_labels), dtype)
    now = np.exp(field.start).astype(dtype) * local[chains.first]
    for t, running in enumerate(chains.running):
        at = chains.first[:running] + t
        if t:
            now = (now[:running] @ step) * local[at]
        now = now / now.sum(axis=1, keepdims=True)
        alpha[at] = now
    expected = np.zeros((n_labels, n_labels)) if pairs else None
    end = np.exp(field.end).astype(dtype)
    beta = np.ones((len(chains.first), n_labels), dtype)
    for t in range(len(chains.running) - 1, -1, -1):
        running = chains.running[t]
        at = chains.first[:running] + t
        longer = chains.running[t + 1] if t + 1 < len(chains.running) else 0
        after = np.empty((running, n_labels), dtype)
        after[longer:] = end
        if longer:
            ahead = beta[:longer] * local[at[:longer] + 1]
            after[:longer] = ahead @ step.T
            if pairs:
                joint = alpha[at[:longer]][:, :, None] * step * ahead[:, None, :]
                expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        after /= after.sum(axis=1, keepdims=True)
        beta[:running] = after
        product = alpha[at] * after
        alpha[at] = product / product.sum(axis=1, keepdims=True)
    return alpha, expected


def viterbi(field: Field, scores: np.ndarray, chains: Chains) -> np.ndarray:
    """The most probable label of each position's sequence; of equal paths, lower labels first."""
    labels = np.zeros(chains.size, np.int64)
    back = np.zeros((chains.size, len(field.labels)), np.int32)
    now = field.start + scores[chains.first]
    final = np.zeros(len(chains.first), np.int64)
    for t, running in enumerate(chains.running):
        at = chains.first[:running] + t
        if t:
            paths = now[:running, :, None] + field.transition
            back[at] = paths.argmax(axis=1)
            now = paths.max(axis=1) + scores[at]
        ended = chains.running[t + 1] if t + 1 < len(chains.running) else 0
        final[ended:running] = (now[ended:running] + field.end).argmax(axis=1)
    current = np.zeros(len(chains.first), np.int64)
    for t in range(len(chains.running) - 1, -1, -1):
        running = chains.running[t]
        at = chains.first[:running] + t
        longer = chains.running[t + 1] if t + 1 < len(chains.running) else 0
        current[longer:running] = final[longer:running]
        if longer:
            current[:longer] = back[at[:longer] + 1, current[:longer]]
        labels[at] = current[:running]
    return labels


def train(
    features: Features,
    types: np.ndarray,
    labels: np.ndarray,
    lengths: np.ndarray,
    names: list[str],
    n_features: int,
    steps: int = 60,
    rate: float = 0.3,
    ridge: float = 1e-6,
) -> Field:
    """Maximise the conditional log-likelihood with a ridge penalty, by Adam on all sequences."""
    n_labels, chains = len(names), Chains(lengths)
    target = np.zeros((len(types), n_labels))
    target[np.arange(len(types)), labels] = 1
    inner = np.ones(len(types), bool)
    inner[chains.first] = False
    follow = np.flatnonzero(inner)
    observed = np.zeros((n_labels, n_labels))
    np.add.at(observed, (labels[follow - 1], labels[follow]), 1)
    field = Field(
        list(names),
        np.zeros((n_features, n_labels)),
        np.zeros((n_labels, n_labels)),
        np.zeros(n_labels),
        np.zeros(n_labels),
    )
    values = [field.emission, field.transition, field.start, field.end]
    first, second = ([np.zeros_like(v) for v in values] for _ in range(2))
    n_types = len(features.at) - 1
    for step in range(1, steps + 1):
        likely, expected = marginals(field, features.scores(field.emission)[types], chains, pairs=True)
        rest = target - likely
        by_type = np.stack(
            [np.bincount(types, rest[:, k], n_types) for k in range(n_labels)], axis=1
        )
        gradients = [
            features.spread(by_type, n_features),
            observed - expected,
            rest[chains.first].sum(axis=0),
            rest[chains.last].sum(axis=0),
        ]
        for value, gradient, m, v in zip(values, gradients, first, second):
            gradient = gradient / len(types) - ridge * value
            m += 0.1 * (gradient - m)
            v += 0.01 * (gradient * gradient - v)
            scale = np.sqrt(v / (1 - 0.99**step)) + 1e-8
            value += rate * (m / (1 - 0.9**step)) / scale
    return field
