"""A log-bilinear model of units, trained in numpy by noise-contrastive estimation.

Each unit has a vector as context and one as target, and a bias. Two units before predict the next:
their context vectors, weighted by place and component, add up to a prediction, whose products with
the target vectors, plus the biases, are the units' logits. Training tells the unit that comes
from NOISE units drawn by frequency, a batch at a time, so no step looks at all units. As the logits are
sums over the two places, the sums over all units of their exponentials, for all pairs of contexts at
once, are one matrix product, which makes the probabilities exact (:class:`Scorer`).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SIZE = 16
BATCH = 2048
NOISE = 32
RATE = 0.05
# Tokens that are shuffled together.
SHUFFLED = 1 << 18


@dataclass
class Parameters:
    """``flat`` holds context vectors (one more, of what comes before a text), target vectors, biases and weights of
    the places; ``seen`` the mean squares of their gradients so far, by vector."""

    units: int
    size: int
    flat: np.ndarray
    seen: np.ndarray

    @property
    def views(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Context vectors, target vectors, biases, weights of the places."""
        a, b = (self.units + 1) * self.size, (2 * self.units + 1) * self.size
        return (
            self.flat[:a].reshape(-1, self.size),
            self.flat[a:b].reshape(-1, self.size),
            self.flat[b : b + self.units],
            self.flat[b + self.units :].reshape(2, self.size),
        )

    @property
    def seen_views(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.units + 1, 2 * self.units + 1
        return self.seen[:a], self.seen[a:b], self.seen[b : b + self.units], self.seen[b + self.units :]

    def copy(self) -> Parameters:
        return Parameters(self.units, self.size, self.flat.copy(), self.seen.copy())


def initial(frequency: np.ndarray, size: int = SIZE) -> Parameters:
    """Parameters that say each unit's frequency, whatever comes before."""
    units = len(frequency)
    out = Parameters(units, size, np.zeros((2 * units + 3) * size + units, np.float32), np.zeros(3 * units + 3, np.float32))
    contexts, _, biases, places = out.views
    contexts[:] = np.random.default_rng(0).normal(0, 0.3, contexts.shape)
    biases[:] = np.log(frequency)
    places[:] = [[1.0], [0.7]]
    return out


def contexts_of(units: np.ndarray, offsets: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """The units one and two before each; ``begin`` before a text's first."""
    one, two = np.full(len(units), begin, np.int64), np.full(len(units), begin, np.int64)
    one[1:], two[2:] = units[:-1], units[:-2]
    starts = offsets[:-1][np.diff(offsets) > 0]
    one[starts] = begin
    two[starts] = begin
    seconds = starts[starts + 1 < len(units)] + 1
    two[seconds] = begin
    return one, two


def _added(table: np.ndarray, seen: np.ndarray, at: np.ndarray, gradient: np.ndarray, rate: float) -> None:
    """Moves rows of a table along their gradients' sums, less the more they have moved."""
    order = np.argsort(at.astype(np.uint16) if len(table) < 1 << 16 else at, kind="stable")
    at = at[order]
    begins = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    rows, total = at[begins], np.add.reduceat(gradient[order], begins, 0)
    seen[rows] += (total * total).mean(1) if total.ndim > 1 else total * total
    step = rate / np.sqrt(seen[rows] + 1e-6)
    table[rows] += total * step[:, None] if total.ndim > 1 else total * step


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)), in place."""
    np.negative(x, out=x)
    np.minimum(x, 60, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def train(
    parameters: Parameters, units: np.ndarray, offsets: np.ndarray, frequency: np.ndarray, rng: np.random.Generator, rate: float = RATE
) -> None:
    """One pass over some texts' units, in random order; changes the parameters."""
    contexts, targets, biases, places = parameters.views
    seen_contexts, seen_targets, seen_biases, seen_places = parameters.seen_views
    ones, twos = contexts_of(units, offsets, parameters.units)
    order = rng.permutation(len(units))
    total = np.cumsum(frequency)
    log_noise = np.log(NOISE * frequency).astype(np.float32)
    for i in range(0, len(order), BATCH):
        at = order[i : i + BATCH]
        one, two, right = ones[at], twos[at], units[at]
        noise = np.searchsorted(total, rng.random(NOISE) * total[-1], "right").clip(max=len(total) - 1)
        first, second = contexts[one], contexts[two]
        predicted = first * places[0] + second * places[1]
        own, others = targets[right], targets[noise]
        is_right = _sigmoid(np.einsum("ij,ij->i", predicted, own) + (biases - log_noise)[right])
        is_noise = _sigmoid(predicted @ others.T + (biases - log_noise)[noise])
        up = 1 - is_right
        change = up[:, None] * own - is_noise @ others
        move = np.stack([np.einsum("ij,ij->j", change, first), np.einsum("ij,ij->j", change, second)])
        both = np.concatenate([right, noise])
        _added(targets, seen_targets, both, np.concatenate([up[:, None] * predicted, -is_noise.T @ predicted]), rate)
        _added(biases, seen_biases, both, np.concatenate([up, -is_noise.sum(0)]), rate)
        _added(
            contexts, seen_contexts, np.concatenate([one, two]), np.concatenate([change * places[0], change * places[1]]), rate
        )
        seen_places += (move * move).mean(1)
        places += move * (0.1 * rate / np.sqrt(seen_places + 1e-6))[:, None]


class Scorer:
    """Exact log probabilities under some parameters."""

    def __init__(self, parameters: Parameters):
        contexts, targets, biases, places = (x.astype(np.float64) for x in parameters.views)
        self.begin = parameters.units
        self.one = (contexts * places[0]) @ targets.T + biases
        self.two = (contexts * places[1]) @ targets.T
        most_one, most_two = self.one.max(1, keepdims=True), self.two.max(1, keepdims=True)
        sums = np.exp(self.one - most_one) @ np.exp(self.two - most_two).T
        self.whole = np.log(np.maximum(sums, 1e-300)) + most_one + most_two.T

    def logs(self, units: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The natural logarithm of each unit's probability after the two before it."""
        one, two = contexts_of(units, offsets, self.begin)
        return self.one[one, units] + self.two[two, units] - self.whole[one, two]
