"""Small models fitted on the driver from a bounded sample of sparse rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Sparse:
    """Rows of (feature, value) pairs, laid end to end."""

    ids: np.ndarray
    values: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]]) -> Sparse:
        if not rows:
            return cls(np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(0, np.int64))
        return cls(np.concatenate([r[0] for r in rows]).astype(np.int32),
                   np.concatenate([r[1] for r in rows]).astype(np.float32),
                   np.cumsum([len(r[0]) for r in rows]))

    def rows(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(features, values, row number in ``order``) of some rows."""
        start = np.r_[0, self.ends[:-1]][order]
        size = self.ends[order] - start
        row = np.repeat(np.arange(len(order)), size)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)
        return self.ids[at], self.values[at], row


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(x: Sparse, y: np.ndarray, n_features: int, rows: np.ndarray | None = None, epochs: int = 20,
                 batch: int = 128, rate: float = 0.5, l2: float = 1e-6, seed: int = 7) -> tuple[np.ndarray, float]:
    """Logistic regression by mini-batch Adagrad on some ``rows`` (all by
    default); the same rows in the same order give the same weights."""
    rows = np.arange(len(y)) if rows is None else rows
    rng = np.random.default_rng(seed)
    w, g2, b, b2 = np.zeros(n_features), np.full(n_features, 1e-8), 0.0, 1e-8
    for _ in range(epochs):
        for order in np.array_split(rng.permutation(rows), max(1, len(rows) // batch)):
            f, v, row = x.rows(order)
            err = sigmoid(np.bincount(row, v * w[f], len(order)) + b) - y[order]
            used, at = np.unique(f, return_inverse=True)
            g = np.bincount(at, v * err[row]) / len(order) + l2 * w[used]
            g2[used] += g * g
            w[used] -= rate * g / np.sqrt(g2[used])
            gb = err.mean()
            b2 += gb * gb
            b -= rate * gb / np.sqrt(b2)
    return w, b


def fit_platt(score: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(a, b) with P(y = 1) = sigmoid(a * score + b), by Newton steps on targets
    drawn in from 0 and 1 by the sample size."""
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([score, np.ones_like(score)], axis=1)
    p = np.array([1.0, 0.0])
    for _ in range(steps):
        q = sigmoid(x @ p)
        hess = (x * (q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, x.T @ (q - t) + 1e-3 * (p - [1, 0]))
        p = p - np.clip(step, -1, 1)
    return float(p[0]), float(p[1])


@dataclass
class Factorization:
    """Second-order factorization machine over the distinct terms of a text."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, terms: np.ndarray) -> float:
        """bias + sum of weights + sum over pairs of their factors' products."""
        if not len(terms):
            return self.bias
        v = self.factors[terms]
        total = v.sum(0)
        return float(self.bias + self.linear[terms].sum() + 0.5 * (total @ total - (v * v).sum()))


def telling_terms(x: Sparse, y: np.ndarray, n_features: int, most: int) -> np.ndarray:
    """The ``most`` terms whose rows differ most from all rows in their share of
    positives (by standard errors), in order; ties by number."""
    row = np.repeat(np.arange(len(y)), np.diff(np.r_[0, x.ends]))
    count = np.bincount(x.ids, minlength=n_features)
    share = y.mean() if len(y) else 0.5
    excess = np.abs(np.bincount(x.ids, y[row], minlength=n_features) - share * count)
    z = excess / np.sqrt(np.maximum(count * share * (1 - share), 1e-9))
    return np.sort(np.argsort(-z, kind="stable")[:most][:int((count > 0).sum())])


def fit_factorization(x: Sparse, y: np.ndarray, n_features: int, rank: int = 8, paired: int = 64, pair_epochs: int = 20,
                      epochs: int = 12, batch: int = 64, pair_rate: float = 0.2, l2: float = 0.1, rate: float = 1.0,
                      l1: float = 0.02, seed: int = 7) -> Factorization:
    """Factorization machine on binary features by mini-batch Adagrad, the pairs
    before the weights.

    First the factors of the ``paired`` most telling terms are fitted without any
    weights: what one term alone does not show, such as an insult or a mention
    of a group, is left to their products.  The weights of all terms then fit
    what the pairs leave.  A long text's many neutral terms have no factors to
    add up, and an L1 step keeps their weights at zero.  Squared gradients start
    at one, so a term seen in few rows moves in proportion to its evidence.
    """
    rng = np.random.default_rng(seed)
    told = telling_terms(x, y, n_features, paired)
    place = np.full(n_features, -1)
    place[told] = np.arange(len(told))
    row = np.repeat(np.arange(len(y)), np.diff(np.r_[0, x.ends]))
    has = place[x.ids] >= 0
    few = Sparse(place[x.ids[has]].astype(np.int32), np.ones(int(has.sum()), np.float32),
                 np.searchsorted(row[has], np.arange(len(y)), "right"))
    v, v2 = rng.normal(0, 0.2, (len(told), rank)), np.full((len(told), rank), 0.1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
    b, b2 = float(np.log(share / (1 - share))), 1.0
    batches = max(1, len(y) // batch)

    def products(order: np.ndarray):
        f, _, r = few.rows(order)
        total = np.stack([np.bincount(r, v[f, k], len(order)) for k in range(rank)], axis=1)
        return f, r, total, 0.5 * ((total * total).sum(1) - np.bincount(r, (v[f] ** 2).sum(1), len(order)))

    for _ in range(pair_epochs):
        for order in np.array_split(rng.permutation(len(y)), batches):
            f, r, total, pairs = products(order)
            err = sigmoid(b + pairs) - y[order]
            used, at = np.unique(f, return_inverse=True)
            if len(used):
                g = np.stack([np.bincount(at, err[r] * (total[r, k] - v[f, k])) for k in range(rank)], axis=1)
                g += l2 * v[used]
                v2[used] += g * g
                v[used] -= pair_rate * g / np.sqrt(v2[used])
            gb = err.sum()
            b2 += gb * gb
            b -= gb / np.sqrt(b2)
    given = products(np.arange(len(y)))[3]
    w, w2 = np.zeros(n_features), np.ones(n_features)
    b, b2 = float(np.log(share / (1 - share))), 1.0
    for _ in range(epochs):
        for order in np.array_split(rng.permutation(len(y)), batches):
            f, _, r = x.rows(order)
            err = sigmoid(b + given[order] + np.bincount(r, w[f], len(order))) - y[order]
            used, at = np.unique(f, return_inverse=True)
            if len(used):
                g = np.bincount(at, err[r])
                w2[used] += g * g
                step = rate / np.sqrt(w2[used])
                moved = w[used] - step * g
                w[used] = np.sign(moved) * np.maximum(np.abs(moved) - step * l1, 0)
            gb = err.sum()
            b2 += gb * gb
            b -= rate * gb / np.sqrt(b2)
    factors = np.zeros((n_features, rank))
    factors[told] = v
    return Factorization(b, w, factors)
