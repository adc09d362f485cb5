"""Weak supervision over vote patterns: reliabilities by expectation-maximisation.

Votes are -1 (no), 0 (abstain) and 1 (yes). Spark counts how often every pattern
of votes occurs; there are at most 3 ** labelers of them per group, however many
rows there are, so the iterations run on that small table of counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass


@dataclass(frozen=True)
class Reliability:
    """Per labeler: the probability of each vote given a positive and a negative row."""

    prior: float
    given: tuple[tuple[dict[int, float], dict[int, float]], ...]

    def log_odds(self, votes: tuple[int, ...]) -> float:
        odds = math.log(self.prior / (1 - self.prior))
        for vote, (yes, no) in zip(votes, self.given):
            odds += math.log(yes[vote] / no[vote])
        return odds

    def posterior(self, votes: tuple[int, ...]) -> float:
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, self.log_odds(votes)))))


def estimate(
    counts: dict[tuple[int, ...], int], prior: float = 0.5, smoothing: float = 1.0, rounds: int = 200
) -> Reliability:
    """Two-class model of conditionally independent labelers, started from the majority vote.

    A tie starts as rather negative: a pattern with as many no as yes votes is
    unlike the rows most labelers agree on.

    Smoothing keeps every probability positive and prefers labelers that are
    better than chance, so the classes cannot swap. No counts give the start.
    """
    n = len(next(iter(counts), ()))
    total = sum(counts.values())
    belief = {v: 1 / (1 + math.exp(1.0 - 2.0 * sum(v))) for v in counts}
    model = _maximised(counts, belief, n, prior, total, smoothing)
    for _ in range(rounds):
        new = {v: model.posterior(v) for v in counts}
        moved = max((abs(new[v] - belief[v]) for v in counts), default=0.0)
        belief = new
        model = _maximised(counts, belief, n, prior, total, smoothing)
        if moved < 1e-9:
            break
    return model


def _maximised(counts, belief, n, prior, total, smoothing) -> Reliability:
    positive = sum(c * belief[v] for v, c in counts.items())
    share = (positive + 2 * smoothing * prior) / (total + 2 * smoothing) if total else prior
    given = []
    for j in range(n):
        yes = {-1: 0.5 * smoothing, 0: smoothing, 1: 2 * smoothing}
        no = {-1: 2 * smoothing, 0: smoothing, 1: 0.5 * smoothing}
        for v, c in counts.items():
            yes[v[j]] += c * belief[v]
            no[v[j]] += c * (1 - belief[v])
        given.append(
            ({k: x / sum(yes.values()) for k, x in yes.items()}, {k: x / sum(no.values()) for k, x in no.items()})
        )
    return Reliability(min(max(share, 1e-6), 1 - 1e-6), tuple(given))


def logistic(rows: list[tuple[tuple[float, ...], float, float]], l2: float = 1.0, rounds: int = 50) -> list[float]:
    """Weights (the last is the bias) of a logistic regression on (features, soft label, count)
    rows, by Newton steps; the penalty keeps them finite. No rows give zeros."""
    if not rows:
        return []
    n = len(rows[0][0]) + 1
    w = [0.0] * n
    for _ in range(rounds):
        gradient = [-l2 * x for x in w]
        hessian = [[l2 if i == j else 0.0 for j in range(n)] for i in range(n)]
        for features, label, count in rows:
            x = (*features, 1.0)
            z = max(-30.0, min(30.0, sum(a * b for a, b in zip(w, x))))
            p = 1 / (1 + math.exp(-z))
            for i in range(n):
                gradient[i] += count * (label - p) * x[i]
                for j in range(n):
                    hessian[i][j] += count * p * (1 - p) * x[i] * x[j]
        step = _solved(hessian, gradient)
        w = [a + b for a, b in zip(w, step)]
        if max(map(abs, step)) < 1e-9:
            break
    return w


def _solved(matrix: list[list[float]], right: list[float]) -> list[float]:
    rows = [[*r, b] for r, b in zip(matrix, right)]
    n = len(rows)
    for i in range(n):
        pivot = max(range(i, n), key=lambda k: abs(rows[k][i]))
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for k in range(n):
            if k != i and rows[k][i]:
                f = rows[k][i]
                rows[k] = [a - f * b for a, b in zip(rows[k], rows[i])]
    return [r[-1] for r in rows]
