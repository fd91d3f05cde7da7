"""Weak supervision for two classes: expectation-maximisation over votes.

Labellers vote 1 (good), -1 (bad) or 0 (abstain). Given the class, votes are taken as independent, and abstaining as saying
nothing about the class. A labeller has two accuracies: how often its votes on good rows are good, and on bad rows bad. The
second starts low (DETECTION): a rule sees its own kind of fault, and most bad rows have another kind.
Rows enter as counts of vote patterns, which Spark counts over all rows; there are at most 3 ** labellers patterns, however
many rows there are. Beta priors (of `strength` times the rows) keep the accuracies on the labellers' side of chance.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DETECTION = 0.2
MOST_LABELLERS = 12  # 3 ** 12 = 531,441 patterns bound what reaches the driver


@dataclass(frozen=True)
class VoteModel:
    names: tuple[str, ...]
    prior: float  # share of good rows
    good: tuple[float, ...]  # P(vote is good | row is good, no abstention)
    bad: tuple[float, ...]  # P(vote is bad | row is bad, no abstention)

    def weights(self) -> list[tuple[float, float]]:
        """Log-odds of good that a good and a bad vote of each labeller add."""
        return [(float(np.log(g / (1 - b))), float(np.log((1 - g) / b))) for g, b in zip(self.good, self.bad, strict=True)]

    def posterior(self, votes: list[Column]) -> Column:
        """P(good) given the votes, computed in the JVM."""
        z = F.lit(float(np.log(self.prior / (1 - self.prior))))
        for v, (up, down) in zip(votes, self.weights(), strict=True):
            z = z + F.when(v == 1, F.lit(up)).when(v == -1, F.lit(down)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def count_patterns(df: DataFrame, votes: list[str]) -> dict[tuple[int, ...], int]:
    if len(votes) > MOST_LABELLERS:
        raise ValueError(f"at most {MOST_LABELLERS} labellers")
    return {tuple(r[v] for v in votes): r["count"] for r in df.groupBy(*votes).count().collect()}


def fit_votes(patterns: dict[tuple[int, ...], int], names: list[str], prior: float = 0.8, accuracy: float = 0.99, detection: float = DETECTION, strength: float = 0.05, rounds: int = 100) -> VoteModel:
    """Expectation-maximisation from the given prior and accuracies. No rows give these values."""
    n_rules = len(names)
    votes = np.array(list(patterns), np.int8).reshape(-1, n_rules)
    n = np.array(list(patterns.values()), float)
    good, bad, pi = np.full(n_rules, accuracy), np.full(n_rules, detection), prior
    extra = max(1.0, strength * n.sum())
    up, down = votes == 1, votes == -1
    for _ in range(rounds if len(n) else 0):
        z = np.log(pi / (1 - pi)) + up @ np.log(good / (1 - bad)) + down @ np.log((1 - good) / bad)
        p = 1 / (1 + np.exp(-z))
        a, b = n * p, n * (1 - p)
        now = ((a @ up + accuracy * extra) / (a @ (up | down) + extra), (b @ down + detection * extra) / (b @ (up | down) + extra), (a.sum() + prior * extra) / (n.sum() + extra))
        done = max(np.abs(now[0] - good).max(), np.abs(now[1] - bad).max(), abs(now[2] - pi)) < 1e-7
        good, bad, pi = np.clip(now[0], 0.5, 0.9999), np.clip(now[1], 0.01, 0.99), float(np.clip(now[2], 1e-3, 1 - 1e-3))
        if done:
            break
    return VoteModel(tuple(names), pi, tuple(map(float, good)), tuple(map(float, bad)))
