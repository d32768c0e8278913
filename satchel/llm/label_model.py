"""A generative model of voters that say yes, say no or abstain.

Each voter abstains and errs with rates of its own, given the true label; expectation-maximisation estimates the rates and
the posterior of each row without labels.  Voters that agree beyond what the label explains would count twice, so
their residual correlations are estimated too and each vote is weighted by how much of it is its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

NO, ABSTAIN, YES = 0, 1, 2
ROUNDS = 50


@dataclass
class LabelModel:
    rates: np.ndarray  # (2 labels, voters, 3 votes)
    prior: float
    weights: np.ndarray  # of each voter, from its correlations with the others
    correlations: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of the label 1 for each row of ``votes`` (0 no, 1 abstain, 2 yes)."""
        logs = np.log(self.rates)
        odds = np.full(len(votes), np.log(self.prior / (1 - self.prior)))
        for voter, weight in enumerate(self.weights):
            odds += weight * (logs[1, voter] - logs[0, voter])[votes[:, voter]]
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit(
    votes: np.ndarray, counts: np.ndarray | None = None, prior: float | None = None, rounds: int = ROUNDS, smoothing: float = 1.0
) -> LabelModel:
    """Fit on rows of votes, each standing for ``counts`` rows.

    ``prior`` fixes the share of the label 1, which is estimated otherwise.  The first posterior is the share of yes
    among the votes given; no votes at all leave the prior.
    """
    n, voters = votes.shape
    counts = np.ones(n) if counts is None else counts.astype(float)
    yes, no = (votes == YES).sum(axis=1), (votes == NO).sum(axis=1)
    start = 0.5 if prior is None else prior
    belief = (yes + start) / (yes + no + 1.0)
    model = LabelModel(np.full((2, voters, 3), 1 / 3), start, np.ones(voters), np.eye(voters))
    if not n:
        return model
    onehot = np.stack([votes == kind for kind in (NO, ABSTAIN, YES)], axis=2).astype(np.float64)
    for _ in range(rounds):
        for label, share in ((1, belief), (0, 1 - belief)):
            mass = np.tensordot(share * counts, onehot, axes=1) + smoothing / 3
            model.rates[label] = mass / mass.sum(axis=1, keepdims=True)
        if prior is None:
            model.prior = float(np.clip((belief * counts).sum() / counts.sum(), 0.01, 0.99))
        signs = votes.astype(np.float64) - 1
        means = model.rates[:, :, YES] - model.rates[:, :, NO]
        residual = signs - belief[:, None] * means[1] - (1 - belief)[:, None] * means[0]
        spread = np.sqrt(np.average(residual**2, axis=0, weights=counts)) + 1e-9
        scaled = residual / spread
        model.correlations = (scaled * counts[:, None]).T @ scaled / counts.sum()
        shared = np.clip(model.correlations - np.eye(voters), 0, 1) ** 2
        model.weights = 1 / (1 + shared.sum(axis=1))
        now = model.posterior(votes)
        if np.abs(now - belief).max() < 1e-6:
            break
        belief = now
    return model
