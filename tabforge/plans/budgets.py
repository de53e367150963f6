"""Training budgets in one place: what a real run uses, and what the registered queries use."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Budget:
    rounds: int
    patience: int
    depth: int
    importance_rounds: int
    importance_depth: int
    search_trials: int
    search_rounds: int
    max_bins: int = 256


#: The reference's budget; the defaults of ``jobs.TrainConfig``.
REFERENCE = Budget(rounds=1000, patience=50, depth=7, importance_rounds=100, importance_depth=6, search_trials=30,
                   search_rounds=1000)
#: The registered queries: patience, not the rounds, is to end their fits.
QUERIES = Budget(rounds=200, patience=20, depth=3, importance_rounds=20, importance_depth=4, search_trials=30,
                 search_rounds=200)
