"""Domain constants shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Domain:
    """A vocabulary of items 1..items, one special 1..specials, `pick` items per step."""

    items: int = 47
    specials: int = 27
    pick: int = 5
    low_max: int = 23

    @property
    def slots(self) -> int:
        """Width of the combined item + special state vector."""
        return self.items + self.specials

    @property
    def random_hits(self) -> float:
        return self.pick * self.pick / self.items


DRAWS = Domain()

# The payoff of (item hits, special hit) for a ticket of cost 1; every other pair pays 0.
PRIZES = {
    (5, True): 7000000.0,
    (5, False): 25241.0,
    (4, True): 1402.0,
    (4, False): 108.0,
    (3, True): 61.0,
    (3, False): 11.0,
    (2, True): 12.0,
    (1, True): 2.0,
    (0, True): 1.0,
}
TICKET_COST = 1.0

# State windows, walk lengths and split ratios.
SHORT_WINDOW = 20
MID_WINDOW = 50
LOOKBACK = 10
INITIAL_STEPS = 200
VALIDATION_STEPS = 60
MAX_TICKETS = 5
TICKET_CANDIDATES = 12

# Refit period of each scorer in the prequential walk.
REFIT_EVERY = {
    "bayesian": 1,
    "markov": 1,
    "frequency": 1,
    "knn": 1,
    "decision_tree": 1,
    "rf": 3,
    "xgb": 3,
    "ensemble": 30,
    "genetic": 10,
    "mlp": 10,
}

# Vote weight of each scorer in the ensemble, in tenths so that votes add up exactly.
VOTE_TENTHS = {
    "frequency": 10,
    "markov": 10,
    "bayesian": 12,
    "knn": 12,
    "decision_tree": 8,
    "genetic": 8,
}
