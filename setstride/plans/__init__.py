"""The registered queries and their check SQL."""

from setstride.plans import evaluation, features, ingest, scoring, streams  # noqa: F401
from setstride.plans.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
