"""All registered queries."""

from tidemark.plans import late, matching, rolling, rows, windows  # noqa: F401
from tidemark.plans import streams  # noqa: F401  (registration)
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
