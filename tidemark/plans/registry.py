"""All registered queries and their SQL oracles."""

from __future__ import annotations

from tidemark.plans import effects, landed, rules  # noqa: F401  (register their queries)
from tidemark.plans.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
