"""All queries and their SQL: importing the modules fills the two tables."""

from __future__ import annotations

from wordloom.plans import checks, curated, exchange, outside  # noqa: F401
from wordloom.plans.catalogue import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
