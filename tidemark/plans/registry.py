"""All registered queries of the analytics library and the SQL that gives their rows."""

from __future__ import annotations

from tidemark.plans import forecasts, landing, news, rollups, series  # noqa: F401  registers their queries
from tidemark.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
