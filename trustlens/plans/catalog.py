"""The registry of queries and SQL oracles used by ``__spark_entry__``."""

from __future__ import annotations

from trustlens.plans.oracle_sql import ORACLES
from trustlens.plans.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
