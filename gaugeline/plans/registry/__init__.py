"""Registered queries: each operator on the test tables, with its SQL counterpart."""

from gaugeline.plans.registry import dashboards, etl, models, sampling, statistics, storage  # noqa: F401
from gaugeline.plans.registry.base import ORACLE_SQL, QUERIES, VALUE_QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "VALUE_QUERIES"]
