"""Fixture tables derived from the test data, and one checked query per operator."""

from shardtally.checks import composite, primitive  # noqa: F401  (they register the queries)
from shardtally.checks.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
