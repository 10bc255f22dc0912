"""The operators applied to the given tables, each with its statement in ANSI SQL."""

from weirgate.catalog import drift, loads, observability, quality, refinement, scans, upkeep  # noqa: F401
from weirgate.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
