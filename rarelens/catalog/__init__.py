"""Registered queries with the SQL that states the same result."""

from rarelens.catalog import evaluation, growing, learning, profiling, serving  # noqa: F401
from rarelens.catalog.registry import oracles, queries  # noqa: F401
