"""Registered queries, each with its check in SQL where SQL can say the same."""

from tieproof.catalog.base import ORACLES, QUERIES
from tieproof.catalog import aggregates, jobs, joins, rules, scalars, sources, streams, texts, windows  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
