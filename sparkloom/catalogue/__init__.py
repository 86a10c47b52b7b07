"""Registered queries on the driver tables, each with an independent SQL check where SQL can express it."""

from . import aggregates, cleaning, expressions, jobs, joins, learning, ordering, sources, streams, windows  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
