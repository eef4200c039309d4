"""Registered queries over the driver's tables, each with its SQL oracle where SQL can say it."""

from panelspark.queries.registry import oracles, runners

__all__ = ["oracles", "runners"]
