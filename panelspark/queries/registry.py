"""Name → (Spark query, oracle SQL)."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Runner = Callable[[SparkSession, str], DataFrame]

_FAMILIES = ("winners", "cleaning", "joins", "shaping", "panels", "files", "stored", "domains", "profiling", "modelling")
_RUNNERS: dict[str, Runner] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register a query under ``name``; ``sql`` is its independent oracle."""

    def add(run: Runner) -> Runner:
        if name in _RUNNERS:
            raise ValueError(f"query {name!r} is registered twice")
        _RUNNERS[name] = run
        if sql is not None:
            _ORACLES[name] = sql
        return run

    return add


def _load() -> None:
    for family in _FAMILIES:
        importlib.import_module(f"panelspark.queries.{family}")


def runners() -> dict[str, Runner]:
    _load()
    return dict(_RUNNERS)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
