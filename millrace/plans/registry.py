"""The catalogue of runnable queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Runner = Callable[[SparkSession, str], DataFrame]

_RUNNERS: dict[str, Runner] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Runner], Runner]:
    """Register a query under ``name`` with the SQL that must give the same rows."""

    def register(run: Runner) -> Runner:
        if name in _RUNNERS:
            raise ValueError(f"query {name} is registered twice")
        _RUNNERS[name] = run
        if oracle is not None:
            _ORACLES[name] = oracle
        return run

    return register


def runners() -> dict[str, Runner]:
    return dict(_RUNNERS)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)
