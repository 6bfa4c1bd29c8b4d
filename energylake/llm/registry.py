"""Queries of this subpackage, each with its SQL where SQL can express it."""

from __future__ import annotations

from energylake.queries.registry import Query, Run

REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function under its own name."""

    def register(run: Run) -> Run:
        REGISTRY[run.__name__] = Query(run, sql)
        return run

    return register
