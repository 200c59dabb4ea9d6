"""All queries of the library by name, without the optional corpus operators."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, run, sql: str | None = None) -> None:
    """Add a query ``run(spark, sf_dir)`` and, where SQL can express it, its DuckDB form."""
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = run
    if sql is not None:
        ORACLES[name] = sql


def load() -> None:
    """Register the queries of all modules."""
    from . import authority, checks, control, extents, georeference, islands, overlay, points, rivers, snapping, spatial, terrain  # noqa: F401
