"""Queries over the derived street network, grouped by kind of operator."""

from __future__ import annotations

from importlib import import_module

MODULES = ("scalars", "geometry", "matching", "junctions", "viewing", "editing", "tables")


def _load() -> None:
    for m in MODULES:
        import_module(f"queries.{m}")


def all_queries() -> dict:
    from queries.registry import QUERIES
    _load()
    return dict(QUERIES)


def all_oracles() -> dict:
    from queries.registry import ORACLES
    from queries.sqltext import with_parts
    _load()  # parts are named across modules, so they are put together once all are there
    return {name: with_parts(sql) for name, sql in ORACLES.items()}
