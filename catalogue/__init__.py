"""Registered queries with their SQL counterparts, grouped by operator family."""

from __future__ import annotations

from importlib import import_module

MODULES = ("facts", "metrics", "time", "dimensions", "cleaning", "changes", "quality", "discovery", "staging", "incremental")


def registered() -> dict[str, tuple]:
    """Query name to (callable, SQL or None)."""
    found: dict[str, tuple] = {}
    for module in MODULES:
        for name, query in import_module(f"catalogue.{module}").QUERIES.items():
            if name in found:
                raise ValueError(f"query {name!r} is registered twice")
            found[name] = query
    return found
