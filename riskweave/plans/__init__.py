"""Registered queries, one module per operator family."""

from __future__ import annotations

import importlib

from riskweave.plans import registry

_FAMILIES = ("fraud", "normal", "decisions", "measures", "texts", "files", "streams")


def _load() -> None:
    for family in _FAMILIES:
        importlib.import_module(f"riskweave.plans.{family}")


def queries() -> dict[str, registry.QueryFn]:
    _load()
    return dict(sorted(registry.QUERIES.items()))


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(sorted(registry.SQL.items()))
