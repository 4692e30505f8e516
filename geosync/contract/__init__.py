"""Registered queries with their oracle texts."""

from __future__ import annotations

import importlib

from geosync.contract import registry

_MODULES = ("values", "merges", "geoms", "jobs", "loads")


def _load() -> None:
    for name in _MODULES:
        importlib.import_module(f"geosync.contract.{name}")


def queries() -> dict:
    _load()
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(registry.ORACLE)
