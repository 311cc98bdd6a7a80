"""The engine bound to the driver's tables: input shapes, queries, and DuckDB oracles."""

from __future__ import annotations

import importlib

from .registry import ORACLES, QUERIES

MODULES = ("star", "scalars", "records", "loads", "pairs", "scoring")


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")


def queries() -> dict:
    _load()
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)
