"""Registered queries: one per operator of the inventory, each with a DuckDB
oracle where the operator is expressible in ANSI SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` and reads the given
tables (through the fixture views) in full.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}

_MODULES = ("physics", "validation", "prepare", "evaluation", "jets", "registry", "storage", "learning")


def query(name: str, oracle: str | None = None):
    """Register ``fn`` under ``name``; ``oracle`` is its DuckDB SQL (None = rows-only check)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    for m in _MODULES:
        try:
            importlib.import_module(f"collide.catalog.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"collide.catalog.{m}":
                raise
