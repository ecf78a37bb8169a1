"""Named reports over the given tables, grouped by subject."""

from __future__ import annotations

import importlib

MODULES = ["segments", "lists", "quality", "functions", "layers", "blocks", "learning", "streams"]


def _load():
    from leadmill.plans import registry

    for module in MODULES:
        importlib.import_module(f"leadmill.plans.{module}")
    return registry


def all_queries():
    return _load().QUERIES


def all_sql():
    return _load().ORACLES
