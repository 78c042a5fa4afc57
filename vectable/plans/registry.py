"""All registered queries."""

from __future__ import annotations

import importlib

from vectable.plans.common import Query

MODULES = ("tables", "files", "scalers", "neighbours", "reductions", "clusters", "supervised", "sequences", "streams")

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
for _module in MODULES:
    _catalog = importlib.import_module(f"vectable.plans.{_module}").catalog
    QUERIES.update(_catalog.queries)
    ORACLE.update(_catalog.oracle)
