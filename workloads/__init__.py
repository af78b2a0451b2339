"""Queries over the test tables, one per operator, each with an equivalent in plain SQL where SQL has one.

Untidy input is derived from the clean tables by the same SQL on both sides; what the operators
do to it is written twice, as DataFrame operators here and as SQL for the check.
"""

from __future__ import annotations

from importlib import import_module

MODULES = ("scalars", "intake", "columns", "grids", "jobs", "arrivals", "runs")


def registry() -> tuple[dict, dict]:
    queries, oracles = {}, {}
    for name in MODULES:
        module = import_module(f"workloads.{name}")
        queries.update(module.QUERIES)
        oracles.update(module.SQL)
    return queries, oracles
