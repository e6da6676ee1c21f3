"""Driver queries with their SQL: one module per operator family."""

from __future__ import annotations

from suite import checks, deliveries, functions, loads, modes, reports, sources, tables

MODULES = (loads, deliveries, sources, functions, checks, modes, tables, reports)


def queries() -> dict:
    return {name: query for module in MODULES for name, (query, _) in module.SUITE.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, (_, sql) in module.SUITE.items() if sql}
