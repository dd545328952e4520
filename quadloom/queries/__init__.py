"""Queries that bind the operators to the driver's tables, each with its SQL."""

from __future__ import annotations

from . import floods, geometry, kernels, names, rasters, relations, reports

MODULES = [geometry, relations, floods, reports, names, rasters, kernels]


def queries() -> dict:
    return {name: run for m in MODULES for name, (run, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql}
