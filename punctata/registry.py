"""Queries and their oracles, gathered from the modules of ``plans``."""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from punctata import plans


def _modules():
    for found in sorted(pkgutil.iter_modules(plans.__path__), key=lambda m: m.name):
        yield importlib.import_module(f"{plans.__name__}.{found.name}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable] = {}
    for m in _modules():
        out |= getattr(m, "QUERIES", {})
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _modules():
        out |= getattr(m, "ORACLES", {})
    return out
