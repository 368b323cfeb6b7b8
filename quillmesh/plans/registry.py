"""All named queries of the core."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillmesh.plans import analysis, columns, pages, problems, reading, state

_MODULES = (problems, columns, state, pages, reading, analysis)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for m in _MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
