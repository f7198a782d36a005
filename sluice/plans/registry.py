"""All registered queries of the detection analytics engine and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import queries_catalog, queries_evaluate, queries_files, queries_report, queries_sources

MODULES = (queries_report, queries_catalog, queries_evaluate, queries_sources, queries_files)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.Q.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
