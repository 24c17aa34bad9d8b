"""Every query of the engine, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import assembly, citations, domain, evaluation, integrity, reconcile, records, web

_PARTS = (citations, integrity, records, reconcile, domain, evaluation, web, assembly)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: f for part in _PARTS for k, f in part.QUERIES.items()}
ORACLE_SQL: dict[str, str] = {k: sql for part in _PARTS for k, sql in part.ORACLE_SQL.items()}
