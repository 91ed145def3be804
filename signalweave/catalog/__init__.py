"""Every operator as a query over the driver's tables, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from signalweave.catalog import documents, files, incremental, large, learned, relational, series, streams, tagging, threads

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = (series, tagging, relational, threads, documents, large, learned, incremental, files, streams)


def queries() -> dict[str, Query]:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
