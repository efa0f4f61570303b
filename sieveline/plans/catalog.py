"""All queries of the core library by name, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sieveline.operators import chunking, curation, dedup, evaluation, loading, models, monitoring, retrieval
from sieveline.sources import readers
from sieveline.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
MODULES = [dedup, curation, chunking, retrieval, evaluation, monitoring, loading, models, readers, incremental]


def queries() -> dict[str, Query]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
