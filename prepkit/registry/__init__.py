"""Named queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    run: Run
    sql: str | None


def table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: spark.read.parquet(f"{folder}/{name}.parquet")


def on(name: str, work: Callable[[DataFrame], DataFrame], sql: str | None = None) -> Query:
    """A query that needs one table."""
    return Query(lambda spark, folder: work(spark.read.parquet(f"{folder}/{name}.parquet")), sql)


def all_queries() -> dict[str, Query]:
    from prepkit.registry import analysis, evaluation, preparation, sampling, selection, sources

    found: dict[str, Query] = {}
    for module in (analysis, preparation, selection, sampling, evaluation, sources):
        for name, query in module.QUERIES.items():
            if name in found:
                raise ValueError(f"Query '{name}' is registered twice.")
            found[name] = query
    return found
