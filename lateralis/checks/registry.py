"""Registry of checked queries and the tables they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def check(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must give the same rows."""

    def register(query: Query) -> Query:
        _queries[query.__name__] = query
        if sql is not None:
            _oracles[query.__name__] = sql
        return query

    return register


def all_queries() -> dict[str, Query]:
    return dict(_queries)


def all_oracles() -> dict[str, str]:
    return dict(_oracles)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lines_with_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with the columns of their part: the stand-in for a table of wells."""
    lines, parts = table(spark, folder, "lineitem"), table(spark, folder, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).withColumn(
        "unit_cost", F.col("l_extendedprice") / F.col("l_quantity")
    )


LINES_WITH_PARTS = """(
    SELECT *, l_extendedprice / l_quantity AS unit_cost FROM lineitem JOIN part ON l_partkey = p_partkey)"""
