"""Registry of queries and helpers shared by them and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL twin when it has one."""

    def register(function: Query) -> Query:
        name = function.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sql_hash_key(*operands: str) -> str:
    """SQL text of a vault hash key over the operands."""
    texts = ", ".join(f"coalesce(trim(cast({o} as varchar)), '')" for o in operands)
    return f"sha1(concat_ws(':', {texts}) || ':')"


def sql_hash_raw(*operands: str) -> str:
    """SQL text of a hash that skips NULLs and does not trim."""
    return f"sha1(concat_ws(':', {', '.join(f'cast({o} as varchar)' for o in operands)}) || ':')"


def sql_number_text(operand: str) -> str:
    """SQL text of a decimal without insignificant zeros, ``None`` for NULL."""
    return f"coalesce(rtrim(rtrim(cast({operand} as varchar), '0'), '.'), 'None')"
