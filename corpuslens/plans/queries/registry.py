"""Registration of queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def r6(value: Column | str) -> Column:
    """Six decimals, for comparing floating-point results across engines."""
    return F.round(F.col(value) if isinstance(value, str) else value, 6)
