"""How queries are registered: by name, with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .derived import Tables, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of ``Tables`` under a name; ``sql`` may name given and derived tables as {name}."""

    def register(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: function(Tables(spark, sf_dir))
        if sql:
            ORACLES[name] = oracle(sql)
        return function

    return register
