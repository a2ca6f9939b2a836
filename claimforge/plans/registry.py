"""Queries over the testbed's tables and their DuckDB SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimforge.plans.testbed import Tables, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under ``name``, with the SQL it must agree with."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return f

    return add
