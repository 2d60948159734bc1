"""Registration of checkable queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetcheck.tables import Fleet, fleet_of, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query over the fleet; without SQL the check is on rows only."""
    def register(build: Callable[[Fleet], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(fleet_of(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return build
    return register
