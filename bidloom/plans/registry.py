"""All queries of the core, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bidloom.plans import analogs, portal, problems


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**problems.QUERIES, **portal.QUERIES, **analogs.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**problems.ORACLES, **portal.ORACLES, **analogs.ORACLES}
