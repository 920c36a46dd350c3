"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.plans.sizing import bound_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def widened(df: DataFrame) -> DataFrame:
    """Integers as BIGINT, which is what counts and positions are in the oracle."""
    narrow = [name for name, kind in df.dtypes if kind == "int"]
    return df.withColumns({name: F.col(name).cast("long") for name in narrow}) if narrow else df


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder)`` under a name, with its oracle SQL if there is one."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            bound_batches(spark)
            return widened(fn(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
