"""Size checks that decide whether a side may be broadcast.

Each check is a small job over the candidate itself, cut off as soon as the
bound is passed, so a table that is too large costs little to find out.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bounds on what one executor is asked to hold for one join.
BROADCAST_ROWS = 200_000
BROADCAST_CHARS = 8_000_000
# Rows and bytes of an Arrow batch that suit whole texts and their words.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of this session within ``BATCHES``: what a worker holds depends on them, not on the input."""
    for name, most in BATCHES.items():
        spark.conf.set(name, str(most))


@contextmanager
def rows_read_at_once(spark: SparkSession, most: int) -> Iterator[None]:
    """Parquet files give at most so many rows at once to the jobs run inside, for rows that are large."""
    name = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def row_count_within(df: DataFrame, bound: int) -> int | None:
    """The number of rows, or None when it is over the bound."""
    n = df.limit(bound + 1).count()
    return n if n <= bound else None


def chars_within(df: DataFrame, column: str, bound: int = BROADCAST_CHARS) -> bool:
    """Whether the column's total length stays within the bound."""
    total = df.agg(F.sum(F.length(column).cast("long"))).first()[0]
    return (total or 0) <= bound


def join_dimension(facts: DataFrame, dimension: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a lookup table, broadcasting it only after its size was checked.

    Past the bound the join is left to the planner, whose adaptive skew handling
    splits a key that dominates the fact side.
    """
    if row_count_within(dimension, BROADCAST_ROWS) is not None:
        dimension = F.broadcast(dimension)
    return facts.join(dimension, on, how)
