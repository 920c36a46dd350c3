"""Evaluate an expression once and use it several times.

The optimizer moves filters below projections and generators by copying the
expression they test, the size filter it infers for ``explode`` included. For
cheap expressions that is a gain; for text work it doubles the job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed a single time.

    Composing Columns in Python copies the whole tree at every use, so a chain
    of steps that each look at their input twice doubles with every step. A
    one-element ``transform`` binds the input to a lambda variable instead.
    """
    return F.transform(F.array(value), body).getItem(0)


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` plus columns that later filters read but never recompute."""
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline_outer(F.array(values)))


def explode_once(df: DataFrame, keep: list, items: Column, name: str) -> DataFrame:
    """``keep`` and one row per item; null and empty arrays give no rows.

    Items themselves must not be null.
    """
    return df.select(*keep, F.explode_outer(items).alias(name)).filter(F.col(name).isNotNull())
