"""Evaluate an expensive expression once.

Catalyst copies a derived column's expression into every filter it pushes below
the projection, and into every place that uses it. For parsed events and bounded
texts that would parse or scan the same bytes many times over.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters and projections read but do not recompute.

    The row passes a one-row ``inline``, which filters are not pushed through.
    Columns of the same name are replaced.
    """
    kept = [name for name in df.columns if name not in columns]
    row = F.struct(*[value.alias(f"__{name}") for name, value in columns.items()])
    added = df.select("*", F.inline(F.array(row)))
    return added.select(*kept, *[F.col(f"__{name}").alias(name) for name in columns])


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]
