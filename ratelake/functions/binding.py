"""Name an intermediate value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also inside lambdas, where
    the planner does not share subexpressions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters and projections never compute again.

    The optimizer pushes filters through projections by repeating their
    expressions; it does not push them through a generator, so the value passes
    through a one-element outer explode.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))
