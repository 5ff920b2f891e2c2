"""Naming an intermediate value inside a column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value evaluated once, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a costly column that is computed once per row. As a generator's output it cannot be
    copied into a later filter, which would run it a second time."""
    return df.select("*", F.explode_outer(F.array(value)).alias(name))
