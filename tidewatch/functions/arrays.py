"""Functions over array elements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def array_map(values: Column, function: Callable[[Column], Column]) -> Column:
    """Apply a Column function to every element."""
    return F.transform(values, function)


def square(value: Column) -> Column:
    return value * value


def multiplied_by(factor: float) -> Callable[[Column], Column]:
    """A function that multiplies by ``factor``, for use with ``array_map``."""
    return lambda value: value * factor


#: Numbers that one row is expanded to at a time.
AT_ONCE = 100_000


def count_up(df: DataFrame, low: Column, high: Column, name: str, at_once: int = AT_ONCE) -> DataFrame:
    """A row for each whole number from ``low`` to ``high`` per row of ``df``; none if there is no such.

    A row is cut into blocks first, which are dealt to tasks; so neither an array nor a task holds
    all numbers of a long span.
    """
    spans = df.withColumns({"__low": low.cast("bigint"), "__high": high.cast("bigint")}).filter("__low <= __high")
    blocks = spans.withColumn("__block", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.expr(f"(__high - __low) div {at_once}"))))
    first = F.col("__low") + F.col("__block") * at_once
    return (blocks.repartition("__low", "__block").withColumn(name, F.explode(F.sequence(
        first, F.least(first + (at_once - 1), F.col("__high"))))).drop("__low", "__high", "__block"))
