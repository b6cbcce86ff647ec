"""Listing orders: typed text sort, application ids, attempts, timelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import SCRIPT_SPACE

# Patterns that decide the type of a text column.
NUMERIC_TEXT = r"^-?[£$¤]?[\d,.]+%?$"
DATE_TEXT = r"^(\d\d?)[/.-](\d\d?)[/.-]((\d\d)?\d\d)$"

# Fixed value: digits an application number is padded to.
APP_NUMBER_WIDTH = 10


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SCRIPT_SPACE}|{SCRIPT_SPACE}$", "")


def _date_part(text: Column, group: int) -> Column:
    return F.regexp_extract(text, DATE_TEXT, group)


def guess_text_type(df: DataFrame, column: str, order: Sequence[str]) -> str:
    """``numeric``, ``ddmm``, ``mmdd`` or ``alpha`` from the first telling row.

    A number decides, and so does a date with one part over 12. Dates that could be either make the
    column day-first unless a later row decides. One aggregate over the column; its single
    result row comes to the driver.
    """
    # The text is trimmed once, as a column of its own.
    df = df.select(*order, _trimmed(F.col(column)).alias("__text"))
    text = F.col("__text")
    first = _date_part(text, 1).try_cast("int")
    second = _date_part(text, 2).try_cast("int")
    is_date = text.rlike(DATE_TEXT)
    decided = (F.when(text.rlike(NUMERIC_TEXT), "numeric")
               .when(is_date & (first > 12), "ddmm").when(is_date & (second > 12), "mmdd"))
    row = df.agg(
        F.min(F.when(decided.isNotNull(), F.struct(*order, decided.alias("__type"))))
        .alias("first"),
        F.max(is_date.cast("int")).alias("dates")).first()
    if row["first"] is not None:
        return row["first"]["__type"]
    return "ddmm" if row["dates"] else "alpha"


def typed_sort_key(column: Column, kind: str) -> Column:
    """What rows are compared by under a text type; text that is no number counts as 0."""
    text = _trimmed(column)
    if kind == "numeric":
        digits = F.regexp_replace(text, r"[^0-9.\-]", "")
        return F.coalesce(F.regexp_extract(digits, r"^-?(\d+\.?\d*|\.\d+)", 0)
                          .try_cast("double"), F.lit(0.0))
    if kind in ("ddmm", "mmdd"):
        day, month = (1, 2) if kind == "ddmm" else (2, 1)
        return F.when(text.rlike(DATE_TEXT), F.concat(
            _date_part(text, 3), F.lpad(_date_part(text, month), 2, "0"),
            F.lpad(_date_part(text, day), 2, "0")))
    return F.lower(text)


def with_sort_key(df: DataFrame, column: str, order: Sequence[str], name: str = "sort_key") -> DataFrame:
    """``df`` with what its rows are compared by under the text type of ``column``, as a column: a sort
    that passes rows several times then reads the key and does not take the text apart each time."""
    kind = guess_text_type(df, column, order)
    return df.withColumn(name, typed_sort_key(F.col(column), kind))


def typed_text_order(df: DataFrame, column: str, order: Sequence[str]) -> list[Column]:
    """Sort columns for a text column; equal rows keep their ``order``."""
    kind = guess_text_type(df, column, order)
    return [typed_sort_key(F.col(column), kind).asc(), *[F.col(o).asc() for o in order]]


def app_sort_key(app_id: Column) -> Column:
    """Application id with its number padded to ten digits; ids with fewer parts as they are."""
    parts = F.split(app_id, "_")
    number = F.element_at(parts, 3)
    padded = (F.when(F.length(number) < APP_NUMBER_WIDTH,
                     F.lpad(number, APP_NUMBER_WIDTH, "0")).otherwise(number))
    return (F.when(F.size(parts) < 3, app_id)
            .otherwise(F.concat_ws("_", F.element_at(parts, 1), F.element_at(parts, 2), padded)))


def attempts_completed(apps: DataFrame, completed: bool, attempts: str = "attempts") -> DataFrame:
    """One row per attempt of the applications whose **first** attempt is (not) completed."""
    first = F.element_at(F.col(attempts), 1)["completed"]
    kept = [c for c in apps.columns if c != attempts]
    return (apps.filter((F.size(attempts) > 0) & (first == completed))
            .select(*kept, F.size(attempts).alias("num_attempts"),
                    F.posexplode(attempts).alias("position", "attempt"))
            .select(*kept, "num_attempts", "position", "attempt.*"))


def listing_order(completed: bool, start: str = "start_time", end: str = "end_time",
                  tie: str = "id") -> list[Column]:
    """Completed lists by completion, running lists by start, newest first."""
    return [F.col(end if completed else start).desc(), F.col(tie).asc()]


def timeline_order(group: str, start: str, tie: str) -> list[Column]:
    """Items by the numeric value of their group, then by start."""
    return [F.col(group).try_cast("double").asc(), F.col(start).asc(), F.col(tie).asc()]


def timeline_axis(df: DataFrame, scope: Sequence[str], start: str, finish: str) -> DataFrame:
    return df.groupBy(*scope).agg(F.min(start).alias("axis_min"),
                                  F.max(finish).alias("axis_max"))
