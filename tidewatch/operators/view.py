"""The view API over a table: index sort, bounds, parent scope, paging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .ordered import Ordered

#: Rows up to which rows are taken with a top-k sort, which ends in one task; beyond it, by distributed
#: row numbers.
TOP_K_ROWS = 1_000


def sort_order(index: str | Sequence[str], keys: Sequence[str], reverse: bool = False
               ) -> list[Column]:
    """Sort by the index, then by the natural key; reversing turns both around."""
    names = [index] if isinstance(index, str) else list(index)
    names += [k for k in keys if k not in names]
    return [F.col(n).desc() if reverse else F.col(n).asc() for n in names]


def numbered(df: DataFrame, order: Sequence[str | Column], name: str = "rn") -> DataFrame:
    """Global row numbers from 1 without pulling the table into one task.

    A table beyond the row limit of a task is range partitioned by the order.
    """
    return Ordered(df, [], order).row_number(name).df


def page(df: DataFrame, order: Sequence[str | Column], skip: int = 0, max: int | None = None
         ) -> DataFrame:
    """Rows ``skip + 1`` to ``skip + max`` in the given order."""
    if skip < 0:
        raise ValueError("skip must not be negative")
    if max is not None and max <= 0:
        raise ValueError("max must be positive")
    columns = [F.col(o).asc() if isinstance(o, str) else o for o in order]
    if max is not None and skip + max <= TOP_K_ROWS:
        return df.orderBy(*columns).offset(skip).limit(max)
    if skip == 0 and max is None:
        return df.orderBy(*columns)
    wanted = F.col("__row") > skip
    if max is not None:
        wanted = wanted & (F.col("__row") <= skip + max)
    return (numbered(df, columns, "__row").filter(wanted).orderBy("__row").drop("__row"))


def view(df: DataFrame, index: str, keys: Sequence[str], first=None, last=None,
         reverse: bool = False, parent_index: str | None = None, parent=None,
         skip: int = 0, max: int | None = None) -> DataFrame:
    """Bounded, sorted, paged scan of one index.

    Bounds are inclusive. ``first`` is where the scan starts, so on a reversed view it is the
    upper bound. An index below a parent index needs a parent value, and a parent value needs
    such an index.
    """
    if parent is not None and parent_index is None:
        raise ValueError("the index has no parent index")
    if parent_index is not None and parent is None:
        raise ValueError("the index needs a parent value")
    rows = df if parent is None else df.filter(F.col(parent_index) == F.lit(parent))
    low, high = (last, first) if reverse else (first, last)
    if low is not None:
        rows = rows.filter(F.col(index) >= F.lit(low))
    if high is not None:
        rows = rows.filter(F.col(index) <= F.lit(high))
    return page(rows, sort_order(index, keys, reverse), skip, max)


def filter_status(df: DataFrame, statuses: Sequence[str] | None, key: str,
                  status: str = "status") -> DataFrame:
    """Rows with one of the statuses (all rows for an empty list), newest key first."""
    rows = df.filter(F.col(status).isin(*statuses)) if statuses else df
    return rows.orderBy(F.col(key).desc())


def active_only(df: DataFrame, only_active: bool, key: str, active: str = "is_active"
                ) -> DataFrame:
    """All members in key order, or the active ones in reverse key order."""
    if not only_active:
        return df.orderBy(F.col(key).asc())
    return df.filter(F.col(active)).orderBy(F.col(key).desc())


def cached_only(df: DataFrame, cached: str = "num_cached") -> DataFrame:
    return df.filter(F.col(cached) > 0)


def tail_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """The last ``n`` rows by key, in ascending key order."""
    if n <= TOP_K_ROWS:
        return df.orderBy(F.col(key).desc()).limit(n).orderBy(F.col(key).asc())
    return (numbered(df, [f"{key} desc"], "__row").filter(F.col("__row") <= n).drop("__row")
            .orderBy(F.col(key).asc()))


def batch_next(df: DataFrame, keys: Sequence[str], after: Sequence | None, n: int
               ) -> tuple[DataFrame, bool]:
    """The next ``n`` rows after the key ``after`` and whether more follow.

    Paging by key keeps each call a top-k scan, however far it has advanced.
    """
    if n <= 0:
        raise ValueError("batch size must be positive")
    rows = df
    if after is not None:
        rows = rows.filter(key_after(keys, after))
    order = [F.col(k).asc() for k in keys]
    if n < TOP_K_ROWS:
        found = written(rows.orderBy(*order).limit(n + 1))
        return found.orderBy(*order).limit(n), found.count() > n
    found = written(numbered(rows, order, "__row").filter(F.col("__row") <= n + 1))
    return (found.filter(F.col("__row") <= n).orderBy("__row").drop("__row"),
            not found.filter(F.col("__row") > n).isEmpty())


def key_after(keys: Sequence[str], after: Sequence) -> Column:
    """Lexicographic ``keys > after``."""
    beyond = F.lit(False)
    equal = F.lit(True)
    for name, value in zip(keys, after, strict=True):
        beyond = beyond | (equal & (F.col(name) > F.lit(value)))
        equal = equal & (F.col(name) == F.lit(value))
    return beyond


def row_search(df: DataFrame, text: str) -> DataFrame:
    """Rows with the text in any cell, ignoring case; an empty text keeps all rows."""
    if not text:
        return df
    needle = F.lit(text.lower())
    hit = F.lit(False)
    for name in df.columns:
        hit = hit | F.coalesce(F.contains(F.lower(F.col(name).cast("string")), needle),
                               F.lit(False))
    return df.filter(hit)


TASK_ORDERS = {
    "ID": ("task_key", False),
    "INCREASING_RUNTIME": ("run_time", False),
    "DECREASING_RUNTIME": ("run_time", True),
}


def task_page(tasks: DataFrame, stage, mode: str, keys: Sequence[str], stage_col: str = "stage_id",
              run_time: str = "run_time", skip: int = 0, max: int | None = None) -> DataFrame:
    """Tasks of one stage by id or by run time in either direction."""
    if mode not in TASK_ORDERS:
        raise ValueError(f"unknown task order {mode}")
    by_id = mode == "ID"
    index = keys[0] if by_id else run_time
    return view(tasks, index, keys, parent_index=stage_col, parent=stage,
                reverse=mode == "DECREASING_RUNTIME", skip=skip, max=max)


def report_kv(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Report columns to (label, value) rows; null or empty values read ``N/A``."""
    pairs = F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    return (df.select(*keys, F.inline(pairs))
            .withColumn("value", F.coalesce(F.nullif("value", F.lit("")), F.lit("N/A"))))
