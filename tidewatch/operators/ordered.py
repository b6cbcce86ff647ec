"""Order-dependent columns that stay correct and balanced when one key holds most rows.

A plain window puts all rows of a key into one task. ``Ordered`` measures the largest key first.
If every key fits one task it uses plain windows. Otherwise the rows are range partitioned by
(keys, order), so a large key covers as many partitions as its size needs, and are written once.
Windows then run per (key, partition), and each partition receives what came before it (or
after it) through a carry table. Rows are sorted by key, so at most one key reaches into a
partition from the previous one: the carry table has no more rows than there are partitions,
which is what makes its broadcast safe.

The order columns should end in a unique column; rows equal in all of them stay together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import MAX_CHUNKS, rows_per_task, written

CHUNK = "__chunk"
EDGE = "__edge"
CARRY = "__carry"
LOCAL = "__local"


def _columns(order: Sequence[str | Column]) -> list[Column]:
    """Sort columns; a name may end in `` desc``."""
    return [_sorted_by(o, False) if isinstance(o, str) else o for o in order]


def _sorted_by(name: str, reverse: bool) -> Column:
    column = F.col(name.removesuffix(" desc"))
    return column.desc() if name.endswith(" desc") != reverse else column.asc()


def _reversed(order: Sequence[str | Column]) -> list[Column]:
    if not all(isinstance(o, str) for o in order):
        raise TypeError("looking at the rows that follow needs an order given by names")
    return [_sorted_by(o, True) for o in order]


def largest_group(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """(total rows, rows of the largest key); counts are combined before the shuffle."""
    if not keys:
        total = df.count()
        return total, total
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    row = sizes.agg(F.sum("n").alias("total"), F.max("n").alias("largest")).first()
    return row["total"] or 0, row["largest"] or 0


def split_by_order(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   total: int, limit: int) -> DataFrame:
    """Rows range partitioned by (keys, order) with their partition number, written once."""
    parts = min(max(2, -(-total // limit)), MAX_CHUNKS)
    spread = df.repartitionByRange(parts, *[F.col(k).asc() for k in keys], *_columns(order))
    return written(spread.withColumn(CHUNK, F.spark_partition_id()))


class Ordered:
    """Running values, neighbours and row numbers within ``keys`` in the given order."""

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                 limit: int | None = None, bound: tuple[DataFrame, int] | None = None):
        """``bound`` is a cheaper frame with the same keys: a key of ``df`` has at most its rows
        times the given factor. Only if that is too much is ``df`` itself counted.
        """
        self.keys = list(keys)
        self.order = list(order)
        limit = limit or rows_per_task(df.sparkSession)
        self.spread = False
        self.rows = df
        if bound is not None and largest_group(bound[0], self.keys)[1] * bound[1] <= limit:
            return
        total, largest = largest_group(df, self.keys)
        if largest > limit:
            self.spread = True
            self.rows = split_by_order(df, self.keys, order, total, limit)

    @property
    def df(self) -> DataFrame:
        return self.rows.drop(CHUNK) if self.spread else self.rows

    def with_column(self, name: str, value: Column) -> "Ordered":
        """Add a row-wise column."""
        self.rows = self.rows.withColumn(name, value)
        return self

    def row_number(self, name: str) -> "Ordered":
        if self.spread:
            # What came before a partition is a count, which needs no sort of its rows.
            across = Window.partitionBy(*self.keys).orderBy(F.col(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
            counts = self.rows.groupBy(*self.keys, CHUNK).agg(F.count(F.lit(1)).alias("__n"))
            carry = written(counts.withColumn(CARRY, F.sum("__n").over(across)).filter(F.col(CARRY).isNotNull())
                            .select(*self.keys, CHUNK, CARRY))
            rows = self.rows.withColumn(LOCAL, F.row_number().over(self._window()).cast("bigint"))
            self.rows = (self._join_carry(rows, carry)
                         .withColumn(name, _combine(F.sum, F.col(LOCAL), F.col(CARRY))).drop(LOCAL, CARRY))
            return self
        self.rows = self.rows.withColumn(
            name, F.row_number().over(self._window()).cast("bigint"))
        return self

    def running(self, name: str, aggregate, value: Column, following: bool = False) -> "Ordered":
        """``aggregate`` of ``value`` from the key's first row to this one.

        With ``following`` it runs from this row to the key's last one. ``aggregate`` is
        ``F.sum``, ``F.min`` or ``F.max``.
        """
        return self._scan(name, aggregate, value, following,
                          lambda local, carry: _combine(aggregate, local, carry))

    def last_known(self, name: str, value: Column) -> "Ordered":
        """Last non-null ``value`` up to and including this row."""
        return self._scan(name, lambda c: F.last(c, ignorenulls=True), value, False,
                          lambda local, carry: F.coalesce(local, carry))

    def next_known(self, name: str, value: Column) -> "Ordered":
        """First non-null ``value`` from this row on."""
        return self._scan(name, lambda c: F.last(c, ignorenulls=True), value, True,
                          lambda local, carry: F.coalesce(local, carry))

    def previous(self, name: str, value: Column) -> "Ordered":
        """``value`` of the row before (null on the key's first row)."""
        return self._neighbour(name, value, F.lag, following=False)

    def next(self, name: str, value: Column) -> "Ordered":
        """``value`` of the row after (null on the key's last row)."""
        return self._neighbour(name, value, F.lead, following=True)

    def _window(self, backwards: bool = False) -> WindowSpec:
        keys = self.keys + [CHUNK] if self.spread else self.keys
        order = _reversed(self.order) if backwards else _columns(self.order)
        return Window.partitionBy(*keys).orderBy(*order)

    def _scan(self, name, aggregate, value, following, combine) -> "Ordered":
        # Rows that follow are read in the reversed order: a frame that grows with each row is
        # one pass, a frame that shrinks is evaluated anew for every row.
        window = self._window(backwards=following)
        local = aggregate(value).over(
            window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        if not self.spread:
            self.rows = self.rows.withColumn(name, local)
            return self
        rows = self.rows.withColumn(LOCAL, local)
        carry = self._carry(rows, following, F.col(LOCAL), aggregate)
        self.rows = (self._join_carry(rows, carry)
                     .withColumn(name, combine(F.col(LOCAL), F.col(CARRY)))
                     .drop(LOCAL, CARRY))
        return self

    def _neighbour(self, name, value, shift, following) -> "Ordered":
        window = self._window()
        if not self.spread:
            self.rows = self.rows.withColumn(name, shift(value).over(window))
            return self
        rows = (self.rows.withColumn(LOCAL, F.struct(value.alias("v")))
                .withColumn("__side", shift(F.col(LOCAL)).over(window)))
        carry = self._carry(rows, following, F.col(LOCAL), None)
        self.rows = (self._join_carry(rows, carry)
                     .withColumn(name, F.coalesce(F.col("__side"), F.col(CARRY))["v"])
                     .drop(LOCAL, CARRY, "__side"))
        return self

    def _carry(self, rows, following, value, aggregate) -> DataFrame:
        """What each partition receives from the others: at most one row per partition."""
        edge = F.lag if following else F.lead
        ends = (rows.withColumn(EDGE, edge(F.lit(1)).over(self._window()))
                .filter(F.col(EDGE).isNull())
                .select(*self.keys, CHUNK, value.alias("__value")))
        chunk = F.col(CHUNK).desc() if following else F.col(CHUNK).asc()
        across = Window.partitionBy(*self.keys).orderBy(chunk)
        if aggregate is None:
            received = F.lag("__value").over(across)
        else:
            received = aggregate(F.col("__value")).over(
                across.rowsBetween(Window.unboundedPreceding, -1))
        return written(ends.withColumn(CARRY, received).filter(F.col(CARRY).isNotNull())
                       .select(*self.keys, CHUNK, CARRY))

    def _join_carry(self, rows: DataFrame, carry: DataFrame) -> DataFrame:
        names = self.keys + [CHUNK]
        side = carry.select(*[F.col(n).alias(f"__c_{n}") for n in names], CARRY)
        matches = F.lit(True)
        for n in names:
            matches = matches & F.col(n).eqNullSafe(F.col(f"__c_{n}"))
        return (rows.join(F.broadcast(side), matches, "left")
                .drop(*[f"__c_{n}" for n in names]))


def _combine(aggregate, local: Column, carry: Column) -> Column:
    if aggregate is F.sum:
        return F.when(carry.isNull(), local).otherwise(F.coalesce(local, F.lit(0)) + carry)
    if aggregate is F.min:
        return F.least(local, carry)
    if aggregate is F.max:
        return F.greatest(local, carry)
    raise ValueError("aggregate must be F.sum, F.min or F.max")
