"""Keyed state as DataFrames: last write wins, deletes, point reads, counts per index value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import small_side


def latest_by_key(df: DataFrame, keys: Sequence[str], seq: str | Sequence[str]) -> DataFrame:
    """The last row per key in ``seq`` order (later columns break ties).

    The ``= 1`` on a row number lets Spark keep one candidate per key on the map side
    (WindowGroupLimit), so a key with most of the rows sends one row per task into the shuffle.
    """
    order = [seq] if isinstance(seq, str) else list(seq)
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return (df.withColumn("__rn", F.row_number().over(newest))
            .filter(F.col("__rn") == 1).drop("__rn"))


def first_by_key(df: DataFrame, keys: Sequence[str], seq: str | Sequence[str]) -> DataFrame:
    """The first row per key, with the same map-side limit as ``latest_by_key``."""
    order = [seq] if isinstance(seq, str) else list(seq)
    oldest = Window.partitionBy(*keys).orderBy(*[F.col(c).asc() for c in order])
    return (df.withColumn("__rn", F.row_number().over(oldest))
            .filter(F.col("__rn") == 1).drop("__rn"))


def apply_changes(df: DataFrame, keys: Sequence[str], seq: str | Sequence[str],
                  op_col: str = "op", delete: str = "delete") -> DataFrame:
    """Upserts and deletes folded to the surviving rows; deleting a missing key does nothing."""
    return latest_by_key(df, keys, seq).filter(F.col(op_col) != delete).drop(op_col)


def lookup(df: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per wanted key with ``found``; missing keys keep nulls and carry an ``error``."""
    present = df.withColumn("__present", F.lit(True))
    found = F.col("__present").isNotNull()
    return (wanted.join(present, list(keys), "left")
            .withColumn("found", found)
            .withColumn("error", F.when(~found, F.concat(
                F.lit("no such key: "),
                F.concat_ws(",", *[F.col(k).cast("string") for k in keys]))))
            .drop("__present"))


def count_type(df: DataFrame, type_col: str) -> DataFrame:
    return df.groupBy(type_col).agg(F.count(F.lit(1)).alias("n"))


def count_index_value(df: DataFrame, index: str, wanted: DataFrame) -> DataFrame:
    """Rows per wanted index value, 0 for an absent one."""
    counts = df.groupBy(index).agg(F.count(F.lit(1)).alias("n"))
    return (wanted.join(counts, index, "left")
            .withColumn("n", F.coalesce(F.col("n"), F.lit(0).cast("bigint"))))


def over_threshold(df: DataFrame, type_col: str, threshold: int) -> DataFrame:
    """Types whose row count exceeds the threshold, with the count."""
    return count_type(df, type_col).filter(F.col("n") > threshold)


def subscribed(quotes: DataFrame, subscriptions: DataFrame, client: str = "client",
               seq: str | Sequence[str] = "seq", securities: str = "securities",
               security: str = "security", on: Sequence[str] = ("security",)) -> DataFrame:
    """Quotes of every currently subscribed security.

    A client's newest subscription replaces its older ones. ``on`` may include the client column
    if each quote belongs to one client's feed.
    """
    wanted = (latest_by_key(subscriptions, [client], seq)
              .select(client, F.explode(F.array_distinct(F.col(securities))).alias(security))
              .select(*on).distinct())
    if not wanted.isStreaming and small_side(wanted):
        wanted = F.broadcast(wanted)
    return quotes.join(wanted, list(on), "left_semi")
