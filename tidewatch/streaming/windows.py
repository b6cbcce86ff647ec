"""Windowed stream aggregates; the batch functions in ``operators.liveness`` take streams too."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sessions(stream: DataFrame, member: str, ts: str, timeout: str) -> DataFrame:
    """Gap sessions; one comes out once the watermark has passed its end.

    A silence equal to the timeout does not end a session.
    """
    return (stream.groupBy(member, F.session_window(ts, timeout).alias("w"))
            .agg(F.min(ts).alias("start"), F.max(ts).alias("last_seen"),
                 F.count(F.lit(1)).alias("beats"))
            .select(member, "start", "last_seen", "beats"))


def register_dedup(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First registration per id; state is kept as long as the watermark delay."""
    return stream.dropDuplicatesWithinWatermark(list(keys))
