"""Active / dead / total roll-up of member tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def executor_rollup(df: DataFrame, metrics: Sequence[str], active: str = "is_active",
                    flags: Sequence[str] = ()) -> DataFrame:
    """Three rows ``Active(n)``, ``Dead(n)`` and ``Total(n)`` with the sum of each metric.

    Missing metric values count as 0, boolean ``flags`` are counted. One pass over ``df`` with
    conditional sums, so all three rows exist even for an empty table.
    """
    alive = F.coalesce(F.col(active), F.lit(False))
    groups = {"Active": alive, "Dead": ~alive, "Total": F.lit(True)}
    values = {m: F.coalesce(F.col(m), F.lit(0)).cast("bigint") for m in metrics}
    values.update({f: F.when(F.col(f), 1).otherwise(0).cast("bigint") for f in flags})
    zero = F.lit(0).cast("bigint")
    sums = []
    for group, member in groups.items():
        sums.append(F.count_if(member).alias(f"{group}__members"))
        for name, value in values.items():
            sums.append(F.coalesce(F.sum(F.when(member, value)), zero).alias(f"{group}__{name}"))
    rows = [F.struct(
        F.concat(F.lit(f"{group}("), F.col(f"{group}__members").cast("string"), F.lit(")"))
        .alias("label"),
        F.col(f"{group}__members").alias("members"),
        *[F.col(f"{group}__{name}").alias(name) for name in values]) for group in groups]
    return df.agg(*sums).select(F.inline(F.array(*rows)))
