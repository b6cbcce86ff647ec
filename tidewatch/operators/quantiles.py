"""Exact nearest-rank quantiles per group, and reuse of stored ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import rows_per_task, written
from .ordered import Ordered, largest_group


def valid_tasks(df: DataFrame, group: Sequence[str], run_time: str) -> DataFrame:
    """Tasks per group that have metrics, i.e. a run time of at least 0; none means no row."""
    return (df.filter(F.col(run_time) >= 0).groupBy(*group)
            .agg(F.count(F.lit(1)).alias("task_count")))


def quantile_index(q: Column, count: Column) -> Column:
    return F.least(F.floor(q * count).cast("bigint"), count - 1)


def metric_quantiles(df: DataFrame, group: Sequence[str], metrics: Sequence[str],
                     quantiles: Sequence[float], run_time: str) -> DataFrame:
    """Rows (group, metric, quantile, task_count, value).

    The value is the one at index ``min(floor(q * n), n - 1)`` of the ascending non-negative
    values, with ``n`` from the run time; NaN where a metric has fewer values. Groups that fit a
    task are ranked in one shuffle. Beyond that equal values are counted first, so that no
    single value is hot, and the distinct values of a group are ranked by several tasks.
    """
    counts = valid_tasks(df, group, run_time)
    value = F.col("value")
    values = df.select(*group, F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        for m in metrics]))).filter(value >= 0)
    total, largest = largest_group(df, group)
    limit = rows_per_task(df.sparkSession)
    if largest <= limit:
        # As many tasks as the rows need, or a shuffle has: a task's sort grows no more with the table.
        tasks = -(-total * len(metrics) // limit)
        if tasks > 1:
            tasks = max(tasks, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
            values = values.repartition(tasks, *group, "metric")
        rank = F.row_number().over(Window.partitionBy(*group, "metric").orderBy("value"))
        ranked = values.withColumn("__upto", rank.cast("bigint")).withColumn(
            "__n", F.lit(1).cast("bigint"))
    else:
        histogram = values.groupBy(*group, "metric", "value").agg(
            F.count(F.lit(1)).alias("__n"))
        ranked = Ordered(histogram, [*group, "metric"], ["value"]).running(
            "__upto", F.sum, F.col("__n")).df
    grid = F.array(*[F.lit(float(q)) for q in sorted(set(quantiles))])
    upto = F.col("__upto")

    def falls_here(q: Column) -> Column:
        index = quantile_index(q, F.col("task_count"))
        return (index >= upto - F.col("__n")) & (index < upto)

    found = (ranked.join(counts, list(group))
             .select(*group, "metric", "value",
                     F.explode(F.filter(grid, falls_here)).alias("quantile")))
    wanted = (counts.withColumn("metric", F.explode(F.array(*[F.lit(m) for m in metrics])))
              .withColumn("quantile", F.explode(grid)))
    return (wanted.join(found, [*group, "metric", "quantile"], "left")
            .select(*group, "metric", "quantile", "task_count",
                    F.coalesce("value", F.lit(float("nan"))).alias("value")))


def quantile_key(q: float) -> int:
    """Storage key of a quantile: hundredths, rounded half up."""
    return int(q * 100 + 0.5)


def storable(q: float) -> bool:
    return quantile_key(q) % 5 == 0


def to_stored(result: DataFrame, group: Sequence[str]) -> DataFrame:
    """The rows of a result worth keeping for reuse, keyed by hundredths."""
    key = F.floor(F.col("quantile") * 100 + 0.5).cast("int")
    return (result.withColumn("quantile_key", key).filter(F.col("quantile_key") % 5 == 0)
            .select(*group, "metric", "quantile_key", "task_count", "value"))


def quantiles_with_reuse(df: DataFrame, stored: DataFrame, group: Sequence[str],
                         metrics: Sequence[str], quantiles: Sequence[float], run_time: str
                         ) -> DataFrame:
    """``metric_quantiles`` plus ``reused``; groups fully covered by ``stored`` are not ranked.

    Stored rows count only if their task count still matches. One missing quantile makes the
    whole group recompute. Two quantiles with the same hundredths share a stored row.
    """
    wanted = sorted(set(quantiles))
    counts = valid_tasks(df, group, run_time)
    if all(storable(q) for q in wanted):
        keys = F.array(*[F.struct(F.lit(quantile_key(q)).alias("quantile_key"),
                                  F.lit(float(q)).alias("quantile")) for q in wanted])
        needed = (counts.withColumn("__q", F.explode(keys)).select(*group, "task_count", "__q.*")
                  .withColumn("metric", F.explode(F.array(*[F.lit(m) for m in metrics]))))
        # A group has as many rows here as quantiles times metrics are wanted.
        have = F.count(F.lit(1)).over(Window.partitionBy(*group))
        reused = written(
            needed.join(stored, [*group, "metric", "quantile_key", "task_count"])
            .withColumn("__have", have).filter(F.col("__have") == len(wanted) * len(metrics))
            .select(*group, "metric", "quantile", "task_count", "value",
                    F.lit(True).alias("reused")))
        complete = reused.select(*group).distinct()
        rest = df.join(complete, list(group), "left_anti")
        fresh = metric_quantiles(rest, group, metrics, wanted, run_time)
        return reused.unionByName(fresh.withColumn("reused", F.lit(False)))
    return metric_quantiles(df, group, metrics, wanted, run_time).withColumn(
        "reused", F.lit(False))


def approximate_quantiles(df: DataFrame, group: Sequence[str], metric: str,
                          quantiles: Sequence[float], accuracy: int = 10_000) -> DataFrame:
    """One-pass sketch for interactive use; NOT equal to ``metric_quantiles``."""
    return (df.filter(F.col(metric) >= 0).groupBy(*group)
            .agg(F.percentile_approx(metric, list(quantiles), accuracy).alias("values")))
