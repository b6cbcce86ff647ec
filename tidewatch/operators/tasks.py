"""Summaries of task, stage, job and executor tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Name of an unknown stage, least parallelism.
UNKNOWN_STAGE = "(Unknown Stage Name)"
MIN_PARALLELISM = 2


def outcome_class(reason: Column) -> Column:
    """``Success`` completes a task, a kill or a denied commit kills it, all else fails it."""
    return (F.when(reason == "Success", "completed")
            .when(reason.isin("TaskKilled", "TaskCommitDenied"), "killed")
            .when(reason.isNotNull(), "failed"))


def task_outcomes(df: DataFrame, group: Sequence[str], reason: str = "reason") -> DataFrame:
    """Tasks per outcome; a null reason is a task that has not ended."""
    outcome = outcome_class(F.col(reason))
    return df.groupBy(*group).agg(
        F.count_if(outcome == "completed").alias("completed"),
        F.count_if(outcome == "failed").alias("failed"),
        F.count_if(outcome == "killed").alias("killed"),
        F.count_if(F.col(reason).isNull()).alias("active"))


def packed_index(stage: Column, index: Column) -> Column:
    """Stage id in the upper and task index in the lower half of one long."""
    return F.shiftleft(stage.cast("bigint"), 32).bitwiseOR(index.cast("bigint"))


def distinct_indices(df: DataFrame, group: Sequence[str], ok: Column, index: Column,
                     approximate: bool = False) -> DataFrame:
    """Distinct completed task indices per group."""
    value = F.when(ok, index)
    count = F.approx_count_distinct(value) if approximate else F.count_distinct(value)
    return df.groupBy(*group).agg(count.alias("distinct_indices"))


def count_by(df: DataFrame, group: Sequence[str], label: str, keep: Column | None = None
             ) -> DataFrame:
    """Rows per (group, label) in long form, e.g. kills per reason or launches per locality."""
    rows = df if keep is None else df.filter(keep)
    return rows.groupBy(*group, label).agg(F.count(F.lit(1)).alias("n"))


def killed_reasons(df: DataFrame, group: Sequence[str], reason: str = "reason",
                   detail: str = "kill_reason", error: str = "error_text") -> DataFrame:
    """Kills per reason; a denied commit counts under its error text."""
    text = (F.when(F.col(reason) == "TaskKilled", F.col(detail))
            .when(F.col(reason) == "TaskCommitDenied", F.col(error)))
    return count_by(df.withColumn("killed_reason", text), group, "killed_reason",
                    outcome_class(F.col(reason)) == "killed")


def first_launch(df: DataFrame, group: Sequence[str], launch: str = "launch_time") -> DataFrame:
    return df.groupBy(*group).agg(F.min(launch).alias("first_launch"))


def metric_sums(df: DataFrame, group: Sequence[str], metrics: Sequence[str],
                outcome: str | None = None, time: str | None = None) -> DataFrame:
    """Sum of each metric per group, optionally with task time and tasks per outcome."""
    columns = [F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m) for m in metrics]
    if time:
        columns.append(F.sum(time).cast("bigint").alias("task_time"))
    if outcome:
        columns += [F.count_if(F.col(outcome) == o).alias(n) for o, n in (
            ("completed", "succeeded_tasks"), ("failed", "failed_tasks"),
            ("killed", "killed_tasks"))]
    return df.groupBy(*group).agg(*columns)


def executor_totals(df: DataFrame, executor: str, reason: str, duration: str,
                    metrics: Mapping[str, Column]) -> DataFrame:
    """Task counts, durations and metric sums per executor.

    Resubmitted ends count as tasks but their metrics are left out, since the first attempt's
    metrics already stand for the task.
    """
    outcome = outcome_class(F.col(reason))
    first = F.coalesce(F.col(reason) != "Resubmitted", F.lit(False))
    sums = [F.coalesce(F.sum(F.when(first, value)), F.lit(0)).cast("bigint").alias(name)
            for name, value in metrics.items()]
    return df.groupBy(executor).agg(
        F.count_if(F.col(reason).isNull()).alias("active_tasks"),
        F.count_if(outcome == "completed").alias("completed_tasks"),
        F.count_if(outcome == "failed").alias("failed_tasks"),
        F.count(F.lit(1)).alias("total_tasks"),
        F.sum(F.when(F.col(reason).isNotNull(), F.col(duration))).cast("bigint")
        .alias("total_duration"), *sums)


def job_start_totals(jobs: DataFrame, stages: DataFrame, job: str = "job_id",
                     stage: str = "stage_id", name: str = "name", tasks: str = "num_tasks",
                     completed: str = "completion_time") -> DataFrame:
    """Open tasks, number of stages and display name per job.

    The estimate leaves out stages that already have a completion time; a job is named after its
    highest stage.
    """
    totals = stages.groupBy(job).agg(
        F.sum(F.when(F.col(completed).isNull(), F.col(tasks))).alias("open_tasks"),
        F.count(F.lit(1)).alias("num_stages"), F.max_by(name, stage).alias("job_name"))
    zero = F.lit(0).cast("bigint")
    return (jobs.join(totals, job, "left")
            .withColumn("open_tasks", F.coalesce("open_tasks", zero))
            .withColumn("num_stages", F.coalesce("num_stages", zero))
            .withColumn("job_name", F.coalesce("job_name", F.lit(UNKNOWN_STAGE))))


def app_summary(jobs: DataFrame, stages: DataFrame, scope: str, status: str = "status"
                ) -> DataFrame:
    """Succeeded jobs and completed stages per application."""
    zero = F.lit(0).cast("bigint")
    done = (jobs.select(scope, (F.col(status) == "SUCCEEDED").cast("bigint").alias("j"),
                        zero.alias("s"))
            .unionByName(stages.select(scope, zero.alias("j"),
                                       (F.col(status) == "COMPLETE").cast("bigint").alias("s"))))
    return done.groupBy(scope).agg(F.sum("j").alias("completed_jobs"),
                                   F.sum("s").alias("completed_stages"))


def stage_details(tasks: DataFrame, stage: Sequence[str], task: Sequence[str], executor: str,
                  value: str) -> DataFrame:
    """Every task and every executor summary of a stage in long form.

    One row per nested entry instead of one map per stage: a stage may have more tasks than a
    single row can hold.
    """
    as_text = F.concat_ws("/", *[F.col(c).cast("string") for c in task])
    single = tasks.select(*stage, F.lit("task").alias("entry"), as_text.alias("entry_key"),
                          F.col(value).alias("value"))
    summary = tasks.groupBy(*stage, executor).agg(F.sum(value).alias("value")).select(
        *stage, F.lit("executor").alias("entry"), F.col(executor).cast("string")
        .alias("entry_key"), "value")
    return single.unionByName(summary)


def stage_sizes(tasks: DataFrame, stage: Sequence[str], executor: str) -> DataFrame:
    """Number of tasks and of executor summaries per stage."""
    return tasks.groupBy(*stage).agg(F.count(F.lit(1)).alias("num_tasks"),
                                     F.count_distinct(executor).alias("num_executors"))


def host_containers(assigned: DataFrame, finished: DataFrame, host: str = "host_id",
                    container: str = "container_id") -> DataFrame:
    """(host, container) pairs still in place; a host without any disappears."""
    return (assigned.select(host, container).distinct()
            .join(finished.select(container).distinct(), container, "left_anti"))


def containers_per_host(pairs: DataFrame, host: str = "host_id", container: str = "container_id"
                        ) -> DataFrame:
    return pairs.groupBy(host).agg(F.count_distinct(container).alias("containers"))


def slot_capacity(members: DataFrame, scope: Sequence[str], cores: str, cpus_per_task: int
                  ) -> DataFrame:
    """Concurrent tasks and default parallelism per scope."""
    if cpus_per_task <= 0:
        raise ValueError("cpus_per_task must be positive")
    slots = F.floor(F.col(cores) / cpus_per_task).cast("bigint")
    return members.groupBy(*scope).agg(
        F.sum(slots).alias("slots"),
        F.greatest(F.sum(F.col(cores).cast("bigint")), F.lit(MIN_PARALLELISM).cast("bigint"))
        .alias("default_parallelism"))


def all_nodes_excluded(excluded: DataFrame, nodes: DataFrame, scope: str, node: str) -> DataFrame:
    """Per scope whether at least as many nodes are excluded as exist."""
    zero = F.lit(0).cast("bigint")
    bad = excluded.groupBy(scope).agg(F.count_distinct(node).alias("excluded_nodes"))
    return (nodes.groupBy(scope).agg(F.count_distinct(node).alias("nodes"))
            .join(bad, scope, "left")
            .withColumn("excluded_nodes", F.coalesce("excluded_nodes", zero))
            .withColumn("all_excluded", F.col("excluded_nodes") >= F.col("nodes")))


def pending_by_location(requests: DataFrame, host: str, rack: str, amount: str) -> DataFrame:
    """Open requests per host, per rack and in total (location ``*``)."""
    grouped = (requests.groupingSets([[F.col(host)], [F.col(rack)], []], F.col(host), F.col(rack))
               .agg(F.sum(amount).cast("bigint").alias("pending"),
                    F.grouping_id().alias("__level")))
    level = F.col("__level")
    return grouped.select(
        F.when(level == 1, "host").when(level == 2, "rack").otherwise("any").alias("tier"),
        F.when(level == 1, F.col(host).cast("string"))
        .when(level == 2, F.col(rack).cast("string")).otherwise("*").alias("location"),
        "pending")
