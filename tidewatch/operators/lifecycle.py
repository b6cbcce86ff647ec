"""Folding events into member, stage, job, application and block tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keyed import apply_changes, latest_by_key
from .ordered import Ordered

# Default pool, states after which nothing follows.
DEFAULT_POOL = "default"
TERMINAL_STATES = ("FINISHED", "FAILED", "KILLED")

#: Slices that the events of a host are dealt to, where each meets all members.
SLICES = 32


def millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def member_lifecycle(events: DataFrame, member: str, ts: str, seq: str, kind: str, cores: str,
                     reason: str, cores_per_task: int = 1, add: str = "add",
                     remove: str = "remove") -> DataFrame:
    """One row per stay of a member: add time, remove time, reason, active flag, max tasks.

    Adding a live member again updates its cores but keeps its add time; removing an absent
    member does nothing; adding after a removal opens a new row.
    """
    is_remove = F.col(kind) == remove
    steps = Ordered(events.filter(F.col(kind).isin(add, remove)), [member], [ts, seq])
    steps.running("__ended", F.sum, is_remove.cast("bigint"))
    stay = F.col("__ended") - is_remove.cast("bigint")
    is_add = F.col(kind) == add
    order = F.when(is_add, F.struct(F.col(ts), F.col(seq)))
    stays = steps.df.withColumn("stay", stay).groupBy(member, "stay").agg(
        F.min(F.when(is_add, F.col(ts))).alias("add_time"),
        F.max(F.when(is_remove, F.col(ts))).alias("remove_time"),
        F.max(F.when(is_remove, F.col(reason))).alias("remove_reason"),
        F.max_by(cores, order).alias("total_cores"))
    return (stays.filter(F.col("add_time").isNotNull())
            .withColumn("is_active", F.col("remove_time").isNull())
            .withColumn("max_tasks", F.floor(F.col("total_cores") / cores_per_task)
                        .cast("bigint")).drop("stay"))


def stage_status(failure: Column, submitted: Column, completed: Column) -> Column:
    """Status of a stage from its failure reason, submission and completion time."""
    return (F.when(completed.isNotNull() & failure.isNotNull(), "FAILED")
            .when(completed.isNotNull() & submitted.isNotNull(), "COMPLETE")
            .when(completed.isNotNull(), "SKIPPED")
            .when(submitted.isNotNull(), "ACTIVE")
            .otherwise("PENDING"))


def job_status(succeeded: Column) -> Column:
    return (F.when(succeeded.isNull(), "RUNNING").when(succeeded, "SUCCEEDED")
            .otherwise("FAILED"))


def job_rollup(jobs: DataFrame, job_stages: DataFrame, job: str = "job_id",
               status: str = "status", tasks: str = "num_tasks", succeeded: str = "succeeded"
               ) -> DataFrame:
    """Stages per status and skipped tasks per job.

    ``job_stages`` has one row per (job, stage). Stages still pending when their job has ended
    (non-null ``succeeded``) count as skipped.
    """
    ended = F.col(succeeded).isNotNull()
    pending = F.col(status) == "PENDING"
    counts = job_stages.groupBy(job).agg(
        F.count_if(F.col(status) == "COMPLETE").alias("completed_stages"),
        F.count_if(F.col(status) == "SKIPPED").alias("__skipped"),
        F.count_if(F.col(status) == "FAILED").alias("failed_stages"),
        F.count_if(F.col(status) == "ACTIVE").alias("active_stages"),
        F.count_if(pending).alias("__pending"),
        F.sum(F.when(F.col(status) == "SKIPPED", F.col(tasks))).alias("__skipped_tasks"),
        F.sum(F.when(pending, F.col(tasks))).alias("__pending_tasks"))
    zero = F.lit(0).cast("bigint")

    def known(name: str) -> Column:
        return F.coalesce(F.col(name), zero)

    return jobs.join(counts, job, "left").select(
        job, job_status(F.col(succeeded)).alias("status"),
        known("completed_stages").alias("completed_stages"),
        (known("__skipped") + F.when(ended, known("__pending")).otherwise(zero))
        .alias("skipped_stages"),
        known("failed_stages").alias("failed_stages"),
        known("active_stages").alias("active_stages"),
        (known("__skipped_tasks") + F.when(ended, known("__pending_tasks")).otherwise(zero))
        .alias("skipped_tasks"))


def stage_to_jobs(jobs: DataFrame, stages: DataFrame, job: str = "job_id",
                  stage_ids: str = "stage_ids", stage: str = "stage_id") -> DataFrame:
    """(stage, job) pairs for jobs whose stage list names the stage, by equi-join."""
    named = jobs.select(job, F.explode(F.array_distinct(F.col(stage_ids))).alias(stage))
    return stages.join(named, stage)


def pool_members(stages: DataFrame, stage: str = "stage_id", pool: str = "pool",
                 status: str = "status") -> DataFrame:
    """(pool, stage) pairs of the stages now in each scheduling pool."""
    return (stages.filter(F.col(status) == "ACTIVE")
            .select(F.coalesce(F.col(pool), F.lit(DEFAULT_POOL)).alias("pool"), stage).distinct())


def attempt_duration(events: DataFrame, attempt: Sequence[str], ts: str, kind: str,
                     start: str = "start", end: str = "end") -> DataFrame:
    """Start, end, duration in milliseconds and completed flag per application attempt.

    While an attempt runs its end is null and its duration -1.
    """
    ended = F.col("end_time").isNotNull()
    return (events.groupBy(*attempt).agg(
        F.min(F.when(F.col(kind) == start, F.col(ts))).alias("start_time"),
        F.max(F.when(F.col(kind) == end, F.col(ts))).alias("end_time"))
        .filter(F.col("start_time").isNotNull())
        .withColumn("duration", F.when(
            ended, millis(F.col("end_time")) - millis(F.col("start_time"))).otherwise(F.lit(-1)))
        .withColumn("completed", ended))


def host_to_members(host_events: DataFrame, members: DataFrame, host: str = "host_id"
                    ) -> DataFrame:
    """Apply host-level events to every member on the host.

    The result has a row per event and member of its host. A host's events are dealt to ``SLICES`` slices, each
    with all its members, so that few hosts are many tasks' work.
    """
    spark = host_events.sparkSession
    tasks = max(SLICES, 4 * spark.sparkContext.defaultParallelism)
    dealt = F.pmod(F.xxhash64(*host_events.columns), F.lit(SLICES))
    slices = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SLICES - 1).cast("bigint")))
    # A fixed number: partitions merged by size of the input would be a few tasks again.
    return (host_events.withColumn("__slice", dealt).repartition(tasks, host, "__slice")
            .join(members.withColumn("__slice", slices).repartition(tasks, host, "__slice"), [host, "__slice"])
            .drop("__slice"))


def exclusion_status(member_events: DataFrame, host_events: DataFrame, members: DataFrame,
                     member: str = "member_id", host: str = "host_id", seq: Sequence[str] = ("ts",),
                     flag: str = "excluded") -> DataFrame:
    """Latest excluded flag per member from member-level and host-level on/off events.

    Only the newest event per host is applied to its members, so the work is the number of
    members, not host events times members.
    """
    order = list(seq)
    own = latest_by_key(member_events.select(member, flag, *order), [member], order)
    by_host = latest_by_key(host_events.select(host, flag, *order), [host], order)
    both = own.unionByName(by_host.join(members.select(member, host), host).select(member, flag, *order))
    latest = latest_by_key(both, [member], order).select(member, F.col(flag).alias("__flag"))
    return (members.join(latest, member, "left")
            .withColumn(flag, F.coalesce("__flag", F.lit(False))).drop("__flag"))


def stage_exclusions(exclusions: DataFrame, completed_stages: DataFrame,
                     stage: Sequence[str] = ("stage_id",)) -> DataFrame:
    """Per-stage exclusions still in force: those of stages that have not completed."""
    return exclusions.distinct().join(
        completed_stages.select(*stage).distinct(), list(stage), "left_anti")


def block_placement(updates: DataFrame, dataset: str, partition: str, member: str,
                    seq: Sequence[str], valid: str = "valid") -> DataFrame:
    """(dataset, partition, member) rows whose newest storage level is valid."""
    return (latest_by_key(updates, [dataset, partition, member], seq)
            .filter(F.col(valid)).drop(valid))


def placement_counts(placed: DataFrame, dataset: str, partition: str, member: str) -> DataFrame:
    """Holders per dataset partition, partitions per dataset, blocks per member."""
    one = placed.groupBy(dataset, partition).agg(F.count(F.lit(1)).alias("holders"))
    text = [F.col(c).cast("string") for c in (dataset, partition, member)]
    per_partition = one.select(F.lit("partition").alias("level"),
                               F.concat_ws("/", text[0], text[1]).alias("name"),
                               F.col("holders").alias("n"))
    per_dataset = one.groupBy(dataset).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("dataset").alias("level"), text[0].alias("name"), "n")
    per_member = placed.groupBy(member).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("member").alias("level"), text[2].alias("name"), "n")
    return per_partition.unionByName(per_dataset).unionByName(per_member)


def stream_blocks(updates: DataFrame, keys: Sequence[str], seq: Sequence[str],
                  valid: str = "valid") -> DataFrame:
    """Stream blocks in place: valid updates are upserts, invalid ones deletes."""
    ops = updates.withColumn("op", F.when(F.col(valid), "put").otherwise("delete")).drop(valid)
    return apply_changes(ops, keys, seq)


def unpersist_adjust(usage: DataFrame, placed: DataFrame, dropped: DataFrame, member: str,
                     dataset: str, memory: str = "memory_used", disk: str = "disk_used",
                     blocks: str = "blocks") -> DataFrame:
    """Member usage after datasets are dropped, each figure floored at 0.

    Dropping only subtracts, so flooring after every drop and flooring the sum are the same.
    """
    gone = (placed.join(dropped.select(dataset).distinct(), dataset, "left_semi")
            .groupBy(member).agg(F.sum(memory).alias("__m"), F.sum(disk).alias("__d"),
                                 F.count(F.lit(1)).alias("__b")))
    zero = F.lit(0).cast("bigint")

    def less(name: str, by: str) -> Column:
        return F.greatest(F.col(name) - F.coalesce(F.col(by), zero), zero).alias(name)

    kept = [c for c in usage.columns if c not in (memory, disk, blocks)]
    return usage.join(gone, member, "left").select(
        *kept, less(memory, "__m"), less(disk, "__d"),
        (F.col(blocks) - F.coalesce(F.col("__b"), zero)).alias(blocks))


def environment_kv(df: DataFrame, scope: str, sections: Mapping[str, str]) -> DataFrame:
    """Map-typed environment sections to (scope, section, key, value) rows."""
    frames = [df.select(scope, F.lit(name).alias("section"), F.explode(column))
              for name, column in sections.items()]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def cores_per_task(environment: DataFrame, scope: str, section: str, key: str = "spark.task.cpus",
                   default: int = 1) -> DataFrame:
    """Cores per task of each scope; the default where the setting is absent or no number."""
    hit = (F.col("section") == section) & (F.col("key") == key)
    return environment.groupBy(scope).agg(F.coalesce(
        F.max(F.when(hit, F.col("value").try_cast("int"))), F.lit(default))
        .alias("cores_per_task"))


def status_change_log(reports: DataFrame, key: str, order: Sequence[str], state: str = "state",
                      terminal: Sequence[str] = TERMINAL_STATES) -> DataFrame:
    """Reports whose state differs from the one before, up to the first terminal state."""
    done = F.col(state).isin(*terminal).cast("bigint")
    steps = (Ordered(reports, [key], order)
             .previous("__before", F.col(state))
             .running("__done", F.sum, done))
    open_before = F.col("__done") - done == 0
    return (steps.df.filter(open_before & ~F.col(state).eqNullSafe(F.col("__before")))
            .drop("__before", "__done"))


def final_snapshot(events: DataFrame, keys: Sequence[str], ts: str, start: Column, end: Column
                   ) -> DataFrame:
    """Every entity seen, including those without an end, as the table stands at the last event."""
    return (events.groupBy(*keys).agg(
        F.min(F.when(start, F.col(ts))).alias("started"),
        F.max(F.when(end, F.col(ts))).alias("ended"),
        F.count(F.lit(1)).alias("updates"))
        .withColumn("is_open", F.col("ended").isNull()))
