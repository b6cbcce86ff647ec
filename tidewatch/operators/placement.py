"""Capacity and placement arithmetic per application (``scope``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import count_up
from ..session import written
from .lifecycle import micros
from .ordered import Ordered

# Fixed value: longest wait for registered resources, in microseconds.
WAIT_US = 30_000_000


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def allocation_gap(apps: DataFrame, target: str = "target", pending: str = "pending",
                   running: str = "running") -> DataFrame:
    """What to request or cancel so that pending plus running meets the target."""
    missing = F.col(target) - F.col(pending) - F.col(running)
    return apps.select(
        "*", missing.alias("missing"),
        F.when(missing > 0, "request").when(missing < 0, "cancel").otherwise("none")
        .alias("action"),
        F.when(missing > 0, missing).when(missing < 0, F.least(F.col(pending), -missing))
        .otherwise(_zero()).alias("containers"))


def running_after_completion(running: DataFrame, completed: DataFrame, released: DataFrame,
                             scope: str, container: str, count: str = "running") -> DataFrame:
    """Running count less the completions that had not been released before."""
    ended = (completed.select(scope, container).distinct()
             .join(released.select(container).distinct(), container, "left_anti")
             .groupBy(scope).agg(F.count(F.lit(1)).alias("__ended")))
    return (running.join(ended, scope, "left")
            .withColumn(count, F.col(count) - F.coalesce("__ended", _zero())).drop("__ended"))


def pending_by_host_share(requests: DataFrame, scope: str, hosts: str, host: str = "host_id"
                          ) -> DataFrame:
    """Expected containers per host from pending requests that name several hosts.

    A host's share is its number of mentions times the requests over all mentions. Mentions are
    counted per host before the totals are attached.
    """
    per_host = (requests.select(scope, F.explode(hosts).alias(host))
                .groupBy(scope, host).agg(F.count(F.lit(1)).alias("mentions")))
    totals = requests.groupBy(scope).agg(
        F.count(F.lit(1)).alias("__requests"),
        F.sum(F.size(hosts)).cast("bigint").alias("__mentions"))
    return (per_host.join(totals, scope)
            .withColumn("expected", F.col("mentions") * F.col("__requests").cast("double")
                        / F.col("__mentions"))
            .select(scope, host, "mentions", "expected"))


def executors_for(tasks: Column, cpus_per_task: int, cores: int) -> Column:
    """Executors that can run all tasks at once, rounded up."""
    return F.floor((tasks * cpus_per_task + cores - 1) / cores).cast("bigint")


def expected_per_host(local_tasks: DataFrame, apps: DataFrame, allocated: DataFrame,
                      pending_share: DataFrame, scope: str, host: str = "host_id",
                      count: str = "tasks", aware: str = "aware_tasks", cpus_per_task: int = 1,
                      cores: int = 1) -> DataFrame:
    """Containers still needed per host.

    A host's part of the needed executors follows its local tasks; containers it has, and its
    share of the pending ones, are subtracted.
    """
    totals = (local_tasks.groupBy(scope).agg(F.sum(count).alias("__total"))
              .join(apps.select(scope, executors_for(F.col(aware), cpus_per_task, cores)
                                .alias("__execs")), scope))
    existing = allocated.groupBy(scope, host).agg(F.count(F.lit(1)).alias("__have"))
    expected = F.col(count).cast("double") * F.col("__execs") / F.col("__total")
    have = F.coalesce("__have", _zero()) + F.coalesce("__share", F.lit(0.0))
    return (local_tasks.join(totals, scope).join(existing, [scope, host], "left")
            .join(pending_share.select(scope, host, F.col("expected").alias("__share")),
                  [scope, host], "left")
            .select(scope, host, F.greatest(F.ceil(expected - have).cast("bigint"), _zero())
                    .alias("needed")))


def placement_rounds(needed: DataFrame, apps: DataFrame, scope: str, racks: DataFrame | None = None,
                     host: str = "host_id", need: str = "needed", requests: str = "requests",
                     rack: str = "rack_id") -> DataFrame:
    """(scope, request, host, rack) rows: the preferred hosts of each container request.

    Requests beyond the containers needed come first and prefer no host. Host ``h`` is preferred
    by the first ``ceil(need_h * aware / max need)`` of the others, which each host row
    produces itself, so nothing is joined by inequality.
    """
    # One row per host, read by several branches: computed once.
    needed = written(needed.select(scope, host, need))
    sums = needed.groupBy(scope).agg(F.sum(need).alias("__sum"), F.max(need).alias("__most"))
    plan = written(
        apps.select(scope, F.col(requests).cast("bigint").alias("__n")).join(sums, scope, "left")
        .withColumn("__free", F.greatest(F.col("__n") - F.coalesce("__sum", _zero()), _zero()))
        .withColumn("__aware", F.col("__n") - F.col("__free")))
    free = (count_up(plan, F.lit(1), F.col("__free"), "request")
            .select(scope, "request", F.lit(None).cast(needed.schema[host].dataType).alias(host)))
    rounds = F.ceil(F.col(need).cast("double") * F.col("__aware") / F.col("__most")).cast("bigint")
    aware = (needed.join(plan.filter(F.col("__aware") > 0), scope)
             .withColumn("__rounds", rounds))
    aware = (count_up(aware, F.lit(1), F.col("__rounds"), "__round")
             .select(scope, (F.col("__free") + F.col("__round")).alias("request"), host))
    rows = free.unionByName(aware)
    if racks is not None:
        rows = rows.join(racks.select(host, rack), host, "left")
    return rows


def drain_selection(wanted: DataFrame, known: DataFrame, pending_removal: DataFrame,
                    busy: DataFrame, member: str, force: bool = False) -> DataFrame:
    """Members to stop: known, not already being removed, and idle unless forced."""
    chosen = (wanted.distinct().join(known.select(member).distinct(), member, "left_semi")
              .join(pending_removal.select(member).distinct(), member, "left_anti"))
    if force:
        return chosen
    return chosen.join(busy.select(member).distinct(), member, "left_anti")


def target_after_drain(targets: DataFrame, chosen: DataFrame, scope: str, target: str = "target"
                       ) -> DataFrame:
    taken = chosen.groupBy(scope).agg(F.count(F.lit(1)).alias("__taken"))
    return (targets.join(taken, scope, "left")
            .withColumn(target, F.greatest(F.col(target) - F.coalesce("__taken", _zero()),
                                           _zero())).drop("__taken"))


def pending_members(apps: DataFrame, requested: str = "requested", existing: str = "existing",
                    removing: str = "removing", known_pending: str | None = None) -> DataFrame:
    """Members still to come per application; a negative request is an error row.

    With ``known_pending`` the row also says whether the books disagree with the request.
    """
    pending = F.greatest(F.col(requested) - F.col(existing) + F.col(removing), _zero())
    negative = F.col(requested) < 0
    result = (apps.withColumn("pending", F.when(~negative, pending))
              .withColumn("error", F.when(negative, F.concat(
                  F.lit("negative number of members requested: "),
                  F.col(requested).cast("string")))))
    if known_pending:
        result = result.withColumn("mismatch", F.col(requested) != (
            F.col(existing) + F.col(known_pending) - F.col(removing)))
    return result


def free_slots(members: DataFrame, updates: DataFrame, member: str, kind: str = "kind",
               cores: str = "cores", cpus_per_task: int = 1, started: Sequence[str] = ("start",),
               finished: Sequence[str] = ("finish",)) -> DataFrame:
    """Free cores per member; updates from unknown members have no effect."""
    running = updates.groupBy(member).agg(
        (F.count_if(F.col(kind).isin(*started)) - F.count_if(F.col(kind).isin(*finished)))
        .alias("__running"))
    return (members.join(running, member, "left")
            .withColumn("free_cores", F.col(cores)
                        - F.coalesce("__running", _zero()) * cpus_per_task)
            .drop("__running"))


def ready_gate(registrations: DataFrame, apps: DataFrame, scope: str, order: Sequence[str],
               ts: str = "ts", cores: str = "cores", start: str = "start_time",
               expected: str = "expected_cores", ratio: float = 0.8, wait_us: int = WAIT_US
               ) -> DataFrame:
    """When and why an application may start.

    Ready at the first registration that brings the registered cores to ``ratio`` of the expected
    ones, or when the waiting time is over, whichever is earlier.
    """
    share = min(1.0, ratio)
    needed = apps.select(scope, start, F.col(expected).cast("double").alias("__expected"))
    steps = Ordered(registrations.select(scope, ts, cores, *[o for o in order if o != ts]),
                    [scope], order).running("__sum", F.sum, F.col(cores)).df
    enough = F.col("__sum") >= F.col("__expected") * share
    first = (steps.join(needed.select(scope, "__expected"), scope).groupBy(scope)
             .agg(F.min(F.when(enough, micros(F.col(ts)))).alias("__enough")))
    waited = micros(F.col(start)) + wait_us
    at_once = F.col("__expected") <= 0
    enough_at = F.when(at_once, micros(F.col(start))).otherwise(F.col("__enough"))
    by_resources = F.coalesce(enough_at <= waited, F.lit(False))
    return (needed.join(first, scope, "left")
            .select(scope, F.timestamp_micros(F.least(enough_at, waited)).alias("ready_time"),
                    F.when(by_resources, "resources").otherwise("waited").alias("reason")))
