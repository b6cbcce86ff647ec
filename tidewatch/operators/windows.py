"""Running, retention and run-detection rules that do not need per-key state machines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .keyed import first_by_key, latest_by_key
from .lifecycle import micros
from .ordered import Ordered


def last_attempt(stages: DataFrame, stage: str = "stage_id", attempt: str = "attempt_id"
                 ) -> DataFrame:
    return latest_by_key(stages, [stage], attempt)


def number_to_remove(size: Column, limit: int) -> Column:
    """0 up to the limit, beyond it the surplus but at least a tenth of the limit."""
    tenth = F.lit(limit // 10).cast("bigint")
    return F.when(size > limit, F.greatest(tenth, size - limit)).otherwise(F.lit(0))


def _newest(df: DataFrame, scope: Sequence[str], order: Sequence[Column], most: int) -> DataFrame:
    """The last ``most`` rows per scope, numbered from the newest (``__rn``).

    Spark keeps at most ``most`` rows per scope and task before the shuffle, up to a threshold;
    beyond that the numbering itself is spread over tasks.
    """
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if most <= threshold:
        newest = Window.partitionBy(*scope).orderBy(*order)
        numbered = df.withColumn("__rn", F.row_number().over(newest))
    else:
        numbered = Ordered(df, scope, order).row_number("__rn").df
    return numbered.filter(F.col("__rn") <= most)


def retain(df: DataFrame, scope: Sequence[str], order: Sequence[str], limit: int,
           removable: Column, counted: Column | None = None) -> DataFrame:
    """Rows left after removing the oldest removable ones of scopes above the limit.

    ``counted`` says which rows count against the limit (all by default); every removable row must
    count. A scope over the limit keeps at most ``limit`` removable rows, so only the newest
    ``limit`` per scope are ranked, and a scope with most of the rows costs ``limit`` rows per
    task.
    """
    counted = F.lit(True) if counted is None else counted
    may_go = F.coalesce(removable, F.lit(False))
    sizes = df.groupBy(*scope).agg(F.count_if(counted).alias("__size"),
                                   F.count_if(may_go).alias("__removable"))
    over = sizes.filter(F.col("__size") > limit).select(
        *scope, F.greatest(F.col("__removable") - number_to_remove(F.col("__size"), limit),
                           F.lit(0)).alias("__kept"))
    untouched = (df.join(over, list(scope), "left")
                 .filter(F.col("__kept").isNull() | ~may_go).select(*df.columns))
    newest = _newest(df.filter(may_go), scope, [F.col(c).desc() for c in order], max(limit, 1))
    survivors = (newest.join(over, list(scope)).filter(F.col("__rn") <= F.col("__kept"))
                 .select(*df.columns))
    return untouched.unionByName(survivors)


def retain_tasks(df: DataFrame, scope: Sequence[str], order: Sequence[str], limit: int,
                 running: Column) -> DataFrame:
    """Tasks left per stage: finished ones go first by completion, then running ones.

    Removing the oldest ``max(limit / 10, size - limit)`` leaves at most ``limit`` rows, so
    again only the newest ``limit`` rows per stage take part in the ranking.
    """
    flagged = df.withColumn("__running", running.cast("int"))
    kept = flagged.groupBy(*scope).agg(F.count(F.lit(1)).alias("__size")).select(
        *scope, (F.col("__size") - number_to_remove(F.col("__size"), limit)).alias("__kept"))
    newest = _newest(flagged, scope, [F.col("__running").desc(), *[F.col(c).desc() for c in order]],
                     max(limit, 1))
    return (newest.join(kept, list(scope)).filter(F.col("__rn") <= F.col("__kept"))
            .select(*df.columns))


def clamped_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], delta: str,
                name: str = "usage", bound: tuple[DataFrame, int] | None = None) -> DataFrame:
    """Running sum in which every step is floored at 0.

    Equals ``S - min(0, lowest S so far)`` with the plain running sum ``S``.
    """
    steps = (Ordered(df, keys, order, bound=bound).running("__sum", F.sum, F.col(delta))
             .running("__low", F.min, F.col("__sum")))
    return (steps.df.withColumn(name, F.col("__sum") - F.least(F.col("__low"), F.lit(0)))
            .drop("__sum", "__low"))


def gauge_steps(df: DataFrame, keys: Sequence[str], start: str, end: str, at: str = "instant"
                ) -> DataFrame:
    """Net change of the number of open intervals per key and instant.

    Starts and ends are added up per instant before any ordering.
    """
    changes = df.select(*keys, F.explode(F.array(
        F.struct(F.col(start).alias(at), F.lit(1).cast("bigint").alias("change")),
        F.struct(F.col(end).alias(at), F.lit(-1).cast("bigint").alias("change"))))
        .alias("__c")).select(*keys, "__c.*").filter(F.col(at).isNotNull())
    return changes.groupBy(*keys, at).agg(F.sum("change").alias("change"))


def running_gauge(df: DataFrame, keys: Sequence[str], start: str, end: str, at: str = "instant",
                  floor: bool = False) -> DataFrame:
    """Number of open intervals after each instant, optionally floored at 0."""
    steps = gauge_steps(df, keys, start, end, at)
    if floor:
        return clamped_sum(steps, keys, [at], "change", "open", bound=(df, 2)).drop("change")
    return (Ordered(steps, keys, [at], bound=(df, 2)).running("open", F.sum, F.col("change")).df
            .drop("change"))


def metric_delta(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                 name: str = "delta") -> DataFrame:
    """Value minus the entity's previous value; the first one counts in full."""
    steps = Ordered(df, keys, order).previous("__before", F.col(value))
    return (steps.df.withColumn(name, F.col(value) - F.coalesce("__before", F.lit(0)))
            .drop("__before"))


def failures_in_interval(failures: DataFrame, keys: Sequence[str], ts: str, interval_us: int,
                         name: str = "recent_failures") -> DataFrame:
    """Per failure time: failures in ``[ts - interval, ts]`` of the same key.

    A failure exactly at the edge counts; an interval up to 0 never forgets. Failures are added
    up per instant, and each instant also leaves the window again one interval later, so the
    count is one running sum over entries and exits.
    """
    at = micros(F.col(ts))
    per_instant = (failures.select(*keys, at.alias("__at")).groupBy(*keys, "__at")
                   .agg(F.count(F.lit(1)).alias("__n")))
    return (counted_instants(per_instant, keys, interval_us, name, failures)
            .select(*keys, F.timestamp_micros("__at").alias(ts), name))


def counted_instants(per_instant: DataFrame, keys: Sequence[str], interval_us: int, name: str,
                     bound: DataFrame | None = None) -> DataFrame:
    """(keys, __at, name) of ``per_instant`` (keys, __at, __n): the sum of __n over ``[__at - interval, __at]``.
    ``bound`` is a frame with the same keys that is cheaper to count."""
    bound = per_instant if bound is None else bound
    if interval_us <= 0:
        return (Ordered(per_instant, keys, ["__at"], bound=(bound, 1))
                .running(name, F.sum, F.col("__n")).df.select(*keys, "__at", name))
    # Entries sort before exits of the same instant, so the edge is still inside.
    moves = per_instant.select(*keys, F.explode(F.array(
        F.struct(F.col("__at"), F.lit(0).alias("__exit"), F.col("__n")),
        F.struct((F.col("__at") + interval_us).alias("__at"), F.lit(1).alias("__exit"),
                 (-F.col("__n")).alias("__n")))).alias("__m")).select(*keys, "__m.*")
    counted = (Ordered(moves, keys, ["__at", "__exit"], bound=(bound, 2))
               .running(name, F.sum, F.col("__n")).df)
    return counted.filter(F.col("__exit") == 0).select(*keys, "__at", name)


def register_outcome(registrations: DataFrame, member: str, order: Sequence[str], row_id: str,
                     excluded_hosts: DataFrame, host: str, cores: str,
                     duplicate_first: bool = True) -> DataFrame:
    """``accepted``, ``duplicate`` or ``rejected`` per registration and the cores it adds.

    A member registers once. With ``duplicate_first`` a known id is a duplicate even on an
    excluded host; otherwise the host decides first. The accepted row per member is found with a
    map-side limit.
    """
    marked = (registrations.join(excluded_hosts.select(host).distinct()
                                 .withColumn("__bad", F.lit(True)), host, "left")
              .withColumn("__bad", F.coalesce("__bad", F.lit(False))))
    place = F.struct(*[F.col(o) for o in order])
    first = (first_by_key(marked.filter(~F.col("__bad")).select(member, row_id, *order),
                          [member], order)
             .select(member, F.col(row_id).alias("__row"), place.alias("__when")))
    joined = (marked.join(first, member, "left")
              .withColumn("__first", F.coalesce(F.col(row_id) == F.col("__row"), F.lit(False))))
    known = F.col("__when").isNotNull() & (place > F.col("__when"))
    duplicate, rejected = F.lit("duplicate"), F.lit("rejected")
    outcome = F.when(F.col("__first"), "accepted")
    if duplicate_first:
        outcome = outcome.when(known, duplicate).otherwise(rejected)
    else:
        outcome = outcome.when(F.col("__bad"), rejected).otherwise(duplicate)
    added = F.when(F.col("__first"), F.col(cores)).otherwise(F.lit(0)).cast("bigint")
    return (joined.withColumn("outcome", outcome).withColumn("added_cores", added)
            .drop("__bad", "__first", "__when", "__row"))


def resource_dedup(files: DataFrame, scope: Sequence[str], uri: str, name: str,
                   order: Sequence[str], row_id: str) -> DataFrame:
    """``accepted``, ``same path`` or ``same name`` for each file of a list.

    The first file of a name is taken. Later rows are a repeated path if they equal it, else
    another path with a used name.
    """
    first = first_by_key(files.select(*scope, name, uri, row_id, *order), [*scope, name], order)
    taken = first.select(*scope, name, F.col(uri).alias("__uri"), F.col(row_id).alias("__row"))
    return (files.join(taken, [*scope, name])
            .withColumn("outcome", F.when(F.col(row_id) == F.col("__row"), "accepted")
                        .when(F.col(uri) == F.col("__uri"), "same path")
                        .otherwise("same name")).drop("__uri", "__row"))


def row_groups(df: DataFrame, scope: Sequence[str], order: Sequence[str | Column],
               columns: Sequence[str]) -> DataFrame:
    """Runs of equal adjacent values, nested by column: (scope, column, group, span, value).

    A new value in an outer column also starts a new run in every inner one.
    """
    steps = Ordered(df, scope, order).row_number("__row")
    changed = F.lit(False)
    for name in columns:
        steps.previous(f"__before_{name}", F.struct(F.col(name).alias("v")))
    for i, name in enumerate(columns):
        before = F.col(f"__before_{name}")
        changed = changed | before.isNull() | ~before["v"].eqNullSafe(F.col(name))
        steps.running(f"__group_{i}", F.sum, changed.cast("bigint"))
    rows = steps.df.select(*scope, "__row", F.explode(F.array(*[
        F.struct(F.lit(name).alias("column"), F.col(f"__group_{i}").alias("group"),
                 F.col(name).cast("string").alias("value"))
        for i, name in enumerate(columns)])).alias("__g")).select(*scope, "__row", "__g.*")
    return rows.groupBy(*scope, "column", "group").agg(
        F.min("__row").alias("first_row"), F.count(F.lit(1)).alias("span"),
        F.first("value").alias("value"))


def consecutive_failures(events: DataFrame, keys: Sequence[str], order: Sequence[str],
                         failed: Column, name: str = "in_a_row") -> DataFrame:
    """Failures in a row up to each event; a success starts over."""
    steps = (Ordered(events.withColumn("__failed", failed), keys, order)
             .row_number("__row")
             .last_known("__reset", F.when(~F.col("__failed"), F.col("__row"))))
    streak = F.col("__row") - F.coalesce("__reset", F.lit(0))
    return (steps.df.withColumn(name, F.when(F.col("__failed"), streak).otherwise(F.lit(0)))
            .drop("__row", "__reset", "__failed"))


def give_up(events: DataFrame, keys: Sequence[str], order: Sequence[str], failed: Column,
            most: int = 5) -> DataFrame:
    """Events at which the failures in a row reach ``most``."""
    return consecutive_failures(events, keys, order, failed).filter(F.col("in_a_row") == most)
