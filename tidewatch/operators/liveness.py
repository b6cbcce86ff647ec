"""Liveness from registrations, heartbeats and removals; sessions, bars and overflow counts.

Check ticks are the multiples of the check interval since the epoch and run before events of the
same instant. All times inside are microseconds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import count_up
from .lifecycle import micros
from .ordered import Ordered

# Timeouts and intervals in microseconds, queue capacity.
TIMEOUT_US = 120_000_000
CHECK_US = 60_000_000
WORKER_PERIOD_US = 15_000_000
QUEUE_CAPACITY = 10_000
REPORT_US = 60_000_000

REGISTER, HEARTBEAT, REMOVE = "register", "heartbeat", "remove"


def horizon(df: DataFrame, ts: str) -> int:
    """Time of the last row in microseconds; one aggregate row comes to the driver."""
    return df.agg(F.max(micros(F.col(ts)))).first()[0] or 0


def first_tick_after(at: Column, check_us: int) -> Column:
    return (F.floor(at / check_us) + 1).cast("bigint") * check_us


def _as_time(at: Column) -> Column:
    return F.timestamp_micros(at)


def live_steps(df: DataFrame, member: str, ts: str, seq: str, kind: str, timeout_us: int,
               check_us: int, until_us: int | None = None) -> Ordered:
    """Events, in order, with the ``end`` of the live interval they would belong to.

    An event is followed by an end when the first tick beyond its timeout comes no later than the
    next event, or when it is a removal. The earliest such end from a row on is the end of the
    interval the row is in.
    """
    until = horizon(df, ts) if until_us is None else until_us
    events = (df.filter(F.col(kind).isin(REGISTER, HEARTBEAT, REMOVE))
              .withColumn("__at", micros(F.col(ts))))
    at = F.col("__at")
    tick = first_tick_after(at + timeout_us, check_us)
    steps = Ordered(events, [member], ["__at", seq]).next("__next", at)
    silent = tick <= F.coalesce(F.col("__next"), F.lit(until))
    steps.with_column("__candidate", F.when(
        F.col(kind) == REMOVE, F.struct(at.alias("at"), F.lit("removed").alias("reason")))
        .when(silent, F.struct(tick.alias("at"), F.lit("expired").alias("reason"))))
    return steps.running("end", F.min, F.col("__candidate"), following=True)


def live_intervals(df: DataFrame, member: str, ts: str, seq: str, kind: str,
                   timeout_us: int = TIMEOUT_US, check_us: int = CHECK_US,
                   until_us: int | None = None) -> DataFrame:
    """(member, start, end, end_reason, last_seen); an open interval has no end.

    A registration starts or refreshes an interval, a heartbeat refreshes a live one, a removal or
    a check tick more than the timeout after the last refresh ends it. A late heartbeat that still
    comes before the tick saves the member.
    """
    steps = live_steps(df, member, ts, seq, kind, timeout_us, check_us, until_us).df
    at = F.col("__at")
    grouped = (steps.filter(F.col(kind) != REMOVE)
               .groupBy(member, "end").agg(
        F.min(F.when(F.col(kind) == REGISTER, at)).alias("__start"),
        F.max(at).alias("__last")).filter(F.col("__start").isNotNull()))
    return grouped.select(
        member, _as_time(F.col("__start")).alias("start"), _as_time(F.col("end.at")).alias("end"),
        F.coalesce("end.reason", F.lit("open")).alias("end_reason"),
        _as_time(F.col("__last")).alias("last_seen"))


def expire_silent(intervals: DataFrame, member: str) -> DataFrame:
    """Expired members with the tick that removed them and their silence in milliseconds."""
    return intervals.filter(F.col("end_reason") == "expired").select(
        member, F.col("end").alias("tick"),
        F.floor((micros(F.col("end")) - micros(F.col("last_seen"))) / 1000).cast("bigint")
        .alias("silence_ms"))


def live_count(intervals: DataFrame, check_us: int = CHECK_US, until_us: int | None = None
               ) -> DataFrame:
    """Live members after every check tick.

    Changes are added up per tick before the running sum, which then works on the tick table.
    """
    start, end = micros(F.col("start")), micros(F.col("end"))
    out = F.when(F.col("end_reason") == "expired", end).otherwise(first_tick_after(end, check_us))
    changes = (intervals.select(F.explode(F.array(
        F.struct(first_tick_after(start, check_us).alias("tick"), F.lit(1).alias("change")),
        F.struct(out.alias("tick"), F.lit(-1).alias("change")))).alias("c"))
        .select("c.*").filter(F.col("tick").isNotNull()).groupBy("tick")
        .agg(F.sum("change").alias("change")))
    if until_us is not None:
        changes = changes.filter(F.col("tick") <= until_us)
    last = F.max("tick") if until_us is None else F.lit(until_us - until_us % check_us)
    # Changes lie on ticks, so whole numbers of intervals count them.
    span = changes.agg(F.min("tick").alias("a"), last.alias("b")).filter("a <= b")
    ticks = count_up(span, F.expr(f"a div {check_us}"), F.expr(f"b div {check_us}"), "__n").select(
        (F.col("__n") * check_us).alias("tick"))
    steps = ticks.join(changes, "tick", "left").withColumn("change", F.coalesce("change",
                                                                               F.lit(0)))
    return (Ordered(steps, [], ["tick"]).running("live", F.sum, F.col("change")).df
            .select(_as_time(F.col("tick")).alias("tick"), "live"))


def reregister_requests(df: DataFrame, member: str, ts: str, seq: str, kind: str,
                        timeout_us: int = TIMEOUT_US, check_us: int = CHECK_US,
                        until_us: int | None = None) -> DataFrame:
    """Heartbeats of members that are unknown, expired or removed at that moment.

    A heartbeat is known if the last registration before it has the same interval end as itself.
    """
    steps = live_steps(df, member, ts, seq, kind, timeout_us, check_us, until_us)
    known = steps.last_known(
        "__registered", F.when(F.col(kind) == REGISTER, F.struct(F.col("end").alias("end")))).df
    live = F.col("__registered").isNotNull() & F.col("__registered.end").eqNullSafe(F.col("end"))
    return (known.filter((F.col(kind) == HEARTBEAT) & ~live)
            .select(*df.columns))


def expire_workers(df: DataFrame, member: str, ts: str, seq: str, kind: str,
                   period_us: int = WORKER_PERIOD_US, until_us: int | None = None) -> DataFrame:
    """(member, registered, expired) under the master's rule with one period for check and timeout.

    A registration sets no heartbeat time, so a worker must beat after registering and before the
    next tick; registering a live id changes nothing. What a check window does to a worker
    depends only on the window: with a beat after a registration it leaves it alive, without a beat
    dead, with beats alone as it was. So events are first reduced to one row per worker and
    window, and no per-worker state machine is needed.
    """
    until = horizon(df, ts) if until_us is None else until_us
    at = micros(F.col(ts))
    place = F.struct(at.alias("at"), F.col(seq).alias("seq"))
    windows = (df.filter(F.col(kind).isin(REGISTER, HEARTBEAT))
               .withColumn("__w", F.floor(at / period_us).cast("bigint"))
               .groupBy(member, "__w").agg(
        F.min(F.when(F.col(kind) == REGISTER, place)).alias("__reg"),
        F.max(F.when(F.col(kind) == HEARTBEAT, place)).alias("__beat")))
    w = F.col("__w")
    rows = (Ordered(windows, [member], ["__w"], bound=(df, 1))
            .previous("__before", w).next("__after", w))
    apart = F.col("__before").isNull() | (F.col("__before") != w - 1)
    rows.with_column("__fixed", F.when(F.coalesce(F.col("__beat") > F.col("__reg"), F.lit(False)),
                                       True)
                     .when(F.col("__beat").isNull() | apart, False))
    rows.last_known("__alive", F.col("__fixed")).previous("__was", F.col("__alive"))
    tick = (w + 1) * period_us
    gone = (F.when(~F.col("__alive"), tick)
            .when(F.coalesce(F.col("__after") > w + 1, F.lit(True)), tick + period_us))
    rows.with_column("__gone", gone).running("__end", F.min, F.col("__gone"), following=True)
    accepted = F.col("__reg").isNotNull() & (apart | ~F.coalesce("__was", F.lit(False)))
    end = F.col("__end")
    return rows.df.filter(accepted).select(
        member, _as_time(F.col("__reg.at")).alias("registered"),
        F.when(end <= until, _as_time(end)).alias("expired"))


def liveness_sessions(df: DataFrame, member: str, ts: str, seq: str, timeout_us: int) -> DataFrame:
    """Gap sessions: a silence longer than the timeout starts a new one."""
    rows = df.withColumn("__at", micros(F.col(ts)))
    at = F.col("__at")
    steps = Ordered(rows, [member], ["__at", seq]).previous("__before", at)
    fresh = F.col("__before").isNull() | (at - F.col("__before") > timeout_us)
    steps.running("__session", F.sum, fresh.cast("bigint"))
    return (steps.df.groupBy(member, "__session").agg(
        F.min(ts).alias("start"), F.max(ts).alias("last_seen"),
        F.count(F.lit(1)).alias("beats")).drop("__session"))


def sliding_failures(df: DataFrame, keys: Sequence[str], ts: str, interval: str, slide: str
                     ) -> DataFrame:
    """Failures per key in sliding windows; the same frame works on a stream."""
    return (df.groupBy(*keys, F.window(ts, interval, slide).alias("w"))
            .agg(F.count(F.lit(1)).alias("failures"))
            .select(*keys, F.col("w.start").alias("window_start"),
                    F.col("w.end").alias("window_end"), "failures"))


def quote_high(quotes: DataFrame, security: str = "security", price: str = "price") -> DataFrame:
    """Highest price per security."""
    return quotes.groupBy(security).agg(F.max(price).alias("high"))


def quote_bars(quotes: DataFrame, interval: str, security: str = "security", ts: str = "ts",
               price: str = "price", seq: str = "event_id") -> DataFrame:
    """High, low, open, close and count per security and interval; works on a stream too."""
    place = F.struct(F.col(ts), F.col(seq))
    return (quotes.groupBy(security, F.window(ts, interval).alias("w"))
            .agg(F.max(price).alias("high"), F.min(price).alias("low"),
                 F.min_by(price, place).alias("open"), F.max_by(price, place).alias("close"),
                 F.count(F.lit(1)).alias("quotes"))
            .select(security, F.col("w.start").alias("bar_start"), "high", "low", "open", "close",
                    "quotes"))


def overflow_report(events: DataFrame, ts: str, interval: str, capacity: int = QUEUE_CAPACITY,
                    keys: Sequence[str] = ("queue",)) -> DataFrame:
    """Events over the capacity per queue and report interval."""
    return (events.groupBy(*keys, F.window(ts, interval).alias("w"))
            .agg(F.count(F.lit(1)).alias("received"))
            .select(*keys, F.col("w.start").alias("report_start"), "received",
                    F.greatest(F.col("received") - capacity, F.lit(0)).alias("dropped")))
