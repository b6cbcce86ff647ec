"""Queries: the same rules on streams, run over everything available, with what is open at the end."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import keyed, lifecycle, liveness
from ..session import scratch_folder
from ..streaming import keyed_state, open_state, run, sinks, windows
from .q_liveness import (BARS_SQL, CHECK, EXCLUSION_SQL, LIVE_SQL, THROTTLE_SQL, TIMEOUT,
                         US_PER_HOUR, WORKERS_SQL, ntz)
from .q_windows import FAILURES_SQL
from .registry import query
from .tables import number_in



def events(t, delay: str | None = "0 seconds"):
    stream = run.event_stream(t.spark, t.sf_dir, t.read("events").schema,
                              pattern="events.parquet")
    return stream if delay is None else stream.withWatermark("ts", delay)


def beats(t, delay: str | None = "0 seconds", stream=None):
    k = F.col("k")
    kind = (F.when(F.col("event_type") == "signup", "register")
            .when((F.col("event_type") == "error") & (k % 5 == 0), "remove")
            .when(F.col("event_type") == "error", "failure").otherwise("heartbeat"))
    return (events(t, delay) if stream is None else stream).withColumn("k", number_in(F.col("props"))).select(
        "event_id", F.col("user_id").alias("member_id"), (F.col("user_id") % 25).alias("host_id"),
        "ts", "k", kind.alias("kind"))


def in_batches(t):
    """The beats as a stream of five batches, one file each; the third file is empty."""
    base = folder(t, "files")
    rows = t.read("events")
    for n in range(5):
        part = rows.filter(F.lit(False)) if n == 2 else rows.filter(
            F.col("event_id") % 4 == (n if n < 2 else n - 1))
        part.coalesce(1).write.parquet(f"{base}/{n}")
    return run.event_stream(t.spark, f"{base}/*", rows.schema, files_per_trigger=1)


def folder(t, name: str) -> str:
    return f"{scratch_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def named(stream, *columns: str):
    """The stream with text ids, as logs have them."""
    return stream.withColumns({c: F.concat(F.lit(f"{c}-"), F.col(c).cast("string")) for c in columns})


@query("stream_live_intervals", f"""
WITH {LIVE_SQL} SELECT * REPLACE (concat('member_id-', CAST(member_id AS VARCHAR)) AS member_id)
FROM intervals
""", "v_beats")
def _(t):
    return ntz(keyed_state.live_intervals(
        named(beats(t), "member_id", "event_id"), "member_id", "ts", "event_id", "kind", TIMEOUT, CHECK,
        until_us=liveness.horizon(t.beats, "ts")), "start", "end", "last_seen")


@query("stream_reregister_requests", f"""
WITH {LIVE_SQL}
SELECT concat('event_id-', CAST(b.event_id AS VARCHAR)) AS event_id,
       concat('member_id-', CAST(b.member_id AS VARCHAR)) AS member_id, b.ts FROM v_beats b
WHERE b.kind = 'heartbeat' AND NOT EXISTS (
  SELECT 1 FROM intervals i WHERE i.member_id = b.member_id AND i.start < b.ts
    AND (i."end" IS NULL OR i."end" > b.ts))
""", "v_beats")
def _(t):
    return ntz(keyed_state.reregister_requests(
        named(beats(t), "member_id", "event_id"), "member_id", "ts", "event_id", "kind", TIMEOUT, CHECK,
        until_us=liveness.horizon(t.beats, "ts")), "ts")


@query("stream_expire_workers", f"""
SELECT * REPLACE (concat('member_id-', CAST(member_id AS VARCHAR)) AS member_id)
FROM ({WORKERS_SQL}) w
""", "v_beats")
def _(t):
    return ntz(keyed_state.expire_workers(
        named(beats(t), "member_id"), "member_id", "ts", "event_id", "kind", CHECK,
        until_us=liveness.horizon(t.beats, "ts")), "registered", "expired")


@query("stream_throttle", THROTTLE_SQL)
def _(t):
    rows = events(t).select("event_id", F.col("user_id").alias("member_id"), "ts",
                            (F.col("event_type") == "purchase").alias("terminal"))
    return ntz(keyed_state.throttle(rows, "member_id", "ts", "event_id", 24 * US_PER_HOUR, "terminal",
                                    until_us=liveness.horizon(t.read("events"), "ts")), "ts")


@query("stream_exclusion_windows", f"""
SELECT concat('host_id-', CAST(host_id AS VARCHAR)) AS host_id, ts, recent, tracked, excluded_until
FROM ({EXCLUSION_SQL}) w
""", "v_beats")
def _(t):
    failures = named(beats(t), "host_id").filter(F.col("kind") == "failure")
    return ntz(keyed_state.exclusion_windows(
        failures, "host_id", "ts", "event_id", 2, 48 * US_PER_HOUR, 36 * US_PER_HOUR,
        until_us=liveness.horizon(t.beats, "ts")), "ts", "excluded_until")


@query("stream_failures_in_interval", FAILURES_SQL.format(key="host_id,", part="PARTITION BY host_id"), "v_beats")
def _(t):
    failures = beats(t).filter(F.col("kind") == "failure")
    return ntz(keyed_state.failures_in_interval(failures, "host_id", "ts", "event_id", 48 * US_PER_HOUR,
                                                until_us=liveness.horizon(t.beats, "ts")), "ts")


@query("stream_quote_bars", BARS_SQL, "v_quotes")
def _(t):
    quotes = events(t).select("event_id", F.col("event_type").alias("security"), "ts",
                              F.col("value").alias("price"))
    return ntz(open_state.run_to_end(liveness.quote_bars(quotes, "1 hour"),
                                     lambda at: open_state.open_bars(t.spark, at)), "bar_start")


@query("stream_sliding_failures", f"""
SELECT host_id, make_timestamp(w * {6 * US_PER_HOUR}) AS window_start,
       make_timestamp(w * {6 * US_PER_HOUR} + {48 * US_PER_HOUR}) AS window_end,
       count(*) AS failures
FROM (SELECT host_id, unnest(generate_series(epoch_us(ts) // {6 * US_PER_HOUR} - 7,
                                             epoch_us(ts) // {6 * US_PER_HOUR})) AS w
      FROM v_beats WHERE kind = 'failure') x
GROUP BY host_id, w
""", "v_beats")
def _(t):
    failures = beats(t).filter(F.col("kind") == "failure")
    return ntz(open_state.run_to_end(
        liveness.sliding_failures(failures, ["host_id"], "ts", "48 hours", "6 hours"),
        lambda at: open_state.open_windows(t.spark, at, ["host_id"])), "window_start", "window_end")


@query("stream_sessions", f"""
SELECT member_id, start, last_seen, beats FROM (
  SELECT member_id, min(ts) AS start, max(ts) AS last_seen, count(*) AS beats FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY member_id ORDER BY ts, event_id) AS session FROM (
      SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY member_id
                       ORDER BY ts, event_id)) <= {TIMEOUT} THEN 0 ELSE 1 END AS fresh
      FROM v_beats) a) b
  GROUP BY member_id, session) s
""", "v_beats")
def _(t):
    return ntz(open_state.run_to_end(
        windows.sessions(beats(t), "member_id", "ts", "12 hours"),
        lambda at: open_state.open_sessions(t.spark, at, "member_id")), "start", "last_seen")


@query("stream_register_dedup", """
SELECT member_id, arg_min(event_id, struct_pack(us := epoch_us(ts), id := event_id)) AS event_id, min(ts) AS ts
FROM v_beats WHERE kind = 'register' GROUP BY member_id
""", "v_beats")
def _(t):
    registrations = beats(t).filter(F.col("kind") == "register")
    return ntz(keyed_state.first_registrations(
        registrations, "member_id", "ts", "event_id", until_us=liveness.horizon(t.beats, "ts")), "ts")


@query("stream_register_ids", """
SELECT DISTINCT member_id FROM v_beats WHERE kind = 'register'
""", "v_beats")
def _(t):
    registrations = beats(t, "60 days").filter(F.col("kind") == "register").select("member_id", "ts")
    return run.run_to_table(windows.register_dedup(registrations, ["member_id"])).select("member_id")


@query("stream_overflow_report", f"""
SELECT queue, date_trunc('hour', ts) AS report_start, count(*) AS received,
       greatest(count(*) - 3, 0) AS dropped
FROM (SELECT event_type AS queue, ts FROM events) e
GROUP BY queue, date_trunc('hour', ts)
""")
def _(t):
    rows = events(t).select(F.col("event_type").alias("queue"), "ts")
    return ntz(open_state.run_to_end(
        liveness.overflow_report(rows, "ts", "1 hour", capacity=3),
        lambda at: open_state.open_reports(t.spark, at, ["queue"], capacity=3)), "report_start")


@query("stream_final_snapshot", """
SELECT member_id, min(CASE WHEN kind = 'register' THEN ts END) AS started,
       max(CASE WHEN kind = 'remove' THEN ts END) AS ended, count(*) AS updates,
       max(CASE WHEN kind = 'remove' THEN ts END) IS NULL AS is_open
FROM v_beats GROUP BY member_id
""", "v_beats")
def _(t):
    seen = lifecycle.final_snapshot(beats(t, None), ["member_id"], "ts", F.col("kind") == "register",
                                    F.col("kind") == "remove").drop("is_open")
    rows = open_state.snapshot(seen, ["member_id"], ["started", "ended", "updates"])
    return ntz(rows.withColumn("is_open", F.col("ended").isNull()), "started", "ended")


@query("stream_quote_subscribe", """
SELECT event_id, event_type AS security, ts, value AS price FROM events
WHERE event_type IN (SELECT unnest(CASE WHEN c_custkey % 2 = 1 THEN ['view', 'click'] ELSE ['error'] END)
                     FROM customer WHERE c_custkey = (SELECT max(c_custkey) FROM customer))
""")
def _(t):
    lists = t.read("customer").select(
        F.lit(1).alias("client"), F.col("c_custkey").alias("seq"),
        F.when(F.col("c_custkey") % 2 == 1, F.array(F.lit("view"), F.lit("click")))
        .otherwise(F.array(F.lit("error"))).alias("securities"))
    quotes = events(t, None).select("event_id", F.col("event_type").alias("security"), "ts",
                                    F.col("value").alias("price"))
    return ntz(run.run_to_table(keyed.subscribed(quotes, lists)), "ts")


@query("stateful_upsert_sink", """
SELECT member_id, kind, event_id, ts, k FROM (
  SELECT *, row_number() OVER (PARTITION BY member_id, kind ORDER BY ts DESC, event_id DESC) AS rn
  FROM v_beats) x WHERE rn = 1
""", "v_beats")
def _(t):
    stream = beats(t, None, in_batches(t)).select("member_id", "kind", "event_id", "ts", "k")
    table = sinks.UpsertTable(t.spark, folder(t, "status"), stream.schema, ["member_id", "kind"],
                              ["ts", "event_id"])
    run.run_batches(stream, table.write_batch)
    table.compact(2)
    return ntz(table.read(), "ts")


@query("stream_delete_sink", """
SELECT member_id, event_id, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM v_beats) x WHERE rn = 1 AND kind <> 'failure'
""", "v_beats")
def _(t):
    op = F.when(F.col("kind") == "failure", "delete").otherwise("put")
    stream = beats(t, None, in_batches(t)).select("member_id", "event_id", "ts", op.alias("op"))
    table = sinks.UpsertTable(t.spark, folder(t, "status"), stream.schema, ["member_id"],
                              ["ts", "event_id"], op_col="op")
    run.run_batches(stream, table.write_batch)
    return ntz(table.read().drop("op"), "ts")


@query("stream_threshold_action", """
SELECT event_type, count(*) AS n FROM events GROUP BY event_type
HAVING count(*) > (SELECT count(*) // 8 FROM events)
""")
def _(t):
    """The last count that the action was called with, for each type above an eighth of all events."""
    called: dict[str, int] = {}
    counts = sinks.ThresholdCounts(t.spark, folder(t, "counts"), "event_type",
                                   t.read("events").count() // 8, called.__setitem__)
    run.run_batches(in_batches(t).select("event_type"), counts.write_batch)
    return t.spark.createDataFrame(list(called.items()), "event_type string, n bigint")


@query("stream_fanout_queues", """
SELECT q.queue, count(*) AS n, CAST(sum(e.event_id) AS BIGINT) AS checksum FROM events e
CROSS JOIN (VALUES ('shared'), ('appStatus'), ('executorManagement'), ('eventLog')) q(queue)
GROUP BY q.queue
""")
def _(t):
    base = folder(t, "queues")
    stream = events(t, None).select("event_id", "event_type")
    paths = {name: f"{base}/{name}" for name in sinks.QUEUES}
    for started in sinks.fan_out(stream, paths, f"{base}/state").values():
        started.awaitTermination()
    result = None
    for name, path in paths.items():
        rows = t.spark.read.schema(stream.schema).parquet(path).select(
            F.lit(name).alias("queue"), "event_id")
        result = rows if result is None else result.unionByName(rows)
    return result.groupBy("queue").agg(F.count(F.lit(1)).alias("n"),
                                       F.sum("event_id").alias("checksum"))


@query("isolate_errors", """
SELECT 'counts' AS handler, count(*) AS rows_seen, FALSE AS failed FROM events
UNION ALL SELECT 'broken', 0, count(CASE WHEN event_id >= 0 THEN 1 END) > 0 FROM events
UNION ALL SELECT 'errors', count(*), FALSE FROM events WHERE event_type = 'error'
""")
def _(t):
    base = folder(t, "isolated")
    names = ("counts", "broken", "errors")
    rows = t.read("events").select("event_id").limit(0)
    for name in names:
        rows.write.parquet(sinks.batch_folder(f"{base}/{name}", -1))

    def keep(name, rows_of):
        def handler(batch, batch_id):
            rows_of(batch).select("event_id").write.mode("overwrite").parquet(
                sinks.batch_folder(f"{base}/{name}", batch_id))
        return handler

    failures = sinks.FailureLog(t.spark, f"{base}-failures")
    # The first handler fails at the first row, inside its write.
    run.run_batches(events(t, None).select("event_id", "event_type"), sinks.isolated({
        "broken": keep("broken", lambda batch: batch.filter(F.assert_true(F.col("event_id") < 0).isNull())),
        "counts": keep("counts", lambda batch: batch),
        "errors": keep("errors", lambda batch: batch.filter(F.col("event_type") == "error"))}, failures))
    seen = None
    for name in names:
        part = t.spark.read.schema("event_id bigint").parquet(f"{base}/{name}").agg(
            F.count(F.lit(1)).alias("rows_seen")).select(F.lit(name).alias("handler"), "rows_seen")
        seen = part if seen is None else seen.unionByName(part)
    failed = failures.read().groupBy("handler").agg(F.count(F.lit(1)).alias("times"))
    return seen.join(failed, "handler", "left").select(
        "handler", "rows_seen", (F.coalesce("times", F.lit(0)) > 0).alias("failed"))


@query("late_rows", f"""
SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value, e.props FROM events e
JOIN (SELECT s.shift, max(m.newest) AS newest
      FROM (SELECT DISTINCT hour(ts) // 6 AS shift FROM events) s
      JOIN (SELECT hour(ts) // 6 AS shift, max(epoch_us(ts)) AS newest FROM events GROUP BY 1) m
        ON m.shift < s.shift GROUP BY s.shift) n ON n.shift = hour(e.ts) // 6
WHERE epoch_us(e.ts) <= n.newest - {48 * US_PER_HOUR}
""")
def _(t):
    # The events arrive in four shifts by hour of day, each shift as one batch.
    base, state = folder(t, "shifts"), folder(t, "late-state")
    late = sinks.LateRows(t.spark, folder(t, "late"), "ts", 48 * US_PER_HOUR)
    shifts = t.read("events").withColumn("shift", F.floor(F.hour("ts") / 6).cast("int"))
    for batch, shift in enumerate((0, 1, None, 2, 3)):  # the third batch is empty
        wanted = F.lit(False) if shift is None else F.col("shift") == shift
        shifts.filter(wanted).drop("shift").write.parquet(f"{base}/shift-{batch}")
        stream = run.event_stream(t.spark, f"{base}/*", t.read("events").schema)
        run.run_batches(stream, late.write_batch, checkpoint=state)
    return ntz(late.read(stream.schema), "ts")
