"""Queries: liveness, sessions, bars, overflow, throttling, exclusion (batch)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import keyed, liveness, sequential
from .registry import query

US_PER_HOUR = 3_600_000_000
TIMEOUT = 12 * US_PER_HOUR
CHECK = 6 * US_PER_HOUR


def ntz(df, *names):
    for name in names:
        df = df.withColumn(name, F.col(name).cast("timestamp_ntz"))
    return df


LIVE_SQL = f"""
e AS (SELECT event_id, member_id, kind, ts, epoch_us(ts) AS us FROM v_beats
      WHERE kind IN ('register', 'heartbeat', 'remove')),
n AS (SELECT *, lead(us) OVER w AS next_at, ((us + {TIMEOUT}) // {CHECK} + 1) * {CHECK} AS tick
      FROM e WINDOW w AS (PARTITION BY member_id ORDER BY us, event_id)),
c AS (SELECT *, CASE WHEN kind = 'remove' THEN us * 2 + 1
                     WHEN tick <= coalesce(next_at, (SELECT max(epoch_us(ts)) FROM events))
                     THEN tick * 2 END AS ending FROM n),
s AS (SELECT *, min(ending) OVER (PARTITION BY member_id ORDER BY us, event_id
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS iend FROM c),
intervals AS (
  SELECT member_id, make_timestamp(min(CASE WHEN kind = 'register' THEN us END)) AS start,
         make_timestamp(iend // 2) AS "end",
         CASE WHEN iend IS NULL THEN 'open' WHEN iend % 2 = 1 THEN 'removed' ELSE 'expired' END
           AS end_reason,
         make_timestamp(max(us)) AS last_seen
  FROM s WHERE kind <> 'remove' GROUP BY member_id, iend
  HAVING count(CASE WHEN kind = 'register' THEN 1 END) > 0)
"""


def intervals(t):
    return liveness.live_intervals(t.beats, "member_id", "ts", "event_id", "kind", TIMEOUT, CHECK,
                                   until_us=liveness.horizon(t.beats, "ts"))


@query("live_intervals", f"WITH {LIVE_SQL} SELECT * FROM intervals", "v_beats")
def _(t):
    return ntz(intervals(t), "start", "end", "last_seen")


@query("expire_silent", f"""
WITH {LIVE_SQL} SELECT member_id, "end" AS tick,
  (epoch_us("end") - epoch_us(last_seen)) // 1000 AS silence_ms
FROM intervals WHERE end_reason = 'expired'
""", "v_beats")
def _(t):
    return ntz(liveness.expire_silent(intervals(t), "member_id"), "tick")


@query("live_count", f"""
WITH {LIVE_SQL},
bounds AS (SELECT min((epoch_us(start) // {CHECK} + 1) * {CHECK}) AS a,
                  (SELECT max(epoch_us(ts)) FROM events) // {CHECK} * {CHECK} AS b
           FROM intervals),
ticks AS (SELECT unnest(generate_series(a, b, {CHECK})) AS us FROM bounds)
SELECT make_timestamp(t.us) AS tick, CAST(count(i.member_id) AS BIGINT) AS live FROM ticks t
LEFT JOIN intervals i ON epoch_us(i.start) < t.us AND (i."end" IS NULL
  OR (i.end_reason = 'expired' AND epoch_us(i."end") > t.us)
  OR (i.end_reason = 'removed' AND epoch_us(i."end") >= t.us))
GROUP BY t.us
""", "v_beats")
def _(t):
    until = liveness.horizon(t.beats, "ts")
    return ntz(liveness.live_count(intervals(t), CHECK, until), "tick")


@query("reregister_requests", f"""
WITH {LIVE_SQL}
SELECT b.event_id, b.member_id, b.host_id, b.ts, b.k, b.kind FROM v_beats b
WHERE b.kind = 'heartbeat' AND NOT EXISTS (
  SELECT 1 FROM intervals i WHERE i.member_id = b.member_id AND i.start < b.ts
    AND (i."end" IS NULL OR i."end" > b.ts))
""", "v_beats")
def _(t):
    return liveness.reregister_requests(t.beats, "member_id", "ts", "event_id", "kind", TIMEOUT,
                                        CHECK)


WORKERS_SQL = f"""
WITH RECURSIVE e AS (
  SELECT member_id, kind, epoch_us(ts) AS us, row_number() OVER (
           PARTITION BY member_id ORDER BY ts, event_id) AS rn
  FROM v_beats WHERE kind IN ('register', 'heartbeat')),
walk AS (
  SELECT member_id, 0::BIGINT AS rn, NULL::BIGINT AS reg, NULL::BIGINT AS beat,
         NULL::BIGINT AS done_reg, NULL::BIGINT AS done_at
  FROM (SELECT DISTINCT member_id FROM e) m
  UNION ALL
  SELECT member_id, rn,
         CASE WHEN gone IS NOT NULL OR reg IS NULL THEN CASE WHEN kind = 'register' THEN us END
              ELSE reg END,
         CASE WHEN gone IS NOT NULL OR reg IS NULL THEN NULL
              WHEN kind = 'heartbeat' THEN us ELSE beat END,
         CASE WHEN gone IS NOT NULL THEN reg END, gone
  FROM (SELECT w.member_id, e.rn, e.kind, e.us, w.reg, w.beat,
               CASE WHEN w.reg IS NOT NULL AND w.beat IS NULL
                      AND (w.reg // {CHECK} + 1) * {CHECK} <= e.us
                    THEN (w.reg // {CHECK} + 1) * {CHECK}
                    WHEN w.reg IS NOT NULL AND w.beat IS NOT NULL
                      AND ((w.beat + {CHECK}) // {CHECK} + 1) * {CHECK} <= e.us
                    THEN ((w.beat + {CHECK}) // {CHECK} + 1) * {CHECK} END AS gone
        FROM walk w JOIN e ON e.member_id = w.member_id AND e.rn = w.rn + 1) x),
open_end AS (
  SELECT member_id, reg, CASE WHEN beat IS NULL THEN (reg // {CHECK} + 1) * {CHECK}
                              ELSE ((beat + {CHECK}) // {CHECK} + 1) * {CHECK} END AS due
  FROM (SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY rn DESC) AS back FROM walk) l
  WHERE back = 1 AND reg IS NOT NULL)
SELECT member_id, make_timestamp(done_reg) AS registered, make_timestamp(done_at) AS expired
FROM walk WHERE done_reg IS NOT NULL
UNION ALL
SELECT member_id, make_timestamp(reg), CASE WHEN due <= (SELECT max(epoch_us(ts)) FROM events)
  THEN make_timestamp(due) END FROM open_end
"""


@query("expire_workers", WORKERS_SQL, "v_beats")
def _(t):
    until = liveness.horizon(t.beats, "ts")
    return ntz(liveness.expire_workers(t.beats, "member_id", "ts", "event_id", "kind", CHECK,
                                       until), "registered", "expired")


@query("liveness_sessions", f"""
SELECT member_id, min(ts) AS start, max(ts) AS last_seen, count(*) AS beats FROM (
  SELECT *, sum(fresh) OVER (PARTITION BY member_id ORDER BY ts, event_id) AS session FROM (
    SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY member_id
                     ORDER BY ts, event_id)) <= {TIMEOUT} THEN 0 ELSE 1 END AS fresh
    FROM v_beats WHERE kind = 'heartbeat') a) b
GROUP BY member_id, session
""", "v_beats")
def _(t):
    beats = t.beats.filter(F.col("kind") == "heartbeat")
    return liveness.liveness_sessions(beats, "member_id", "ts", "event_id", TIMEOUT)


@query("sliding_failures", f"""
SELECT host_id, make_timestamp(w * {6 * US_PER_HOUR}) AS window_start,
       make_timestamp(w * {6 * US_PER_HOUR} + {48 * US_PER_HOUR}) AS window_end,
       count(*) AS failures
FROM (SELECT host_id, unnest(generate_series(epoch_us(ts) // {6 * US_PER_HOUR} - 7,
                                             epoch_us(ts) // {6 * US_PER_HOUR})) AS w
      FROM v_beats WHERE kind = 'failure') x GROUP BY host_id, w
""", "v_beats")
def _(t):
    failures = t.beats.filter(F.col("kind") == "failure")
    return ntz(liveness.sliding_failures(failures, ["host_id"], "ts", "48 hours", "6 hours"),
               "window_start", "window_end")


BARS_SQL = """
SELECT security, date_trunc('hour', ts) AS bar_start, max(price) AS high, min(price) AS low,
       arg_min(price, event_id) AS open, arg_max(price, event_id) AS close, count(*) AS quotes
FROM v_quotes GROUP BY security, date_trunc('hour', ts)
"""


@query("quote_bars", BARS_SQL, "v_quotes")
def _(t):
    return ntz(liveness.quote_bars(t.quotes, "1 hour"), "bar_start")


@query("register_dedup", """
SELECT member_id, min(event_id) AS event_id FROM v_beats WHERE kind = 'register' GROUP BY member_id
""", "v_beats")
def _(t):
    registrations = t.beats.filter(F.col("kind") == "register").select("member_id", "event_id",
                                                                       "ts")
    return (keyed.first_by_key(registrations, ["member_id"], ["ts", "event_id"])
            .select("member_id", "event_id"))


@query("overflow_report", """
SELECT queue, date_trunc('hour', ts) AS report_start, count(*) AS received,
       greatest(count(*) - 3, 0) AS dropped
FROM (SELECT event_type AS queue, ts FROM events) e GROUP BY queue, date_trunc('hour', ts)
""")
def _(t):
    events = t.read("events").select(F.col("event_type").alias("queue"), "ts")
    return ntz(liveness.overflow_report(events, "ts", "1 hour", capacity=3), "report_start")


THROTTLE_SQL = f"""
WITH RECURSIVE r AS (
  SELECT event_id, user_id AS member_id, ts, epoch_us(ts) AS us, event_type = 'purchase' AS terminal,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
walk AS (
  SELECT member_id, rn, event_id, ts, us AS last, TRUE AS emitted FROM r WHERE rn = 1
  UNION ALL
  SELECT r.member_id, r.rn, r.event_id, r.ts,
         CASE WHEN r.terminal OR r.us - w.last > {24 * US_PER_HOUR} THEN r.us ELSE w.last END,
         r.terminal OR r.us - w.last > {24 * US_PER_HOUR}
  FROM walk w JOIN r ON r.member_id = w.member_id AND r.rn = w.rn + 1)
SELECT member_id, event_id, ts FROM walk WHERE emitted
"""


@query("throttle", THROTTLE_SQL)
def _(t):
    rows = t.read("events").select("event_id", F.col("user_id").alias("member_id"), "ts",
                                   (F.col("event_type") == "purchase").alias("terminal"))
    return sequential.throttle(rows, ["member_id"], "ts", "event_id", 24 * US_PER_HOUR, "terminal")


EXCLUSION_SQL = f"""
WITH RECURSIVE f AS (
  SELECT host_id, event_id, ts, epoch_us(ts) AS us, row_number() OVER (
    PARTITION BY host_id ORDER BY ts, event_id) AS rn FROM v_beats WHERE kind = 'failure'),
walk AS (
  SELECT host_id, 0::BIGINT AS rn, NULL::BIGINT AS event_id, NULL::TIMESTAMP AS ts,
         FALSE AS tracked, 0::BIGINT AS recent, NULL::BIGINT AS started, -1::BIGINT AS until,
         []::BIGINT[] AS times
  FROM (SELECT DISTINCT host_id FROM f) h
  UNION ALL
  SELECT host_id, rn, event_id, ts, tracked, CASE WHEN tracked THEN len(times) ELSE 0 END,
         CASE WHEN tracked AND len(times) > 2 THEN us + {36 * US_PER_HOUR} END,
         CASE WHEN tracked AND len(times) > 2 THEN us + {36 * US_PER_HOUR} ELSE until END, times
  FROM (SELECT f.host_id, f.rn, f.event_id, f.ts, f.us, w.until, f.us >= w.until AS tracked,
               CASE WHEN f.us >= w.until THEN list_filter(list_append(w.times, f.us),
                         lambda x: x >= f.us - {48 * US_PER_HOUR}) ELSE w.times END AS times
        FROM walk w JOIN f ON f.host_id = w.host_id AND f.rn = w.rn + 1) x)
SELECT host_id, event_id, ts, tracked, recent, make_timestamp(started) AS excluded_until
FROM walk WHERE rn > 0
"""


@query("exclusion_windows", EXCLUSION_SQL, "v_beats")
def _(t):
    failures = t.beats.filter(F.col("kind") == "failure")
    return ntz(sequential.exclusion_windows(failures, "host_id", "ts", "event_id", 2,
                                            48 * US_PER_HOUR, 36 * US_PER_HOUR),
               "excluded_until")
