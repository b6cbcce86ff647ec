"""Queries: retention, running sums, failure windows, run detection."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import windows
from .registry import query

US_PER_HOUR = 3_600_000_000

RETAIN_SQL = """
  SELECT {cols} FROM (
    SELECT x.*, n.size, n.size > {limit} AS over,
           greatest({limit} // 10, n.size - {limit}) AS gone,
           row_number() OVER (PARTITION BY x.{scope}, removable ORDER BY {order}) AS rn
    FROM (SELECT *, {removable} AS removable, {counted} AS counted FROM {table}) x
    JOIN (SELECT {scope}, count(CASE WHEN {counted} THEN 1 END) AS size FROM {table}
          GROUP BY {scope}) n ON n.{scope} = x.{scope}) y
  WHERE NOT over OR NOT removable OR rn > gone
"""


@query("retention_finished", RETAIN_SQL.format(
    cols="pool, job_id, status, submission_time", limit=50, scope="pool", table="v_jobs",
    removable="status <> 'RUNNING'", counted="TRUE", order="submission_time, job_id"), "v_jobs")
def _(t):
    return (windows.retain(t.jobs, ["pool"], ["submission_time", "job_id"], 50,
                           F.col("status") != "RUNNING")
            .select("pool", "job_id", "status", "submission_time"))


@query("retention_dead", RETAIN_SQL.format(
    cols="host_id, id, is_active", limit=3, scope="host_id", table="v_executors",
    removable="NOT is_active", counted="NOT is_active", order="id"), "v_executors")
def _(t):
    dead = ~F.col("is_active")
    return (windows.retain(t.executors.select("host_id", "id", "is_active"), ["host_id"], ["id"],
                           3, dead, counted=dead).select("host_id", "id", "is_active"))


@query("retention_tasks", """
SELECT stage_id, job_id, task_index, part_id FROM (
  SELECT *, count(*) OVER (PARTITION BY stage_id) AS size,
         row_number() OVER (PARTITION BY stage_id
           ORDER BY CASE WHEN outcome = 'killed' THEN 1 ELSE 0 END, launch_time, job_id,
                    task_index, part_id, run_time, input_bytes) AS rn FROM v_tasks) x
WHERE size <= 590 OR rn > greatest(59, size - 590)
""", "v_tasks")
def _(t):
    return (windows.retain_tasks(
        t.tasks, ["stage_id"],
        ["launch_time", "job_id", "task_index", "part_id", "run_time", "input_bytes"], 590,
        F.col("outcome") == "killed").select("stage_id", "job_id", "task_index", "part_id"))


@query("clamped_running_sum", """
SELECT event_id, member_id, s - least(0, min(s) OVER (PARTITION BY member_id ORDER BY ts, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS usage
FROM (SELECT *, CAST(sum(delta) OVER (PARTITION BY member_id ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS s FROM v_deltas) x
""", "v_deltas")
def _(t):
    return (windows.clamped_sum(t.deltas, ["member_id"], ["ts", "event_id"], "delta")
            .select("event_id", "member_id", "usage"))


@query("running_gauge", """
SELECT host_id, instant, CAST(sum(change) OVER (PARTITION BY host_id ORDER BY instant) AS BIGINT)
  AS open
FROM (SELECT host_id, instant, sum(change) AS change FROM (
        SELECT host_id, launch_time AS instant, 1 AS change FROM v_tasks
        UNION ALL
        SELECT host_id, launch_time + to_days(CAST(task_index AS INT)), -1 FROM v_tasks) c
      GROUP BY host_id, instant) g
""", "v_tasks")
def _(t):
    spans = t.tasks.withColumn("end_time", F.expr(
        "launch_time + make_dt_interval(task_index, 0, 0, 0)"))
    return windows.running_gauge(spans, ["host_id"], "launch_time", "end_time")


@query("metric_delta", """
SELECT event_id, member_id, delta - coalesce(lag(delta) OVER (
  PARTITION BY member_id, block_id ORDER BY ts, event_id), 0) AS step FROM v_deltas
""", "v_deltas")
def _(t):
    return (windows.metric_delta(t.deltas, ["member_id", "block_id"], ["ts", "event_id"],
                                 "delta", name="step").select("event_id", "member_id", "step"))


FAILURES_SQL = """
SELECT DISTINCT {key} ts, count(*) OVER ({part} ORDER BY ts
    RANGE BETWEEN INTERVAL 48 HOUR PRECEDING AND CURRENT ROW) AS recent_failures
FROM v_beats WHERE kind = 'failure'
"""


@query("failures_in_interval", FAILURES_SQL.format(key="host_id,", part="PARTITION BY host_id"),
       "v_beats")
def _(t):
    failures = t.beats.filter(F.col("kind") == "failure")
    result = windows.failures_in_interval(failures, ["host_id"], "ts", 48 * US_PER_HOUR)
    return result.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("failures_in_interval_overall", FAILURES_SQL.format(key="", part=""), "v_beats")
def _(t):
    failures = t.beats.filter(F.col("kind") == "failure")
    result = windows.failures_in_interval(failures, [], "ts", 48 * US_PER_HOUR)
    return result.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("register_outcome", """
WITH bad AS (SELECT s_nationkey AS host_id FROM supplier GROUP BY s_nationkey
             HAVING avg(s_acctbal) < 4000),
r AS (SELECT b.*, b.host_id + CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END AS on_host FROM v_beats b
      WHERE kind = 'register'),
m AS (SELECT r.*, on_host IN (SELECT host_id FROM bad) AS bad FROM r),
f AS (SELECT member_id, min(event_id) AS first_id FROM m WHERE NOT bad GROUP BY member_id)
SELECT m.event_id, m.member_id,
       CASE WHEN m.event_id = f.first_id THEN 'accepted'
            WHEN f.first_id < m.event_id THEN 'duplicate' ELSE 'rejected' END AS outcome,
       CASE WHEN m.event_id = f.first_id THEN CAST(m.k % 8 + 1 AS BIGINT) ELSE 0 END AS added_cores
FROM m LEFT JOIN f ON f.member_id = m.member_id
""", "v_beats")
def _(t):
    registrations = t.beats.filter(F.col("kind") == "register").select(
        "event_id", "member_id", "ts", (F.col("k") % 8 + 1).alias("cores"),
        (F.col("host_id") + F.when(F.col("k") % 3 == 0, 1).otherwise(0)).alias("host_id"))
    bad = (t.read("supplier").groupBy(F.col("s_nationkey").alias("host_id"))
           .agg(F.avg("s_acctbal").alias("mean")).filter(F.col("mean") < 4000))
    return (windows.register_outcome(registrations, "member_id", ["ts", "event_id"], "event_id",
                                     bad, "host_id", "cores")
            .select("event_id", "member_id", "outcome", "added_cores"))


@query("resource_dedup", """
SELECT event_id, CASE WHEN event_id = first_id THEN 'accepted'
                      WHEN uri = first_uri THEN 'same path' ELSE 'same name' END AS outcome
FROM (SELECT event_id, uri, min(event_id) OVER (PARTITION BY host_id, name) AS first_id,
             first(uri) OVER (PARTITION BY host_id, name ORDER BY event_id) AS first_uri
      FROM (SELECT event_id, host_id, concat('part-', CAST(k AS VARCHAR)) AS name,
                   concat('hdfs://nn/', kind, '/part-', CAST(k AS VARCHAR)) AS uri
            FROM v_beats) f) x
""", "v_beats")
def _(t):
    name = F.concat(F.lit("part-"), F.col("k").cast("string"))
    resources = t.beats.select("event_id", "host_id", name.alias("name"),
                               F.concat(F.lit("hdfs://nn/"), F.col("kind"), F.lit("/"), name)
                               .alias("uri"))
    return (windows.resource_dedup(resources, ["host_id"], "uri", "name", ["event_id"],
                                   "event_id").select("event_id", "outcome"))


@query("row_groups", """
WITH numbered AS (
  SELECT user_id, event_type, CASE WHEN value < 30 THEN 'low' ELSE 'high' END AS band,
         row_number() OVER w AS rn,
         lag(event_type) OVER w AS before_type,
         lag(CASE WHEN value < 30 THEN 'low' ELSE 'high' END) OVER w AS before_band
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
grouped AS (
  SELECT *, sum(CASE WHEN rn = 1 OR event_type <> before_type THEN 1 ELSE 0 END) OVER w AS g0,
         sum(CASE WHEN rn = 1 OR event_type <> before_type OR band <> before_band
             THEN 1 ELSE 0 END) OVER w AS g1
  FROM numbered WINDOW w AS (PARTITION BY user_id ORDER BY rn))
SELECT user_id, 'event_type' AS "column", CAST(g0 AS BIGINT) AS "group", min(rn) AS first_row,
       count(*) AS span, min(event_type) AS value FROM grouped GROUP BY user_id, g0
UNION ALL
SELECT user_id, 'band', CAST(g1 AS BIGINT), min(rn), count(*), min(band)
FROM grouped GROUP BY user_id, g1
""")
def _(t):
    rows = t.read("events").select("user_id", "event_type", "ts", "event_id",
                                   F.when(F.col("value") < 30, "low").otherwise("high")
                                   .alias("band"))
    return windows.row_groups(rows, ["user_id"], ["ts", "event_id"], ["event_type", "band"])


@query("consecutive_failures", """
SELECT event_id, member_id, in_a_row FROM (
  SELECT *, CASE WHEN failed THEN rn - coalesce(max(CASE WHEN NOT failed THEN rn END) OVER (
             PARTITION BY member_id ORDER BY rn), 0) ELSE 0 END AS in_a_row
  FROM (SELECT *, event_type IN ('error', 'view') AS failed, user_id AS member_id,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
        FROM events) x) y WHERE in_a_row = 5
""")
def _(t):
    events = t.read("events").select("event_id", F.col("user_id").alias("member_id"), "ts",
                                     "event_type")
    return (windows.give_up(events, ["member_id"], ["ts", "event_id"],
                            F.col("event_type").isin("error", "view"))
            .select("event_id", "member_id", F.col("in_a_row").cast("bigint").alias("in_a_row")))
