"""Queries: event folding, placement of blocks, exclusion flags, change logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lifecycle
from .registry import query

US_PER_HOUR = 3_600_000_000


@query("member_lifecycle", """
SELECT member_id, min(CASE WHEN kind = 'register' THEN ts END) AS add_time,
       max(CASE WHEN kind = 'remove' THEN ts END) AS remove_time,
       max(CASE WHEN kind = 'remove' THEN concat('reason ', CAST(k AS VARCHAR)) END)
         AS remove_reason,
       arg_max(CASE WHEN kind = 'register' THEN k % 8 + 1 END,
               CASE WHEN kind = 'register' THEN event_id END) AS total_cores,
       max(CASE WHEN kind = 'remove' THEN ts END) IS NULL AS is_active,
       CAST(arg_max(CASE WHEN kind = 'register' THEN k % 8 + 1 END,
                    CASE WHEN kind = 'register' THEN event_id END) // 2 AS BIGINT) AS max_tasks
FROM (SELECT *, count(CASE WHEN kind = 'remove' THEN 1 END) OVER (
          PARTITION BY member_id ORDER BY ts, event_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stay
      FROM v_beats WHERE kind IN ('register', 'remove')) x
GROUP BY member_id, stay HAVING count(CASE WHEN kind = 'register' THEN 1 END) > 0
""", "v_beats")
def _(t):
    events = t.beats.withColumn("cores", F.col("k") % 8 + 1).withColumn(
        "reason", F.concat(F.lit("reason "), F.col("k").cast("string")))
    return lifecycle.member_lifecycle(events, "member_id", "ts", "event_id", "kind", "cores",
                                      "reason", cores_per_task=2, add="register")


@query("attempt_duration", """
SELECT member_id, attempt, min(CASE WHEN kind = 'register' THEN ts END) AS start_time,
       max(CASE WHEN kind = 'remove' THEN ts END) AS end_time,
       coalesce(epoch_us(max(CASE WHEN kind = 'remove' THEN ts END)) // 1000
         - epoch_us(min(CASE WHEN kind = 'register' THEN ts END)) // 1000, -1) AS duration,
       max(CASE WHEN kind = 'remove' THEN ts END) IS NOT NULL AS completed
FROM (SELECT *, k % 4 AS attempt FROM v_beats) b GROUP BY member_id, attempt
HAVING count(CASE WHEN kind = 'register' THEN 1 END) > 0
""", "v_beats")
def _(t):
    return lifecycle.attempt_duration(t.beats.withColumn("attempt", F.col("k") % 4),
                                      ["member_id", "attempt"], "ts", "kind",
                                      start="register", end="remove")


@query("host_to_members", """
SELECT h.event_id, h.host_id, m.member_id FROM v_beats h
JOIN (SELECT DISTINCT member_id, host_id FROM v_beats) m ON m.host_id = h.host_id
WHERE h.kind = 'remove'
""", "v_beats")
def _(t):
    hosts = t.beats.filter(F.col("kind") == "remove").select("event_id", "host_id")
    members = t.beats.select("member_id", "host_id").distinct()
    return lifecycle.host_to_members(hosts, members).select("event_id", "host_id", "member_id")


@query("exclusion_status", """
SELECT m.member_id, m.host_id, coalesce(e.excluded, FALSE) AS excluded
FROM (SELECT DISTINCT member_id, host_id FROM v_beats) m
LEFT JOIN (SELECT member_id, arg_max(excluded, event_id) AS excluded FROM (
    SELECT member_id, event_id, kind = 'failure' AS excluded FROM v_beats
    WHERE kind IN ('failure', 'register')
    UNION ALL
    SELECT m.member_id, h.event_id, h.k % 2 = 0 FROM v_beats h
    JOIN (SELECT DISTINCT member_id, host_id FROM v_beats) m ON m.host_id = h.host_id
    WHERE h.kind = 'remove') u GROUP BY member_id) e ON e.member_id = m.member_id
""", "v_beats")
def _(t):
    kind = F.col("kind")
    own = t.beats.filter(kind.isin("failure", "register")).withColumn(
        "excluded", kind == "failure")
    hosts = t.beats.filter(kind == "remove").withColumn("excluded", F.col("k") % 2 == 0)
    members = t.beats.select("member_id", "host_id").distinct()
    return lifecycle.exclusion_status(own, hosts, members, seq=["event_id"])


@query("stage_exclusions", """
SELECT DISTINCT stage_id, executor_id FROM v_tasks
WHERE outcome = 'failed' AND stage_id NOT IN (SELECT id FROM v_executors WHERE NOT is_active)
""", "v_tasks v_executors")
def _(t):
    failed = t.tasks.filter(F.col("outcome") == "failed").select("stage_id", "executor_id")
    done = (t.read("supplier").filter(F.col("s_acctbal") < 3000)
            .select(F.col("s_suppkey").alias("stage_id")))
    return lifecycle.stage_exclusions(failed, done)


PLACED_SQL = """
placed AS (SELECT dataset, part, member_id FROM (
  SELECT block_id AS dataset, event_id % 8 AS part, member_id, delta > -30 AS valid,
         row_number() OVER (PARTITION BY block_id, event_id % 8, member_id
                            ORDER BY ts DESC, event_id DESC) AS rn FROM v_deltas) x
  WHERE rn = 1 AND valid)
"""


def placed_blocks(t):
    updates = t.deltas.select(F.col("block_id").alias("dataset"),
                              (F.col("event_id") % 8).alias("part"), "member_id", "ts",
                              "event_id", (F.col("delta") > -30).alias("valid"))
    return lifecycle.block_placement(updates, "dataset", "part", "member_id",
                                     ["ts", "event_id"])


@query("block_placement", f"""
WITH {PLACED_SQL} SELECT dataset, part, member_id FROM placed
""", "v_deltas")
def _(t):
    return placed_blocks(t).select("dataset", "part", "member_id")


@query("block_placement_counts", f"""
WITH {PLACED_SQL}
SELECT 'partition' AS level, concat(dataset, '/', CAST(part AS VARCHAR)) AS name, count(*) AS n
FROM placed GROUP BY dataset, part
UNION ALL SELECT 'dataset', dataset, count(DISTINCT part) FROM placed GROUP BY dataset
UNION ALL SELECT 'member', CAST(member_id AS VARCHAR), count(*) FROM placed GROUP BY member_id
""", "v_deltas")
def _(t):
    return lifecycle.placement_counts(placed_blocks(t), "dataset", "part", "member_id")


@query("stream_blocks", """
SELECT block_id, member_id, event_id, delta FROM (
  SELECT *, row_number() OVER (PARTITION BY block_id, member_id ORDER BY ts DESC, event_id DESC)
    AS rn FROM v_deltas) x WHERE rn = 1 AND delta > -40
""", "v_deltas")
def _(t):
    updates = t.deltas.withColumn("valid", F.col("delta") > -40)
    return (lifecycle.stream_blocks(updates, ["block_id", "member_id"], ["ts", "event_id"])
            .select("block_id", "member_id", "event_id", "delta"))


@query("unpersist_adjust", """
SELECT u.member_id, greatest(u.memory_used - coalesce(d.m, 0), 0) AS memory_used,
       greatest(u.disk_used - coalesce(d.d, 0), 0) AS disk_used,
       u.blocks - coalesce(d.b, 0) AS blocks
FROM (SELECT member_id, CAST(sum(k) AS BIGINT) * 2 AS memory_used,
             CAST(sum(k) AS BIGINT) AS disk_used, count(*) AS blocks
      FROM v_beats GROUP BY member_id) u
LEFT JOIN (SELECT user_id AS member_id, CAST(sum(CAST(floor(value) AS BIGINT) * 3) AS BIGINT) AS m,
                  CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS d, count(*) AS b
           FROM events WHERE event_type IN ('view', 'click') GROUP BY user_id) d
  ON d.member_id = u.member_id
""", "v_beats")
def _(t):
    usage = t.beats.groupBy("member_id").agg(
        (F.sum("k") * 2).alias("memory_used"), F.sum("k").alias("disk_used"),
        F.count(F.lit(1)).alias("blocks"))
    size = F.floor("value").cast("bigint")
    placed = t.read("events").select(F.col("user_id").alias("member_id"),
                                     F.col("event_type").alias("dataset"),
                                     (size * 3).alias("memory_used"), size.alias("disk_used"))
    dropped = (t.read("events").select(F.col("event_type").alias("dataset"))
               .filter(F.col("dataset").isin("view", "click")).distinct())
    return lifecycle.unpersist_adjust(usage, placed, dropped, "member_id", "dataset")


@query("environment_kv", """
SELECT s_suppkey AS scope, 'JVM Information' AS section, 'Java Home' AS key, s_name AS value
FROM supplier
UNION ALL SELECT s_suppkey, 'Spark Properties', 'spark.task.cpus',
  CASE WHEN s_suppkey % 5 = 0 THEN 'many' ELSE CAST(s_suppkey % 5 AS VARCHAR) END FROM supplier
UNION ALL SELECT s_suppkey, 'Spark Properties', 'spark.app.name', s_name FROM supplier
""")
def _(t):
    return lifecycle.environment_kv(environments(t), "scope", {
        "JVM Information": "jvm", "Spark Properties": "properties"})


def environments(t):
    key = F.col("s_suppkey")
    cpus = F.when(key % 5 == 0, "many").otherwise((key % 5).cast("string"))
    return t.read("supplier").select(
        key.alias("scope"), F.create_map(F.lit("Java Home"), F.col("s_name")).alias("jvm"),
        F.create_map(F.lit("spark.task.cpus"), cpus, F.lit("spark.app.name"), F.col("s_name"))
        .alias("properties"))


@query("cores_per_task", """
SELECT s_suppkey AS scope, CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE CAST(s_suppkey % 5 AS INT) END
  AS cores_per_task FROM supplier
""")
def _(t):
    rows = lifecycle.environment_kv(environments(t), "scope", {"Spark Properties": "properties"})
    return lifecycle.cores_per_task(rows, "scope", "Spark Properties")


@query("status_change_log", """
SELECT member_id, event_id, ts, state FROM (
  SELECT *, lag(state) OVER w AS before,
         count(CASE WHEN state IN ('FINISHED', 'FAILED', 'KILLED') THEN 1 END) OVER (
           PARTITION BY member_id ORDER BY ts, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS done
  FROM (SELECT member_id, event_id, ts, CASE WHEN kind = 'register' THEN 'SUBMITTED'
               WHEN kind = 'heartbeat' THEN CASE WHEN k < 20 THEN 'ACCEPTED' ELSE 'RUNNING' END
               WHEN kind = 'remove' AND k > 80 THEN 'FINISHED'
               WHEN kind = 'failure' AND k = 99 THEN 'FAILED' ELSE 'RUNNING' END AS state
        FROM v_beats) s
  WINDOW w AS (PARTITION BY member_id ORDER BY ts, event_id)) x
WHERE done = 0 AND state IS DISTINCT FROM before
""", "v_beats")
def _(t):
    kind, k = F.col("kind"), F.col("k")
    state = (F.when(kind == "register", "SUBMITTED")
             .when(kind == "heartbeat", F.when(k < 20, "ACCEPTED").otherwise("RUNNING"))
             .when((kind == "remove") & (k > 80), "FINISHED")
             .when((kind == "failure") & (k == 99), "FAILED").otherwise("RUNNING"))
    reports = t.beats.select("member_id", "event_id", "ts", state.alias("state"))
    return lifecycle.status_change_log(reports, "member_id", ["ts", "event_id"])


@query("final_snapshot", """
SELECT member_id, min(CASE WHEN kind = 'register' THEN ts END) AS started,
       max(CASE WHEN kind = 'remove' THEN ts END) AS ended, count(*) AS updates,
       max(CASE WHEN kind = 'remove' THEN ts END) IS NULL AS is_open
FROM v_beats GROUP BY member_id
""", "v_beats")
def _(t):
    return lifecycle.final_snapshot(t.beats, ["member_id"], "ts", F.col("kind") == "register",
                                    F.col("kind") == "remove")
