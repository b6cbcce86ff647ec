"""Queries: sources, sinks and keyed state."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import keyed
from ..operators.rollup import executor_rollup
from ..session import scratch_folder
from ..sources import event_log, files
from ..streaming.sinks import QUEUES
from .registry import query

EVENT_SCHEMAS = {
    name: "event_id bigint, user_id bigint, value double, props struct<k: int>"
    for name in ("purchase", "signup", "error", "view", "click")
}


def _scratch(tables, name: str) -> str:
    import uuid
    return f"{scratch_folder(tables.spark)}/{name}-{uuid.uuid4().hex}"


@query("executor_rollup", """
SELECT concat(label, '(', CAST(members AS VARCHAR), ')') AS label, members, total_cores,
       on_heap_used, failed, completed, killed, total_tasks, total_duration, total_gc,
       input_bytes, is_blacklisted
FROM (
  SELECT CASE WHEN grouping(is_active) = 1 THEN 'Total' WHEN is_active THEN 'Active'
              ELSE 'Dead' END AS label,
         count(*) AS members,
         CAST(sum(total_cores) AS BIGINT) AS total_cores,
         CAST(sum(coalesce(on_heap_used, 0)) AS BIGINT) AS on_heap_used,
         CAST(sum(coalesce(failed, 0)) AS BIGINT) AS failed,
         CAST(sum(coalesce(completed, 0)) AS BIGINT) AS completed,
         CAST(sum(coalesce(killed, 0)) AS BIGINT) AS killed,
         CAST(sum(coalesce(total_tasks, 0)) AS BIGINT) AS total_tasks,
         CAST(sum(coalesce(total_duration, 0)) AS BIGINT) AS total_duration,
         CAST(sum(coalesce(total_gc, 0)) AS BIGINT) AS total_gc,
         CAST(sum(coalesce(input_bytes, 0)) AS BIGINT) AS input_bytes,
         CAST(sum(CASE WHEN is_blacklisted THEN 1 ELSE 0 END) AS BIGINT) AS is_blacklisted
  FROM v_executors GROUP BY GROUPING SETS ((is_active), ())) r
""", "v_executors")
def _(t):
    return executor_rollup(
        t.executors, ["total_cores", "on_heap_used", "failed", "completed", "killed",
                      "total_tasks", "total_duration", "total_gc", "input_bytes"],
        flags=["is_blacklisted"])


@query("event_log_parse", """
SELECT event_type AS event, event_id, user_id, value, k FROM (
  SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events) e
""")
def _(t):
    lines = t.read("events").select(F.to_json(F.struct(
        F.col("event_type").alias("Event"), "event_id", "user_id", "value",
        F.from_json("props", "k int").alias("props"))).alias("value"))
    path = _scratch(t, "log")
    lines.write.text(path)
    parsed = event_log.read_parsed_events(t.spark, path, EVENT_SCHEMAS)
    body = F.coalesce(*EVENT_SCHEMAS)
    return parsed.select("event", body["event_id"].alias("event_id"), body["user_id"].alias("user_id"),
                         body["value"].alias("value"), body["props"]["k"].alias("k"))


@query("event_log_quarantine", """
SELECT CASE event_id % 50 WHEN 1 THEN 'mystery' WHEN 0 THEN NULL WHEN 2 THEN NULL ELSE event_type END AS event,
       CASE WHEN event_id % 50 > 3 THEN event_id END AS event_id,
       CASE WHEN event_id % 50 > 3 THEN value END AS value,
       CASE event_id % 50 WHEN 0 THEN 'no event type' WHEN 1 THEN 'unknown event type'
         WHEN 2 THEN 'no event type' WHEN 3 THEN 'does not fit its type' END AS reason,
       CASE WHEN event_id % 50 <= 3 THEN event_id END AS broken
FROM events
""")
def _(t):
    """Lines in files, some of them broken: cut off, of unknown type, without a type, of wrong content."""
    case, kind = F.col("event_id") % 50, F.col("event_type")
    good = F.to_json(F.struct(kind.alias("Event"), "event_id", "user_id", "value"))
    line = (F.when(case == 0, F.concat(F.lit('{"id": '), F.col("event_id"), F.lit(', "Event": "vie')))
            .when(case == 1, F.to_json(F.struct(F.lit("mystery").alias("Event"), F.col("event_id").alias("id"))))
            .when(case == 2, F.to_json(F.struct(F.col("event_id").alias("id"), "value")))
            .when(case == 3, F.to_json(F.struct(kind.alias("Event"), F.lit("many").alias("user_id"),
                                                F.col("event_id").alias("id")))).otherwise(good))
    path = _scratch(t, "log")
    t.read("events").select(line.alias("value")).write.text(path)
    parsed = event_log.read_parsed_events(t.spark, path, EVENT_SCHEMAS)
    body = F.coalesce(*EVENT_SCHEMAS)
    return parsed.select("event", body["event_id"].alias("event_id"), body["value"].alias("value"), "reason",
                         F.regexp_extract("line", '"id": ?([0-9]+)', 1).try_cast("bigint").alias("broken"))


@query("event_route", """
SELECT CASE WHEN event_type IN ('purchase', 'signup', 'error') THEN event_type
            ELSE 'other' END AS route, event_id,
       CASE event_type WHEN 'purchase' THEN value WHEN 'error' THEN -value END AS amount
FROM events
""")
def _(t):
    return event_log.route_columns(t.read("events"), "event_type", {
        "purchase": {"amount": F.col("value")}, "signup": {}, "error": {"amount": -F.col("value")}},
        keep=["event_id"])


@query("json_gzip_roundtrip", """
SELECT event_id, ts, user_id, event_type, value, props FROM events
""")
def _(t):
    events = t.read("events")
    path = _scratch(t, "entities")
    files.write_entities(events, path)
    return files.read_entities(t.spark, path, events.schema)


@query("read_whole_files", """
SELECT role, count(*) AS turns, CAST(sum(length(text)) AS BIGINT) AS characters,
       CAST(sum(conv_id * 31 + turn) AS BIGINT) AS checksum
FROM conversations GROUP BY role
""")
def _(t):
    path = _scratch(t, "turns")
    t.read("conversations").write.partitionBy("role").option("maxRecordsPerFile", 1000).json(path)
    lines = (files.read_whole_files(t.spark, path, recursiveFileLookup="true")
             .select(F.regexp_extract("path", "role=([^/]+)", 1).alias("role"),
                     F.explode(F.split("content", "\n")).alias("line"))
             .filter(F.col("line") != "")
             .withColumn("turn", F.from_json("line", "conv_id bigint, turn bigint, text string")))
    return lines.groupBy("role").agg(
        F.count(F.lit(1)).alias("turns"),
        F.sum(F.length("turn.text")).cast("bigint").alias("characters"),
        F.sum(F.col("turn.conv_id") * 31 + F.col("turn.turn")).alias("checksum"))


@query("properties_ingest", """
SELECT event_id, key, value FROM v_settings
""", "v_settings")
def _(t):
    """Keys with an escaped separator, values over two physical lines, comments, escapes."""
    path = _scratch(t, "properties")
    value = F.col("value")
    (t.settings.select(F.concat(
        F.lit("# note \\\n  event\\:"), F.col("event_id").cast("string"), F.lit("."), F.col("key"),
        F.lit(" \\\n\t = \t "), F.substring(value, 1, 1), F.lit("\\\n   "),
        F.substring(value, 2, F.length(value)), F.lit(" \\t\\u0020 \n!")).alias("value"))
     .write.text(path))
    parsed = files.read_properties(t.spark, path)
    return parsed.select(
        F.regexp_extract("key", r"^event:(\d+)\.", 1).cast("bigint").alias("event_id"),
        F.regexp_replace("key", r"^event:\d+\.", "").alias("key"), "value")


@query("kv_upsert_latest", """
SELECT member_id, kind, event_id, ts, k FROM (
  SELECT *, row_number() OVER (PARTITION BY member_id, kind ORDER BY ts DESC, event_id DESC) AS rn
  FROM v_beats) x WHERE rn = 1
""", "v_beats")
def _(t):
    return (keyed.latest_by_key(t.beats, ["member_id", "kind"], ["ts", "event_id"])
            .select("member_id", "kind", "event_id", "ts", "k"))


@query("kv_delete_tombstone", """
SELECT scope, key, event_id, value FROM (
  SELECT s.*, b.kind, row_number() OVER (PARTITION BY scope, key ORDER BY s.event_id DESC) AS rn
  FROM v_settings s JOIN v_beats b ON s.event_id = b.event_id) x
WHERE rn = 1 AND kind <> 'failure'
""", "v_settings v_beats")
def _(t):
    k = F.col("k")
    changes = (t.beats.select(
        F.col("member_id").alias("scope"),
        F.concat(F.lit("spark."), k.cast("string"), F.lit(".port")).alias("key"), "event_id",
        F.when(k % 3 == 0, F.concat(F.lit("${spark."), (k + 1).cast("string"), F.lit(".port}")))
        .otherwise(F.concat(k.cast("string"), F.when(k % 2 == 0, "s").otherwise("ms")))
        .alias("value"), F.when(F.col("kind") == "failure", "delete").otherwise("put").alias("op")))
    return keyed.apply_changes(changes, ["scope", "key"], "event_id")


@query("kv_read_by_key", """
SELECT w.l_partkey AS id, w.n AS uses, s.s_name AS name, s.s_suppkey IS NOT NULL AS found,
       CASE WHEN s.s_suppkey IS NULL THEN concat('no such key: ', CAST(w.l_partkey AS VARCHAR))
       END AS error
FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey) w
LEFT JOIN supplier s ON s.s_suppkey = w.l_partkey
""")
def _(t):
    wanted = (t.read("lineitem").groupBy(F.col("l_partkey").alias("id"))
              .agg(F.count(F.lit(1)).alias("uses")))
    suppliers = t.read("supplier").select(F.col("s_suppkey").alias("id"),
                                          F.col("s_name").alias("name"))
    return keyed.lookup(suppliers, wanted, ["id"])


@query("quote_subscribe", """
SELECT e.event_id, e.event_type AS security, e.ts, e.value AS price, e.user_id AS client
FROM events e
JOIN (SELECT client, security FROM (
        SELECT member_id AS client, k, row_number() OVER (
          PARTITION BY member_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM v_beats WHERE kind = 'register') l
      JOIN (VALUES ('purchase', 0), ('signup', 1), ('error', 2), ('view', 0), ('click', 1))
          AS names(security, slot) ON names.slot = l.k % 3
      WHERE rn = 1) s
  ON s.security = e.event_type AND s.client = e.user_id
""", "v_beats")
def _(t):
    slot = F.col("k") % 3
    lists = (F.when(slot == 0, F.array(F.lit("purchase"), F.lit("view")))
             .when(slot == 1, F.array(F.lit("signup"), F.lit("click")))
             .otherwise(F.array(F.lit("error"))))
    subscriptions = t.beats.filter(F.col("kind") == "register").select(
        F.col("member_id").alias("client"), "ts", "event_id", lists.alias("securities"))
    quotes = t.read("events").select(
        "event_id", F.col("event_type").alias("security"), "ts",
        F.col("value").alias("price"), F.col("user_id").alias("client"))
    return (keyed.subscribed(quotes, subscriptions, seq=["ts", "event_id"],
                             on=["client", "security"])
            .select("event_id", "security", "ts", "price", "client"))


@query("fanout_queues", """
SELECT q.queue, e.event_id, e.event_type FROM events e
CROSS JOIN (VALUES ('shared'), ('appStatus'), ('executorManagement'), ('eventLog')) q(queue)
""")
def _(t):
    return (event_log.fan_out(t.read("events"), list(QUEUES))
            .select("queue", "event_id", "event_type"))


@query("replay_then_tail", """
SELECT event_id, ts, CASE WHEN ts < TIMESTAMP '2024-01-15 00:00:00' THEN 0 ELSE 1 END AS phase
FROM events
""")
def _(t):
    events = t.read("events").select("event_id", "ts")
    start = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return event_log.replay_then_tail(events.filter(F.col("ts") < start),
                                      events.filter(F.col("ts") >= start), ["ts", "event_id"])


@query("count_type", """
SELECT event_type, count(*) AS n FROM events GROUP BY event_type
""")
def _(t):
    return keyed.count_type(t.read("events"), "event_type")


@query("count_index_value", """
SELECT p.p_partkey AS stage_id, count(l.l_suppkey) AS n
FROM part p LEFT JOIN lineitem l ON l.l_suppkey = p.p_partkey GROUP BY p.p_partkey
""")
def _(t):
    wanted = t.read("part").select(F.col("p_partkey").alias("stage_id"))
    return keyed.count_index_value(t.tasks, "stage_id", wanted)


@query("threshold_trigger", """
SELECT stage_id, count(*) AS n FROM v_tasks GROUP BY stage_id HAVING count(*) > 600
""", "v_tasks")
def _(t):
    return keyed.over_threshold(t.tasks, "stage_id", 600)
