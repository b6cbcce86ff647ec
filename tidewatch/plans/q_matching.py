"""Queries: lookups, matching, as-of, path and graph relations, capacity and placement."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import matching, placement
from .registry import query

US_PER_HOUR = 3_600_000_000


def ntz(name):
    return F.col(name).cast("timestamp_ntz")


@query("alive_filter", """
SELECT id, host_id FROM v_executors WHERE id NOT IN (
  SELECT member_id * 2 FROM v_beats WHERE kind = 'remove'
  UNION SELECT member_id * 3 FROM v_beats WHERE kind = 'failure')
""", "v_executors v_beats")
def _(t):
    kind = F.col("kind")
    removing = t.beats.filter(kind == "remove").select((F.col("member_id") * 2).alias("id"))
    lost = t.beats.filter(kind == "failure").select((F.col("member_id") * 3).alias("id"))
    return matching.alive_filter(t.executors.select("id", "host_id"), removing, lost, ["id"])


@query("enrich_lookup", """
SELECT b.event_id, b.member_id AS id, x.host_id, x.total_cores FROM v_beats b
JOIN v_executors x ON x.id = b.member_id
""", "v_beats v_executors")
def _(t):
    events = t.beats.select("event_id", F.col("member_id").alias("id"))
    return matching.enrich_lookup(events, t.executors.select("id", "host_id", "total_cores"),
                                  ["id"])


@query("unknown_heartbeats", """
SELECT event_id, member_id FROM v_beats WHERE kind = 'heartbeat' AND member_id NOT IN (
  SELECT member_id * 2 FROM v_beats WHERE kind = 'register')
""", "v_beats")
def _(t):
    beats = t.beats.filter(F.col("kind") == "heartbeat").select("event_id", "member_id")
    registered = t.beats.filter(F.col("kind") == "register").withColumn(
        "member_id", F.col("member_id") * 2)
    return matching.unknown_heartbeats(beats, registered, ["member_id"])


@query("known_unknown_split", """
SELECT c_custkey AS id, c_custkey IN (SELECT s_suppkey FROM supplier) AS known FROM customer
""")
def _(t):
    wanted = t.read("customer").select(F.col("c_custkey").alias("id"))
    return matching.marked_known(
        wanted, t.read("supplier").select(F.col("s_suppkey").alias("id")), ["id"])


TIERED_SQL = """
WITH grants AS (SELECT c_custkey AS grant_id, c_nationkey AS host_id, n_regionkey AS rack_id
                FROM customer JOIN nation ON n_nationkey = c_nationkey),
requests AS (SELECT s_suppkey AS request_id,
                    CASE WHEN s_suppkey % 5 <> 0 THEN s_nationkey + 25 * (s_suppkey % 2) END AS host_id,
                    CASE WHEN s_suppkey % 5 <> 0 THEN n_regionkey END AS rack_id
             FROM supplier JOIN nation ON n_nationkey = s_nationkey),
h AS (SELECT grant_id, request_id FROM
  (SELECT *, row_number() OVER (PARTITION BY host_id ORDER BY grant_id) AS rn FROM grants) g
  JOIN (SELECT *, row_number() OVER (PARTITION BY host_id ORDER BY request_id) AS rn
        FROM requests) r ON r.host_id = g.host_id AND r.rn = g.rn),
k AS (SELECT grant_id, request_id FROM
  (SELECT *, row_number() OVER (PARTITION BY rack_id ORDER BY grant_id) AS rn FROM grants
   WHERE grant_id NOT IN (SELECT grant_id FROM h)) g
  JOIN (SELECT *, row_number() OVER (PARTITION BY rack_id ORDER BY request_id) AS rn
        FROM requests WHERE request_id NOT IN (SELECT request_id FROM h)) r
  ON r.rack_id = g.rack_id AND r.rn = g.rn),
a AS (SELECT grant_id, request_id FROM
  (SELECT *, row_number() OVER (ORDER BY grant_id) AS rn FROM grants
   WHERE grant_id NOT IN (SELECT grant_id FROM h UNION SELECT grant_id FROM k)) g
  JOIN (SELECT *, row_number() OVER (ORDER BY request_id) AS rn FROM requests
        WHERE request_id NOT IN (SELECT request_id FROM h UNION SELECT request_id FROM k)) r
  ON r.rn = g.rn)
SELECT grant_id, request_id, 'host' AS tier FROM h
UNION ALL SELECT grant_id, request_id, 'rack' FROM k
UNION ALL SELECT grant_id, request_id, 'any' FROM a
UNION ALL SELECT grant_id, NULL, 'released' FROM grants WHERE grant_id NOT IN (
  SELECT grant_id FROM h UNION SELECT grant_id FROM k UNION SELECT grant_id FROM a)
"""


def _serial(tier: str, grants: str, wanted: str) -> str:
    """Each grant in order takes the first request on its key's list that is not taken yet."""
    return f"""
{tier}_grants AS (SELECT *, row_number() OVER (ORDER BY grant_id) AS n FROM {grants}),
{tier}_lists AS (SELECT {tier}_id, list(request_id ORDER BY request_id) AS l
  FROM (SELECT DISTINCT {tier}_id, request_id FROM {wanted} WHERE {tier}_id IS NOT NULL) d GROUP BY {tier}_id),
{tier}_walk AS (
  SELECT 0::BIGINT AS n, NULL::BIGINT AS grant_id, NULL::BIGINT AS request_id, []::BIGINT[] AS taken
  UNION ALL
  SELECT n, grant_id, pick, CASE WHEN pick IS NULL THEN taken ELSE list_append(taken, pick) END
  FROM (SELECT g.n, g.grant_id, w.taken,
               list_filter(l, lambda x: NOT list_contains(w.taken, x))[1] AS pick
        FROM {tier}_walk w JOIN {tier}_grants g ON g.n = w.n + 1
        LEFT JOIN {tier}_lists t ON t.{tier}_id = g.{tier}_id) x),
{tier}_pairs AS (SELECT grant_id, request_id FROM {tier}_walk WHERE request_id IS NOT NULL)"""


SEVERAL_HOSTS_SQL = f"""
WITH RECURSIVE grants AS (
  SELECT c_custkey AS grant_id, c_nationkey AS host_id, n_regionkey AS rack_id
  FROM customer JOIN nation ON n_nationkey = c_nationkey),
wanted AS (
  SELECT s_suppkey AS request_id, n_nationkey AS host_id, n_regionkey AS rack_id
  FROM supplier LEFT JOIN nation ON s_suppkey % 4 <> 0 AND n_nationkey IN (
    s_nationkey, (s_nationkey + s_suppkey) % 25, (s_nationkey * 7 + s_suppkey % 3) % 25)),
{_serial("host", "grants", "wanted")},
rack_open AS (SELECT * FROM grants WHERE grant_id NOT IN (SELECT grant_id FROM host_pairs)),
rack_wanted AS (SELECT * FROM wanted WHERE request_id NOT IN (SELECT request_id FROM host_pairs)),
{_serial("rack", "rack_open", "rack_wanted")},
a AS (SELECT grant_id, request_id FROM
  (SELECT *, row_number() OVER (ORDER BY grant_id) AS rn FROM rack_open
   WHERE grant_id NOT IN (SELECT grant_id FROM rack_pairs)) g
  JOIN (SELECT *, row_number() OVER (ORDER BY request_id) AS rn
        FROM (SELECT DISTINCT request_id FROM rack_wanted) d
        WHERE request_id NOT IN (SELECT request_id FROM rack_pairs)) r ON r.rn = g.rn)
SELECT grant_id, request_id, 'host' AS tier FROM host_pairs
UNION ALL SELECT grant_id, request_id, 'rack' FROM rack_pairs
UNION ALL SELECT grant_id, request_id, 'any' FROM a
UNION ALL SELECT grant_id, NULL, 'released' FROM rack_open WHERE grant_id NOT IN (
  SELECT grant_id FROM rack_pairs UNION SELECT grant_id FROM a)
"""


@query("tiered_match_hosts", SEVERAL_HOSTS_SQL)
def _(t):
    nation = t.read("nation").select(F.col("n_nationkey").alias("host_id"), F.col("n_regionkey").alias("rack_id"))
    grants = (t.read("customer").select(F.col("c_custkey").alias("grant_id"), F.col("c_nationkey").alias("host_id"))
              .join(nation, "host_id"))
    # Up to three hosts, over one or more racks; every fourth request takes anything.
    home, number = F.col("s_nationkey"), F.col("s_suppkey")
    hosts = F.when(number % 4 != 0, F.array_distinct(F.array(
        home, (home + number) % 25, (home * 7 + number % 3) % 25)))
    wanted = t.read("supplier").select(number.alias("request_id"), F.explode_outer(hosts).alias("host_id"))
    return matching.tiered_match(
        grants, wanted.join(nation, "host_id", "left"), [("host", ["host_id"]), ("rack", ["rack_id"]), ("any", [])],
        "grant_id", "request_id", ["grant_id"], ["request_id"])


@query("tiered_match", TIERED_SQL)
def _(t):
    nation = t.read("nation")
    grants = (t.read("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
              .select(F.col("c_custkey").alias("grant_id"), F.col("c_nationkey").alias("host_id"),
                      F.col("n_regionkey").alias("rack_id")))
    # Every fifth request takes anything; odd ones want a host that has no grants.
    number = F.col("s_suppkey")
    requests = (t.read("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
                .select(number.alias("request_id"),
                        F.when(number % 5 != 0, F.col("s_nationkey") + 25 * (number % 2)).alias("host_id"),
                        F.when(number % 5 != 0, F.col("n_regionkey")).alias("rack_id")))
    return matching.tiered_match(
        grants, requests, [("host", ["host_id"]), ("rack", ["rack_id"]), ("any", [])],
        "grant_id", "request_id", ["grant_id"], ["request_id"])


@query("last_seen_asof", """
SELECT m.member_id, m.tick, (SELECT max(b.ts) FROM v_beats b
    WHERE b.member_id = m.member_id AND b.ts <= m.tick) AS last_seen
FROM (SELECT member_id, unnest(generate_series(
        CAST(ceil(epoch_us(min(ts)) / 21600000000.0) AS BIGINT),
        CAST(floor(epoch_us(max(ts)) / 21600000000.0) AS BIGINT))) AS n,
        make_timestamp(n * 21600000000) AS tick
      FROM v_beats GROUP BY member_id) m
""", "v_beats")
def _(t):
    beats = t.beats.select("member_id", F.col("ts").cast("timestamp").alias("ts"))
    ticks = matching.check_ticks(beats, "member_id", "ts", 6 * US_PER_HOUR)
    return (matching.last_seen_asof(ticks, beats, "member_id", "tick", "ts")
            .select("member_id", ntz("tick").alias("tick"), ntz("last_seen").alias("last_seen")))


@query("zip_parallel_arrays", """
SELECT vec_id, i - 1 AS position, CAST(embedding[i] AS DOUBLE) AS x,
       CAST(embedding[len(embedding) + 1 - i] AS DOUBLE) AS y
FROM (SELECT vec_id, embedding, CAST(unnest(generate_series(1, len(embedding))) AS INT) AS i
      FROM embeddings) e
""")
def _(t):
    arrays = t.read("embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("x"),
        F.reverse("embedding").cast("array<double>").alias("y"))
    return matching.zip_parallel_arrays(arrays, ["x", "y"])


@query("parallel_arrays_roundtrip", """
SELECT vec_id, CAST(b AS BIGINT) AS block, len(part) AS n, CAST(part[1] AS DOUBLE) AS first_x,
       CAST(part[len(part)] AS DOUBLE) AS last_x
FROM (SELECT vec_id, b, embedding[b * 20 + 1 : b * 20 + 20] AS part
      FROM (SELECT *, unnest(generate_series(0, (len(embedding) - 1) // 20)) AS b
            FROM embeddings) e) p
""")
def _(t):
    arrays = t.read("embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("x"))
    rows = matching.zip_parallel_arrays(arrays, ["x"])
    back = matching.to_parallel_arrays(rows, ["vec_id"], ["x"], block_size=20)
    return back.select("vec_id", "block", F.size("x").cast("bigint").alias("n"),
                       F.element_at("x", 1).alias("first_x"),
                       F.element_at("x", -1).alias("last_x"))


@query("path_visibility", """
WITH files AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1) AS path
               FROM pages),
named AS (SELECT page_id, rtrim(path, '/') AS path FROM files WHERE rtrim(path, '/') <> ''),
pieces AS (SELECT page_id, path, list_filter(string_split(path, '/'), lambda p: p <> '') AS parts
           FROM named),
above AS (SELECT page_id, path, unnest(list_concat(['/'], list_transform(
            generate_series(1, len(parts) - 1),
            lambda i: concat('/', array_to_string(parts[1:i], '/'))))) AS folder FROM pieces)
SELECT n.page_id, n.path, CASE WHEN (length(n.path) * 5 % 8) & 4 = 4 AND a.open
                               THEN 'PUBLIC' ELSE 'PRIVATE' END AS visibility
FROM named n JOIN (SELECT page_id, bool_and((length(folder) * 7 % 8) & 1 = 1) AS open
                   FROM above GROUP BY page_id) a ON a.page_id = n.page_id
""")
def _(t):
    path = F.rtrim(F.regexp_extract("url", r"^[a-z]+://[^/]+(/[^?#]*)", 1), F.lit("/"))
    files = t.read("pages").select("page_id", path.alias("path")).filter(F.col("path") != "")
    parts = F.filter(F.split("path", "/"), lambda p: p != "")
    folders = files.select(F.explode(F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.concat(
            F.lit("/"), F.array_join(F.slice(parts, F.lit(1), n), "/")))).alias("path")).distinct()
    # A path may be both a file and a folder: then both digits apply.
    size = F.length("path")
    digits = (files.select("path", F.lit(4).alias("right"))
              .unionByName(folders.select("path", F.lit(1).alias("right"))).distinct()
              .groupBy("path").agg(F.sum(F.when(
                  F.col("right") == 4, (size * 5 % 8).bitwiseAND(4)).otherwise(
                  (size * 7 % 8).bitwiseAND(1))).alias("others")))
    return matching.path_visibility(files, digits)


@query("cross_stage_edges", """
SELECT DISTINCT e.src, e.dst, a.stage_id AS src_stage, b.stage_id AS dst_stage
FROM v_edges e JOIN v_nodes a ON a.node = e.src JOIN v_nodes b ON b.node = e.dst
WHERE a.stage_id <> b.stage_id
""", "v_edges v_nodes")
def _(t):
    return matching.cross_stage_edges(t.edges, t.nodes)


@query("mark_skipped", """
SELECT stage_id, CASE WHEN skipped AND name NOT LIKE '% (skipped)%' THEN concat(name, ' (skipped)')
                      ELSE name END AS name
FROM (SELECT s_suppkey AS stage_id, s_acctbal < 2000 AS skipped,
             CASE WHEN s_suppkey % 2 = 0 THEN concat(s_name, ' (skipped)') ELSE s_name END AS name
      FROM supplier) x
""")
def _(t):
    name = F.col("s_name")
    stages = t.read("supplier").select(
        F.col("s_suppkey").alias("stage_id"), (F.col("s_acctbal") < 2000).alias("skipped"),
        F.when(F.col("s_suppkey") % 2 == 0, F.concat(name, F.lit(" (skipped)"))).otherwise(name)
        .alias("name"))
    return matching.mark_skipped(stages).select("stage_id", "name")


@query("mark_nodes", """
SELECT n.node, n.stage_id, coalesce(s.s_acctbal < 2000, FALSE) AS skipped,
       n.node IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49) AS cached
FROM v_nodes n LEFT JOIN supplier s ON s.s_suppkey = n.stage_id
""", "v_nodes")
def _(t):
    stages = t.read("supplier").select(F.col("s_suppkey").alias("stage_id"),
                                       (F.col("s_acctbal") < 2000).alias("skipped"))
    cached = (t.read("lineitem").filter(F.col("l_quantity") > 49)
              .select(F.col("l_partkey").alias("node")))
    return matching.mark_nodes(t.nodes, stages, cached)


@query("cascade_delete", """
WITH attempts AS (SELECT DISTINCT part_id AS stage_id, task_index AS attempt_id FROM v_tasks),
removed AS (SELECT * FROM attempts WHERE attempt_id <= 5),
kept AS (SELECT * FROM attempts WHERE attempt_id > 5)
SELECT 'stages' AS what, stage_id, attempt_id, NULL AS executor_id FROM kept
UNION ALL SELECT DISTINCT 'executors', part_id, task_index, executor_id FROM v_tasks
WHERE task_index > 5
UNION ALL SELECT 'graphs', stage_id, NULL, NULL FROM (
  SELECT DISTINCT stage_id FROM kept) g
""", "v_tasks")
def _(t):
    stage = F.col("part_id").alias("stage_id")
    attempt = F.col("task_index").alias("attempt_id")
    attempts = t.tasks.select(stage, attempt).distinct()
    executors = t.tasks.select(stage, attempt, "executor_id").distinct()
    graphs = attempts.select("stage_id").distinct()
    left = matching.cascade_delete(attempts, attempts.filter(F.col("attempt_id") <= 5),
                                   {"executors": executors}, graphs)
    nothing = F.lit(None).cast("bigint").alias("executor_id")
    return (left["stages"].select(F.lit("stages").alias("what"), "stage_id", "attempt_id", nothing)
            .unionByName(left["executors"].select(F.lit("executors").alias("what"), "stage_id",
                                                  "attempt_id", "executor_id"))
            .unionByName(left["graphs"].select(
                F.lit("graphs").alias("what"), "stage_id",
                F.lit(None).cast("int").alias("attempt_id"), nothing)))


# ---------------------------------------------------------------- capacity and placement

@query("allocation_gap", """
SELECT app, target, pending, running, target - pending - running AS missing,
       CASE WHEN target - pending - running > 0 THEN 'request'
            WHEN target - pending - running < 0 THEN 'cancel' ELSE 'none' END AS action,
       CASE WHEN target - pending - running > 0 THEN target - pending - running
            WHEN target - pending - running < 0
              THEN least(pending, -(target - pending - running)) ELSE 0 END AS containers
FROM (SELECT o_custkey AS app, count(*) AS target,
             count(CASE WHEN o_orderstatus = 'P' THEN 1 END) * 2 AS pending,
             count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS running
      FROM orders GROUP BY o_custkey) a
""")
def _(t):
    status = F.col("o_orderstatus")
    apps = t.read("orders").groupBy(F.col("o_custkey").alias("app")).agg(
        F.count(F.lit(1)).alias("target"), (F.count_if(status == "P") * 2).alias("pending"),
        F.count_if(status == "F").alias("running"))
    return placement.allocation_gap(apps)


@query("running_after_completion", """
SELECT r.app, r.running - coalesce(c.n, 0) AS running
FROM (SELECT o_custkey AS app, count(*) AS running FROM orders GROUP BY o_custkey) r
LEFT JOIN (SELECT o_custkey AS app, count(*) AS n FROM orders
           WHERE o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT' GROUP BY o_custkey) c
  ON c.app = r.app
""")
def _(t):
    orders = t.read("orders").select(F.col("o_custkey").alias("app"),
                                     F.col("o_orderkey").alias("container"), "o_orderstatus",
                                     "o_orderpriority")
    running = orders.groupBy("app").agg(F.count(F.lit(1)).alias("running"))
    return placement.running_after_completion(
        running, orders.filter(F.col("o_orderstatus") == "F"),
        orders.filter(F.col("o_orderpriority") == "1-URGENT"), "app", "container")


SHARE_SQL = """
shares AS (SELECT p.app, p.host_id, p.mentions,
                  p.mentions * CAST(t.requests AS DOUBLE) / t.total AS expected
  FROM (SELECT app, host_id, count(*) AS mentions FROM (
          SELECT c_mktsegment AS app, c_nationkey AS host_id FROM customer
          UNION ALL SELECT c_mktsegment, (c_nationkey + 1) % 25 FROM customer
          UNION ALL SELECT c_mktsegment, (c_nationkey + 2) % 25 FROM customer
                    WHERE c_custkey % 2 = 0) m GROUP BY app, host_id) p
  JOIN (SELECT c_mktsegment AS app, count(*) AS requests,
               sum(CASE WHEN c_custkey % 2 = 0 THEN 3 ELSE 2 END) AS total
        FROM customer GROUP BY c_mktsegment) t ON t.app = p.app)
"""


def pending_share(t):
    n = F.col("c_nationkey")
    hosts = F.when(F.col("c_custkey") % 2 == 0, F.array(n, (n + 1) % 25, (n + 2) % 25)).otherwise(
        F.array(n, (n + 1) % 25))
    requests = t.read("customer").select(F.col("c_mktsegment").alias("app"), hosts.alias("hosts"))
    return placement.pending_by_host_share(requests, "app", "hosts")


@query("pending_by_host_share", f"""
WITH {SHARE_SQL} SELECT app, host_id, mentions, round(expected, 6) AS expected FROM shares
""")
def _(t):
    return pending_share(t).withColumn("expected", F.round("expected", 6))


NEEDED_SQL = SHARE_SQL + """,
jobs AS (SELECT c_mktsegment AS app, c_nationkey AS host_id, o_orderkey, o_orderstatus
         FROM orders JOIN customer ON c_custkey = o_custkey),
local AS (SELECT app, host_id, count(*) AS tasks FROM jobs GROUP BY app, host_id),
apps AS (SELECT app, count(*) AS aware_tasks, (count(*) * 2 + 3) // 4 AS execs FROM jobs
         GROUP BY app),
allocated AS (SELECT app, host_id, count(*) AS have FROM jobs
              WHERE o_orderstatus = 'F' AND o_orderkey % 3 = 0 GROUP BY app, host_id),
needed AS (SELECT l.app, l.host_id, greatest(CAST(ceil(CAST(l.tasks AS DOUBLE) * a.execs / s.total
                  - (coalesce(x.have, 0) + coalesce(p.expected, 0.0))) AS BIGINT), 0) AS needed
  FROM local l JOIN apps a ON a.app = l.app
  JOIN (SELECT app, CAST(sum(tasks) AS BIGINT) AS total FROM local GROUP BY app) s
    ON s.app = l.app
  LEFT JOIN allocated x ON x.app = l.app AND x.host_id = l.host_id
  LEFT JOIN shares p ON p.app = l.app AND p.host_id = l.host_id)
"""


def needed_per_host(t):
    jobs = (t.read("orders").join(t.read("customer"), F.col("c_custkey") == F.col("o_custkey"))
            .select(F.col("c_mktsegment").alias("app"), F.col("c_nationkey").alias("host_id"),
                    "o_orderkey", "o_orderstatus"))
    local = jobs.groupBy("app", "host_id").agg(F.count(F.lit(1)).alias("tasks"))
    apps = jobs.groupBy("app").agg(F.count(F.lit(1)).alias("aware_tasks"))
    allocated = jobs.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 3 == 0))
    return apps, placement.expected_per_host(local, apps, allocated, pending_share(t), "app",
                                             cpus_per_task=2, cores=4)


@query("expected_per_host", f"WITH {NEEDED_SQL} SELECT app, host_id, needed FROM needed")
def _(t):
    return needed_per_host(t)[1]


@query("placement_rounds", f"""
WITH {NEEDED_SQL},
plan AS (SELECT app, n, greatest(n - total, 0) AS free, n - greatest(n - total, 0) AS aware, most
  FROM (SELECT a.app, a.aware_tasks // 3 AS n, CAST(sum(needed) AS BIGINT) AS total,
               max(needed) AS most
        FROM apps a JOIN needed d ON d.app = a.app GROUP BY a.app, a.aware_tasks) x)
SELECT app, unnest(generate_series(1, free)) AS request, NULL AS host_id, NULL AS rack_id FROM plan
UNION ALL
SELECT r.app, r.free + r.i, r.host_id, n.n_regionkey FROM (
  SELECT p.app, p.free, d.host_id, unnest(generate_series(1, CAST(ceil(
      CAST(d.needed AS DOUBLE) * p.aware / p.most) AS BIGINT))) AS i
  FROM plan p JOIN needed d ON d.app = p.app WHERE p.aware > 0) r
JOIN nation n ON n.n_nationkey = r.host_id
""")
def _(t):
    apps, needed = needed_per_host(t)
    requests = apps.select("app", F.floor(F.col("aware_tasks") / 3).cast("bigint")
                           .alias("requests"))
    racks = t.read("nation").select(F.col("n_nationkey").alias("host_id"),
                                    F.col("n_regionkey").alias("rack_id"))
    return placement.placement_rounds(needed, requests, "app", racks).select(
        "app", "request", "host_id", "rack_id")


DRAIN_SQL = """
chosen AS (SELECT DISTINCT c_custkey AS id, c_nationkey AS app FROM customer
  WHERE c_custkey IN (SELECT s_suppkey FROM supplier)
    AND c_custkey NOT IN (SELECT member_id * 2 FROM v_beats WHERE kind = 'remove')
    AND c_custkey NOT IN (SELECT member_id * 3 FROM v_beats WHERE kind = 'failure'))
"""


def drained(t):
    kind = F.col("kind")
    wanted = t.read("customer").select(F.col("c_custkey").alias("id"),
                                       F.col("c_nationkey").alias("app"))
    return placement.drain_selection(
        wanted, t.read("supplier").select(F.col("s_suppkey").alias("id")),
        t.beats.filter(kind == "remove").select((F.col("member_id") * 2).alias("id")),
        t.beats.filter(kind == "failure").select((F.col("member_id") * 3).alias("id")), "id")


@query("drain_selection", f"WITH {DRAIN_SQL} SELECT id, app FROM chosen", "v_beats")
def _(t):
    return drained(t)


@query("target_after_drain", f"""
WITH {DRAIN_SQL}
SELECT n.n_nationkey AS app, greatest(2 - coalesce(c.taken, 0), 0) AS target FROM nation n
LEFT JOIN (SELECT app, count(*) AS taken FROM chosen GROUP BY app) c ON c.app = n.n_nationkey
""", "v_beats")
def _(t):
    targets = t.read("nation").select(F.col("n_nationkey").alias("app"),
                                      F.lit(2).cast("bigint").alias("target"))
    return placement.target_after_drain(targets, drained(t), "app")


@query("pending_members", """
SELECT app, requested, existing, removing, known_pending,
       CASE WHEN requested >= 0 THEN greatest(requested - existing + removing, 0) END AS pending,
       CASE WHEN requested < 0 THEN concat('negative number of members requested: ',
            CAST(requested AS VARCHAR)) END AS error,
       requested <> existing + known_pending - removing AS mismatch
FROM (SELECT o_custkey AS app, count(*) - 5 AS requested,
             count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS existing,
             count(CASE WHEN o_orderpriority = '5-LOW' THEN 1 END) AS removing,
             count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS known_pending
      FROM orders GROUP BY o_custkey) a
""")
def _(t):
    status = F.col("o_orderstatus")
    apps = t.read("orders").groupBy(F.col("o_custkey").alias("app")).agg(
        (F.count(F.lit(1)) - 5).alias("requested"),
        F.count_if(status == "F").alias("existing"),
        F.count_if(F.col("o_orderpriority") == "5-LOW").alias("removing"),
        F.count_if(status == "P").alias("known_pending"))
    return placement.pending_members(apps, known_pending="known_pending")


@query("free_slots", """
SELECT x.id, x.cores, x.cores - coalesce(u.running, 0) * 2 AS free_cores
FROM (SELECT s_suppkey AS id, 3000 + s_suppkey % 8 AS cores FROM supplier) x
LEFT JOIN (SELECT l_suppkey AS id, count(*) - count(CASE WHEN l_linestatus = 'F' THEN 1 END)
             AS running FROM lineitem GROUP BY l_suppkey) u ON u.id = x.id
""")
def _(t):
    key = F.col("s_suppkey")
    members = t.read("supplier").filter(key.isNotNull()).select(
        key.alias("id"), (key % 8 + 3000).alias("cores"))
    done = F.col("l_linestatus") == "F"
    updates = t.read("lineitem").select(
        F.col("l_suppkey").alias("id"), F.explode(
            F.when(done, F.array(F.lit("start"), F.lit("finish")))
            .otherwise(F.array(F.lit("start")))).alias("kind"))
    return placement.free_slots(members, updates, "id", cpus_per_task=2)


@query("ready_gate", """
WITH r AS (SELECT host_id AS app, ts, event_id, k % 8 + 1 AS cores FROM v_beats
           WHERE kind = 'register'),
a AS (SELECT app, min(ts) AS start_time, CAST(sum(cores) AS BIGINT) // 4 AS expected FROM r
      GROUP BY app),
s AS (SELECT r.app, r.ts, sum(cores) OVER (PARTITION BY r.app ORDER BY ts, event_id) AS total FROM r),
f AS (SELECT s.app, min(CASE WHEN s.total >= a.expected * 0.8::DOUBLE THEN s.ts END) AS enough
      FROM s JOIN a ON a.app = s.app GROUP BY s.app)
SELECT a.app, least(f.enough, a.start_time + INTERVAL 100 HOUR) AS ready_time,
       CASE WHEN f.enough <= a.start_time + INTERVAL 100 HOUR THEN 'resources' ELSE 'waited' END
         AS reason
FROM a JOIN f ON f.app = a.app
""", "v_beats")
def _(t):
    registrations = t.beats.filter(F.col("kind") == "register").select(
        F.col("host_id").alias("app"), F.col("ts").cast("timestamp").alias("ts"), "event_id",
        (F.col("k") % 8 + 1).alias("cores"))
    apps = registrations.groupBy("app").agg(
        F.min("ts").alias("start_time"),
        F.floor(F.sum("cores") / 4).cast("bigint").alias("expected_cores"))
    return placement.ready_gate(registrations, apps, "app", ["ts", "event_id"], ratio=0.8,
                                wait_us=100 * US_PER_HOUR).withColumn(
        "ready_time", ntz("ready_time"))
