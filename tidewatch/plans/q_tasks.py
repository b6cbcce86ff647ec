"""Queries: task, stage, job and executor summaries, quantiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lifecycle, liveness, quantiles, tasks, windows
from ..session import written
from .registry import query

REASON_SQL = """
    CASE WHEN l_linestatus = 'O' AND l_linenumber % 4 = 0 THEN NULL
         WHEN l_returnflag = 'N' THEN 'Success'
         WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'TaskKilled'
         WHEN l_returnflag = 'R' THEN 'TaskCommitDenied'
         WHEN l_linenumber % 2 = 0 THEN 'Resubmitted' ELSE 'ExceptionFailure' END
"""
ENDS_SQL = f"""
ends AS (SELECT l_suppkey AS stage_id, l_orderkey AS job_id, l_linenumber AS task_index,
                l_partkey % 16 AS executor_id,
                CAST(round(l_extendedprice * 100) AS BIGINT) AS run_time,
                CAST(round(l_discount * l_extendedprice) AS BIGINT) AS gc_time,
                CAST(l_quantity AS BIGINT) * 1024 AS input_bytes,
                {REASON_SQL} AS reason,
                concat('killed on ', l_linestatus) AS kill_reason,
                concat('denied line ', CAST(l_linenumber AS VARCHAR)) AS error_text
         FROM lineitem)
"""


def task_ends(t):
    """Tasks with an end reason; a null reason has not ended."""
    status, line, flag = F.col("l_linestatus"), F.col("l_linenumber"), F.col("l_returnflag")
    return t.read("lineitem").select(
        F.col("l_suppkey").alias("stage_id"), F.col("l_orderkey").alias("job_id"),
        line.alias("task_index"), (F.col("l_partkey") % 16).alias("executor_id"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("run_time"),
        F.round(F.col("l_discount") * F.col("l_extendedprice")).cast("bigint").alias("gc_time"),
        (F.col("l_quantity").cast("bigint") * 1024).alias("input_bytes"),
        F.when((status == "O") & (line % 4 == 0), None)
        .when(flag == "N", "Success").when((flag == "R") & (status == "F"), "TaskKilled")
        .when(flag == "R", "TaskCommitDenied").when(line % 2 == 0, "Resubmitted")
        .otherwise("ExceptionFailure").alias("reason"),
        F.concat(F.lit("killed on "), status).alias("kill_reason"),
        F.concat(F.lit("denied line "), line.cast("string")).alias("error_text"))


def stage_infos(t):
    """(job, stage) rows of the jobs' stages."""
    return (t.read("lineitem").groupBy(F.col("l_orderkey").alias("job_id"),
                                       F.col("l_suppkey").alias("stage_id"))
            .agg(F.count(F.lit(1)).alias("num_tasks"),
                 F.when(F.count_if(F.col("l_linestatus") != "F") == 0, F.max("l_shipdate"))
                 .alias("completion_time"),
                 F.when(F.min("l_linenumber") % 4 != 0, F.min("l_shipdate"))
                 .alias("submission_time"),
                 F.when(F.count_if(F.col("l_returnflag") != "A") == 0, "lost").alias("failure_reason"))
            .withColumn("name", F.concat(F.lit("stage "), F.col("stage_id").cast("string"))))


INFOS_SQL = """
infos AS (SELECT *, concat('stage ', CAST(stage_id AS VARCHAR)) AS name,
    CASE WHEN completion_time IS NOT NULL AND failure_reason IS NOT NULL THEN 'FAILED'
         WHEN completion_time IS NOT NULL AND submission_time IS NOT NULL THEN 'COMPLETE'
         WHEN completion_time IS NOT NULL THEN 'SKIPPED'
         WHEN submission_time IS NOT NULL THEN 'ACTIVE' ELSE 'PENDING' END AS status
  FROM (SELECT l_orderkey AS job_id, l_suppkey AS stage_id, count(*) AS num_tasks,
          CASE WHEN max(l_linestatus) = 'F' THEN max(l_shipdate) END AS completion_time,
          CASE WHEN min(l_linenumber) % 4 <> 0 THEN min(l_shipdate) END AS submission_time,
          CASE WHEN max(l_returnflag) = 'A' THEN 'lost' END AS failure_reason
        FROM lineitem GROUP BY l_orderkey, l_suppkey) i)
"""


def with_status(infos):
    return infos.withColumn("status", lifecycle.stage_status(
        F.col("failure_reason"), F.col("submission_time"), F.col("completion_time")))


for _group in ("stage_id", "job_id"):
    def _outcomes(t, group=_group):
        return tasks.task_outcomes(task_ends(t), [group])

    query("task_outcomes" if _group == "stage_id" else "task_outcomes_by_job", f"""
WITH {ENDS_SQL}
SELECT {_group}, count(CASE WHEN reason = 'Success' THEN 1 END) AS completed,
       count(CASE WHEN reason IN ('Resubmitted', 'ExceptionFailure') THEN 1 END) AS failed,
       count(CASE WHEN reason IN ('TaskKilled', 'TaskCommitDenied') THEN 1 END) AS killed,
       count(CASE WHEN reason IS NULL THEN 1 END) AS active
FROM ends GROUP BY {_group}
""")(_outcomes)


@query("distinct_indices", """
SELECT stage_id, count(DISTINCT CASE WHEN outcome = 'completed' THEN task_index END)
  AS distinct_indices FROM v_tasks GROUP BY stage_id
""", "v_tasks")
def _(t):
    return tasks.distinct_indices(t.tasks, ["stage_id"], F.col("outcome") == "completed",
                                  F.col("task_index"))


@query("distinct_indices_by_job", """
SELECT job_id, count(DISTINCT CASE WHEN outcome = 'completed'
    THEN stage_id * 4294967296 + task_index END) AS distinct_indices
FROM v_tasks GROUP BY job_id
""", "v_tasks")
def _(t):
    return tasks.distinct_indices(
        t.tasks, ["job_id"], F.col("outcome") == "completed",
        tasks.packed_index(F.col("stage_id"), F.col("task_index")))


@query("killed_reasons", f"""
WITH {ENDS_SQL}
SELECT stage_id, CASE WHEN reason = 'TaskKilled' THEN kill_reason ELSE error_text END
         AS killed_reason, count(*) AS n
FROM ends WHERE reason IN ('TaskKilled', 'TaskCommitDenied') GROUP BY 1, 2
""")
def _(t):
    return tasks.killed_reasons(task_ends(t), ["stage_id"])


@query("locality_summary", """
SELECT stage_id, locality, count(*) AS n FROM v_tasks GROUP BY stage_id, locality
""", "v_tasks")
def _(t):
    return tasks.count_by(t.tasks, ["stage_id"], "locality")


@query("first_launch", """
SELECT stage_id, min(launch_time) AS first_launch FROM v_tasks GROUP BY stage_id
""", "v_tasks")
def _(t):
    return tasks.first_launch(t.tasks, ["stage_id"])


@query("stage_metrics", """
SELECT stage_id, CAST(sum(run_time) AS BIGINT) AS run_time, CAST(sum(gc_time) AS BIGINT) AS gc_time,
       CAST(sum(input_bytes) AS BIGINT) AS input_bytes FROM v_tasks GROUP BY stage_id
""", "v_tasks")
def _(t):
    return tasks.metric_sums(t.tasks, ["stage_id"], ["run_time", "gc_time", "input_bytes"])


@query("stage_executor_summary", """
SELECT stage_id, executor_id, CAST(sum(gc_time) AS BIGINT) AS gc_time,
       CAST(sum(input_bytes) AS BIGINT) AS input_bytes, CAST(sum(run_time) AS BIGINT) AS task_time,
       count(CASE WHEN outcome = 'completed' THEN 1 END) AS succeeded_tasks,
       count(CASE WHEN outcome = 'failed' THEN 1 END) AS failed_tasks,
       count(CASE WHEN outcome = 'killed' THEN 1 END) AS killed_tasks
FROM v_tasks GROUP BY stage_id, executor_id
""", "v_tasks")
def _(t):
    return tasks.metric_sums(t.tasks, ["stage_id", "executor_id"], ["gc_time", "input_bytes"],
                             outcome="outcome", time="run_time")


@query("executor_totals", f"""
WITH {ENDS_SQL}
SELECT executor_id, count(CASE WHEN reason IS NULL THEN 1 END) AS active_tasks,
       count(CASE WHEN reason = 'Success' THEN 1 END) AS completed_tasks,
       count(CASE WHEN reason IN ('Resubmitted', 'ExceptionFailure') THEN 1 END) AS failed_tasks,
       count(*) AS total_tasks,
       CAST(sum(CASE WHEN reason IS NOT NULL THEN run_time END) AS BIGINT) AS total_duration,
       CAST(sum(CASE WHEN reason <> 'Resubmitted' THEN gc_time END) AS BIGINT) AS total_gc,
       CAST(sum(CASE WHEN reason <> 'Resubmitted' THEN input_bytes END) AS BIGINT) AS total_input
FROM ends GROUP BY executor_id
""")
def _(t):
    return tasks.executor_totals(task_ends(t), "executor_id", "reason", "run_time", {
        "total_gc": F.col("gc_time"), "total_input": F.col("input_bytes")})


@query("job_start_totals", f"""
WITH {INFOS_SQL}
SELECT j.job_id, coalesce(s.open_tasks, 0) AS open_tasks, coalesce(s.num_stages, 0) AS num_stages,
       coalesce(s.job_name, '(Unknown Stage Name)') AS job_name
FROM v_jobs j LEFT JOIN (
  SELECT job_id, CAST(sum(CASE WHEN completion_time IS NULL THEN num_tasks END) AS BIGINT)
           AS open_tasks,
         count(*) AS num_stages, arg_max(name, stage_id) AS job_name
  FROM infos GROUP BY job_id) s ON s.job_id = j.job_id
""", "v_jobs")
def _(t):
    return tasks.job_start_totals(t.jobs.select("job_id"), stage_infos(t))


@query("app_summary", f"""
WITH {INFOS_SQL}
SELECT pool, CAST(sum(j) AS BIGINT) AS completed_jobs, CAST(sum(s) AS BIGINT) AS completed_stages
FROM (SELECT pool, CASE WHEN status = 'SUCCEEDED' THEN 1 ELSE 0 END AS j, 0 AS s FROM v_jobs
      UNION ALL
      SELECT v.pool, 0, CASE WHEN i.status = 'COMPLETE' THEN 1 ELSE 0 END
      FROM infos i JOIN v_jobs v ON v.job_id = i.job_id) u GROUP BY pool
""", "v_jobs")
def _(t):
    stages = with_status(stage_infos(t)).join(t.jobs.select("job_id", "pool"), "job_id")
    return tasks.app_summary(t.jobs, stages, "pool")


@query("stage_status", f"WITH {INFOS_SQL} SELECT job_id, stage_id, status FROM infos")
def _(t):
    return with_status(stage_infos(t)).select("job_id", "stage_id", "status")


@query("job_rollup", f"""
WITH {INFOS_SQL}
SELECT j.job_id, j.status,
       count(CASE WHEN i.status = 'COMPLETE' THEN 1 END) AS completed_stages,
       count(CASE WHEN i.status = 'SKIPPED' OR (i.status = 'PENDING' AND j.status <> 'RUNNING')
             THEN 1 END) AS skipped_stages,
       count(CASE WHEN i.status = 'FAILED' THEN 1 END) AS failed_stages,
       count(CASE WHEN i.status = 'ACTIVE' THEN 1 END) AS active_stages,
       CAST(coalesce(sum(CASE WHEN i.status = 'SKIPPED'
                    OR (i.status = 'PENDING' AND j.status <> 'RUNNING')
             THEN i.num_tasks END), 0) AS BIGINT) AS skipped_tasks
FROM v_jobs j LEFT JOIN infos i ON i.job_id = j.job_id GROUP BY j.job_id, j.status
""", "v_jobs")
def _(t):
    jobs = t.jobs.select("job_id", F.when(F.col("status") == "SUCCEEDED", True)
                         .when(F.col("status") == "FAILED", False).alias("succeeded"))
    return lifecycle.job_rollup(jobs, with_status(stage_infos(t)))


@query("stage_to_jobs", """
SELECT DISTINCT l_orderkey AS job_id, l_suppkey AS stage_id, s_name AS stage_name
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
""")
def _(t):
    lists = t.read("lineitem").select(F.col("l_orderkey").alias("job_id"),
                                      F.array("l_suppkey").alias("stage_ids"))
    stages = t.read("supplier").select(F.col("s_suppkey").alias("stage_id"),
                                       F.col("s_name").alias("stage_name"))
    return (lifecycle.stage_to_jobs(lists, stages)
            .select("job_id", "stage_id", "stage_name").distinct())


@query("pool_members", f"""
WITH {INFOS_SQL}
SELECT DISTINCT coalesce(CASE WHEN j.pool <> '5-LOW' THEN j.pool END, 'default') AS pool,
       i.stage_id
FROM infos i JOIN v_jobs j ON j.job_id = i.job_id WHERE i.status = 'ACTIVE'
""", "v_jobs")
def _(t):
    pools = t.jobs.select("job_id", F.when(F.col("pool") != "5-LOW", F.col("pool")).alias("pool"))
    return lifecycle.pool_members(with_status(stage_infos(t)).join(pools, "job_id"))


QUANTILE_SQL = """
  SELECT g.stage_id, m.which, q.quantile, g.n AS task_count, g.stale,
         coalesce(m.vals[least(CAST(floor({used} * g.n) AS BIGINT), g.n - 1) + 1],
                  'nan'::DOUBLE) AS value
  FROM (SELECT stage_id, count(*) AS n, stage_id % 2 = 0 AND bool_or(
               host_id = 0 AND outcome = 'killed') AS stale
        FROM v_tasks WHERE run_time >= 0 GROUP BY stage_id) g
  JOIN (SELECT stage_id, which, list_sort(list(value) FILTER (WHERE value >= 0)) AS vals FROM (
          SELECT stage_id, unnest([1, 2, 3]) AS which, CAST(unnest([run_time, gc_time,
                 maybe_negative_metric]) AS DOUBLE) AS value FROM v_tasks) l
        GROUP BY stage_id, which) m ON m.stage_id = g.stage_id
  CROSS JOIN (SELECT CAST(unnest([{qs}]) AS DOUBLE) AS quantile) q
"""
METRIC_SQL = """
  CASE which WHEN 1 THEN 'run_time' WHEN 2 THEN 'gc_time' ELSE 'maybe_negative_metric' END
    AS metric
"""
METRICS = ["run_time", "gc_time", "maybe_negative_metric"]
DEFAULT_QUANTILES = [0.05, 0.25, 0.5, 0.75, 0.95, 1.0]


@query("task_quantiles", f"""
SELECT stage_id, {METRIC_SQL}, quantile, task_count, value FROM (""" + QUANTILE_SQL.format(
    used="q.quantile", qs=", ".join(str(q) for q in DEFAULT_QUANTILES)) + ") x", "v_tasks")
def _(t):
    return quantiles.metric_quantiles(t.tasks, ["stage_id"], METRICS, DEFAULT_QUANTILES,
                                      "run_time")


@query("quantile_reuse", f"""
SELECT stage_id, {METRIC_SQL}, quantile, task_count, value, NOT stale AS reused FROM (
""" + QUANTILE_SQL.format(
    used="(CASE WHEN q.quantile = 0.951::DOUBLE AND NOT g.stale THEN 0.95::DOUBLE "
         "ELSE q.quantile END)", qs="0.25, 0.5, 0.951") + ") x", "v_tasks")
def _(t):
    # Stored figures that are stale for the stages which got more tasks since.
    late = ((F.col("host_id") == 0) & (F.col("outcome") == "killed")
            & (F.col("stage_id") % 2 == 0))
    stored = written(quantiles.to_stored(quantiles.metric_quantiles(
        t.tasks.filter(~late), ["stage_id"], METRICS, DEFAULT_QUANTILES, "run_time"),
        ["stage_id"]))
    return quantiles.quantiles_with_reuse(t.tasks, stored, ["stage_id"], METRICS,
                                          [0.25, 0.5, 0.951], "run_time")


@query("stage_details", """
SELECT stage_id, 'task' AS entry, concat(CAST(job_id AS VARCHAR), '/', CAST(task_index AS VARCHAR),
       '/', CAST(part_id AS VARCHAR)) AS entry_key, run_time AS value FROM v_tasks
UNION ALL
SELECT stage_id, 'executor', CAST(executor_id AS VARCHAR), CAST(sum(run_time) AS BIGINT)
FROM v_tasks GROUP BY stage_id, executor_id
""", "v_tasks")
def _(t):
    return tasks.stage_details(t.tasks, ["stage_id"], ["job_id", "task_index", "part_id"],
                               "executor_id", "run_time")


@query("stage_sizes", """
SELECT stage_id, count(*) AS num_tasks, count(DISTINCT executor_id) AS num_executors
FROM v_tasks GROUP BY stage_id
""", "v_tasks")
def _(t):
    return tasks.stage_sizes(t.tasks, ["stage_id"], "executor_id")


CONTAINERS_SQL = """
pairs AS (SELECT DISTINCT host_id, member_id * 1000 + k AS container_id FROM v_beats
          WHERE kind = 'heartbeat'
            AND member_id * 1000 + k NOT IN (SELECT member_id * 1000 + k FROM v_beats
                                             WHERE kind IN ('remove', 'failure')))
"""


def container_pairs(t):
    named = t.beats.withColumn("container_id", F.col("member_id") * 1000 + F.col("k"))
    return tasks.host_containers(named.filter(F.col("kind") == "heartbeat"),
                                 named.filter(F.col("kind").isin("remove", "failure")))


@query("host_container_sets", f"""
WITH {CONTAINERS_SQL} SELECT host_id, container_id FROM pairs
""", "v_beats")
def _(t):
    return container_pairs(t).select("host_id", "container_id")


@query("containers_per_host", f"""
WITH {CONTAINERS_SQL}
SELECT host_id, count(DISTINCT container_id) AS containers FROM pairs GROUP BY host_id
""", "v_beats")
def _(t):
    return tasks.containers_per_host(container_pairs(t))


@query("slot_capacity", """
SELECT rack_id, CAST(sum(total_cores // 2) AS BIGINT) AS slots,
       CAST(greatest(sum(total_cores), 2) AS BIGINT) AS default_parallelism
FROM v_executors GROUP BY rack_id
""", "v_executors")
def _(t):
    return tasks.slot_capacity(t.executors, ["rack_id"], "total_cores", 2)


@query("quote_high", """
SELECT security, max(price) AS high FROM v_quotes GROUP BY security
""", "v_quotes")
def _(t):
    return liveness.quote_high(t.quotes)


@query("all_nodes_excluded", """
SELECT n.rack_id, n.nodes, coalesce(x.excluded_nodes, 0) AS excluded_nodes,
       coalesce(x.excluded_nodes, 0) >= n.nodes AS all_excluded
FROM (SELECT rack_id, count(DISTINCT host_id) AS nodes FROM v_executors GROUP BY rack_id) n
LEFT JOIN (SELECT rack_id, count(DISTINCT host_id) AS excluded_nodes FROM v_executors
           WHERE NOT is_active GROUP BY rack_id) x ON x.rack_id = n.rack_id
""", "v_executors")
def _(t):
    return tasks.all_nodes_excluded(t.executors.filter(~F.col("is_active")), t.executors,
                                    "rack_id", "host_id")


@query("pending_by_location", """
SELECT CASE WHEN grouping(host_id) = 0 THEN 'host' WHEN grouping(rack_id) = 0 THEN 'rack'
            ELSE 'any' END AS tier,
       CASE WHEN grouping(host_id) = 0 THEN CAST(host_id AS VARCHAR)
            WHEN grouping(rack_id) = 0 THEN CAST(rack_id AS VARCHAR) ELSE '*' END AS location,
       CAST(sum(total_cores) AS BIGINT) AS pending
FROM v_executors GROUP BY GROUPING SETS ((host_id), (rack_id), ())
""", "v_executors")
def _(t):
    return tasks.pending_by_location(t.executors, "host_id", "rack_id", "total_cores")


@query("last_attempt", """
SELECT stage_id, attempt_id, run_time FROM (
  SELECT part_id AS stage_id, task_index AS attempt_id, CAST(sum(run_time) AS BIGINT) AS run_time,
         row_number() OVER (PARTITION BY part_id ORDER BY task_index DESC) AS rn
  FROM v_tasks GROUP BY part_id, task_index) x WHERE rn = 1
""", "v_tasks")
def _(t):
    attempts = t.tasks.groupBy(F.col("part_id").alias("stage_id"),
                               F.col("task_index").alias("attempt_id")).agg(
        F.sum("run_time").alias("run_time"))
    return windows.last_attempt(attempts)
