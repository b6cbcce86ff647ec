"""Queries: view scans, filters, sorting and paging."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import view
from .registry import query

TASK_KEYS = ["job_id", "task_index", "part_id", "stage_id", "launch_time", "run_time",
             "input_bytes"]


@query("filter_status", """
SELECT job_id, pool, submission_time, status FROM v_jobs WHERE status IN ('RUNNING', 'FAILED')
""", "v_jobs")
def _(t):
    return view.filter_status(t.jobs, ["RUNNING", "FAILED"], "job_id")


@query("active_only", """
SELECT id, host_id, total_cores, is_active FROM v_executors WHERE is_active
""", "v_executors")
def _(t):
    return view.active_only(t.executors.select("id", "host_id", "total_cores", "is_active"),
                            True, "id")


@query("cached_only", """
SELECT l_partkey AS dataset, count(CASE WHEN l_returnflag = 'N' THEN 1 END) AS num_cached
FROM lineitem GROUP BY l_partkey HAVING count(CASE WHEN l_returnflag = 'N' THEN 1 END) > 0
""")
def _(t):
    datasets = (t.tasks.groupBy(F.col("part_id").alias("dataset"))
                .agg(F.count_if(F.col("outcome") == "completed").alias("num_cached")))
    return view.cached_only(datasets)


@query("index_equals", """
SELECT job_id, task_index, part_id, run_time FROM v_tasks WHERE stage_id = 7
""", "v_tasks")
def _(t):
    tasks = t.tasks.select("stage_id", *[k for k in TASK_KEYS if k != "stage_id"])
    return (view.view(tasks, "stage_id", TASK_KEYS, first=7, last=7)
            .select("job_id", "task_index", "part_id", "run_time"))


@query("range_scan", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 250000
""")
def _(t):
    orders = t.read("orders").select("o_orderkey", "o_totalprice")
    return view.view(orders, "o_totalprice", ["o_orderkey"], first=250000.0, last=100000.0,
                     reverse=True)


@query("parent_scoped", """
SELECT job_id, task_index, part_id, run_time FROM v_tasks
WHERE stage_id = 11 AND run_time >= 1000000
""", "v_tasks")
def _(t):
    return (view.view(t.tasks, "run_time", TASK_KEYS, first=1000000, parent_index="stage_id",
                      parent=11)
            .select("job_id", "task_index", "part_id", "run_time"))


@query("row_search", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
WHERE lower(CAST(c_custkey AS VARCHAR)) LIKE '%mach%' OR lower(c_name) LIKE '%mach%'
   OR CAST(c_nationkey AS VARCHAR) LIKE '%mach%' OR CAST(c_acctbal AS VARCHAR) LIKE '%mach%'
   OR lower(c_mktsegment) LIKE '%mach%'
""")
def _(t):
    return view.row_search(t.read("customer"), "Mach")


@query("index_sort", """
SELECT o_orderkey, o_orderdate,
       row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders
""")
def _(t):
    orders = t.read("orders").select("o_orderkey", "o_orderdate")
    return view.numbered(orders, view.sort_order("o_orderdate", ["o_orderkey"], reverse=True))


@query("page", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 50 OFFSET 120
""")
def _(t):
    return view.page(t.read("orders").select("o_orderkey", "o_totalprice"),
                     view.sort_order("o_totalprice", ["o_orderkey"]), skip=120, max=50)


@query("page_deep", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey OFFSET 9000
""")
def _(t):
    return view.page(t.read("orders").select("o_orderkey", "o_totalprice"),
                     view.sort_order("o_totalprice", ["o_orderkey"]), skip=9000)


@query("task_sort_modes", """
SELECT 'ID' AS mode, job_id, task_index, part_id, run_time FROM (
  SELECT * FROM v_tasks WHERE stage_id = 5 ORDER BY job_id, task_index, part_id, launch_time,
    run_time, input_bytes LIMIT 20) a
UNION ALL
SELECT 'INCREASING_RUNTIME', job_id, task_index, part_id, run_time FROM (
  SELECT * FROM v_tasks WHERE stage_id = 5 ORDER BY run_time, job_id, task_index, part_id,
    launch_time, input_bytes LIMIT 20) b
UNION ALL
SELECT 'DECREASING_RUNTIME', job_id, task_index, part_id, run_time FROM (
  SELECT * FROM v_tasks WHERE stage_id = 5 ORDER BY run_time DESC, job_id DESC, task_index DESC,
    part_id DESC, launch_time DESC, input_bytes DESC LIMIT 20) c
""", "v_tasks")
def _(t):
    result = None
    for mode in view.TASK_ORDERS:
        rows = (view.task_page(t.tasks, 5, mode, TASK_KEYS, max=20)
                .select(F.lit(mode).alias("mode"), "job_id", "task_index", "part_id", "run_time"))
        result = rows if result is None else result.unionByName(rows)
    return result


@query("tail_n", """
SELECT event_id, ts, event_type FROM events ORDER BY event_id DESC LIMIT 100
""")
def _(t):
    return view.tail_n(t.read("events").select("event_id", "ts", "event_type"), "event_id", 100)


@query("batch_next", """
SELECT o_custkey, o_orderkey, (SELECT count(*) FROM orders
    WHERE o_custkey > 500 OR (o_custkey = 500 AND o_orderkey > 3)) > 200 AS more
FROM orders WHERE o_custkey > 500 OR (o_custkey = 500 AND o_orderkey > 3)
ORDER BY o_custkey, o_orderkey LIMIT 200
""")
def _(t):
    rows, more = view.batch_next(t.read("orders").select("o_custkey", "o_orderkey"),
                                 ["o_custkey", "o_orderkey"], (500, 3), 200)
    return rows.withColumn("more", F.lit(more))


@query("composite_key_sort", """
SELECT o_orderkey, row_number() OVER (
  ORDER BY CASE WHEN o_orderstatus = 'F' THEN [o_custkey]
                ELSE [o_custkey, CAST(floor(o_totalprice) AS BIGINT)] END, o_orderkey) AS rn
FROM orders
""")
def _(t):
    total = F.floor("o_totalprice").cast("bigint")
    orders = t.read("orders").select("o_orderkey", F.when(
        F.col("o_orderstatus") == "F", F.array("o_custkey"))
        .otherwise(F.array(F.col("o_custkey"), total)).alias("composite"))
    return view.numbered(orders, ["composite", "o_orderkey"]).select("o_orderkey", "rn")
