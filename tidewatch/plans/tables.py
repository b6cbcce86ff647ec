"""The shared test tables and the event, task, executor and settings views derived from them."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import Ordered


def number_in(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "").try_cast("int")


class Tables:
    """Lazy readers; every view is a plain DataFrame, so filters and pruning reach the scan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def beats(self) -> DataFrame:
        k = F.col("k")
        return (self.read("events").withColumn("k", number_in(F.col("props")))
                .select("event_id", F.col("user_id").alias("member_id"),
                        (F.col("user_id") % 25).alias("host_id"), "ts", "k",
                        F.when(F.col("event_type") == "signup", "register")
                        .when((F.col("event_type") == "error") & (k % 5 == 0), "remove")
                        .when(F.col("event_type") == "error", "failure")
                        .otherwise("heartbeat").alias("kind")))

    @cached_property
    def quotes(self) -> DataFrame:
        return self.read("events").select(
            "event_id", F.col("event_type").alias("security"), "ts",
            F.col("value").alias("price"))

    @cached_property
    def deltas(self) -> DataFrame:
        return self.read("events").select(
            "event_id", F.col("user_id").alias("member_id"),
            F.col("event_type").alias("block_id"), "ts",
            (F.floor("value").cast("bigint") - 60).alias("delta"))

    @cached_property
    def tasks(self) -> DataFrame:
        part, line, flag = F.col("l_partkey"), F.col("l_linenumber"), F.col("l_returnflag")
        return self.read("lineitem").select(
            F.col("l_orderkey").alias("job_id"), F.col("l_suppkey").alias("stage_id"),
            line.alias("task_index"), part.alias("part_id"),
            (part % 16).alias("executor_id"), (part % 5).alias("host_id"),
            F.col("l_shipdate").alias("launch_time"),
            F.when(flag == "N", "completed").when(flag == "R", "killed")
            .otherwise("failed").alias("outcome"),
            F.when(flag == "R", F.concat(F.lit("reason "), F.col("l_linestatus")))
            .alias("kill_reason"),
            F.when(line % 3 == 0, "ANY").when(line % 3 == 1, "NODE_LOCAL")
            .otherwise("RACK_LOCAL").alias("locality"),
            F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("run_time"),
            F.round(F.col("l_discount") * F.col("l_extendedprice")).cast("bigint")
            .alias("gc_time"),
            (F.col("l_quantity").cast("bigint") * 1024).alias("input_bytes"),
            (F.col("l_quantity").cast("bigint") * 10 - 30).alias("maybe_negative_metric"))

    @cached_property
    def jobs(self) -> DataFrame:
        status = F.col("o_orderstatus")
        return self.read("orders").select(
            F.col("o_orderkey").alias("job_id"), F.col("o_orderpriority").alias("pool"),
            F.col("o_orderdate").alias("submission_time"),
            F.when(status == "F", "SUCCEEDED").when(status == "P", "FAILED")
            .otherwise("RUNNING").alias("status"))

    @cached_property
    def executors(self) -> DataFrame:
        outcome = F.col("outcome")
        totals = self.tasks.groupBy("stage_id").agg(
            F.count_if(outcome == "failed").alias("failed"),
            F.count_if(outcome == "completed").alias("completed"),
            F.count_if(outcome == "killed").alias("killed"),
            F.count(F.lit(1)).alias("total_tasks"),
            F.sum("run_time").alias("total_duration"), F.sum("gc_time").alias("total_gc"),
            F.sum("input_bytes").alias("input_bytes"))
        key, balance = F.col("s_suppkey"), F.col("s_acctbal")
        return (self.read("supplier")
                .join(self.read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
                .join(totals, key == F.col("stage_id"), "left")
                .select(key.alias("id"), F.col("s_nationkey").alias("host_id"),
                        F.col("n_regionkey").alias("rack_id"),
                        (balance >= 3000).alias("is_active"),
                        (key % 11 == 0).alias("is_blacklisted"),
                        (key % 8 + 1).cast("int").alias("total_cores"),
                        F.when(key % 4 != 0, F.floor(F.abs(balance)).cast("bigint"))
                        .alias("on_heap_used"),
                        "failed", "completed", "killed", "total_tasks", "total_duration",
                        "total_gc", "input_bytes"))

    @cached_property
    def settings(self) -> DataFrame:
        k = F.col("k")
        return self.beats.select(
            F.col("member_id").alias("scope"),
            F.concat(F.lit("spark."), k.cast("string"), F.lit(".port")).alias("key"),
            "event_id",
            F.when(k % 3 == 0, F.concat(F.lit("${spark."), (k + 1).cast("string"),
                                        F.lit(".port}")))
            .otherwise(F.concat(k.cast("string"), F.when(k % 2 == 0, "s").otherwise("ms")))
            .alias("value"))

    @cached_property
    def edges(self) -> DataFrame:
        lines = self.read("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
            "l_extendedprice", "l_quantity")
        linked = Ordered(lines, ["l_orderkey"],
                         ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                          "l_extendedprice", "l_quantity"]).next("dst", F.col("l_partkey")).df
        return (linked.filter(F.col("dst").isNotNull())
                .select(F.col("l_partkey").alias("src"), "dst"))

    @cached_property
    def nodes(self) -> DataFrame:
        return (self.read("lineitem").groupBy(F.col("l_partkey").alias("node"))
                .agg(F.min("l_suppkey").alias("stage_id")))


#: The same views as SQL, for the DuckDB side of the comparison.
VIEW_SQL = {
    "v_beats": """
        SELECT event_id, user_id AS member_id, user_id % 25 AS host_id, ts, k,
               CASE WHEN event_type = 'signup' THEN 'register'
                    WHEN event_type = 'error' AND k % 5 = 0 THEN 'remove'
                    WHEN event_type = 'error' THEN 'failure' ELSE 'heartbeat' END AS kind
        FROM (SELECT *, CAST(regexp_replace(props, '[^0-9]', '', 'g') AS INT) AS k FROM events) e
    """,
    "v_quotes": "SELECT event_id, event_type AS security, ts, value AS price FROM events",
    "v_deltas": """
        SELECT event_id, user_id AS member_id, event_type AS block_id, ts,
               CAST(floor(value) AS BIGINT) - 60 AS delta FROM events
    """,
    "v_tasks": """
        SELECT l_orderkey AS job_id, l_suppkey AS stage_id, l_linenumber AS task_index,
               l_partkey AS part_id, l_partkey % 16 AS executor_id, l_partkey % 5 AS host_id,
               l_shipdate AS launch_time,
               CASE l_returnflag WHEN 'N' THEN 'completed' WHEN 'R' THEN 'killed'
                    ELSE 'failed' END AS outcome,
               CASE l_returnflag WHEN 'R' THEN concat('reason ', l_linestatus) END AS kill_reason,
               CASE l_linenumber % 3 WHEN 0 THEN 'ANY' WHEN 1 THEN 'NODE_LOCAL'
                    ELSE 'RACK_LOCAL' END AS locality,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS run_time,
               CAST(round(l_discount * l_extendedprice) AS BIGINT) AS gc_time,
               CAST(l_quantity AS BIGINT) * 1024 AS input_bytes,
               CAST(l_quantity AS BIGINT) * 10 - 30 AS maybe_negative_metric
        FROM lineitem
    """,
    "v_jobs": """
        SELECT o_orderkey AS job_id, o_orderpriority AS pool, o_orderdate AS submission_time,
               CASE o_orderstatus WHEN 'F' THEN 'SUCCEEDED' WHEN 'P' THEN 'FAILED'
                    ELSE 'RUNNING' END AS status
        FROM orders
    """,
    "v_executors": """
        SELECT s.s_suppkey AS id, s.s_nationkey AS host_id, n.n_regionkey AS rack_id,
               s.s_acctbal >= 3000 AS is_active, s.s_suppkey % 11 = 0 AS is_blacklisted,
               CAST(s.s_suppkey % 8 + 1 AS INT) AS total_cores,
               CASE WHEN s.s_suppkey % 4 <> 0
                    THEN CAST(floor(abs(s.s_acctbal)) AS BIGINT) END AS on_heap_used,
               t.failed, t.completed, t.killed, t.total_tasks, t.total_duration, t.total_gc,
               t.input_bytes
        FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
        LEFT JOIN (SELECT stage_id, count(CASE WHEN outcome = 'failed' THEN 1 END) AS failed,
                          count(CASE WHEN outcome = 'completed' THEN 1 END) AS completed,
                          count(CASE WHEN outcome = 'killed' THEN 1 END) AS killed,
                          count(*) AS total_tasks,
                          CAST(sum(run_time) AS BIGINT) AS total_duration,
                          CAST(sum(gc_time) AS BIGINT) AS total_gc,
                          CAST(sum(input_bytes) AS BIGINT) AS input_bytes
                   FROM v_tasks GROUP BY stage_id) t
          ON t.stage_id = s.s_suppkey
    """,
    "v_settings": """
        SELECT member_id AS scope, concat('spark.', CAST(k AS VARCHAR), '.port') AS key, event_id,
               CASE WHEN k % 3 = 0
                    THEN concat('${spark.', CAST(k + 1 AS VARCHAR), '.port}')
                    ELSE concat(CAST(k AS VARCHAR),
                                CASE k % 2 WHEN 0 THEN 's' ELSE 'ms' END) END AS value
        FROM v_beats
    """,
    "v_edges": """
        SELECT src, dst FROM (SELECT l_partkey AS src, lead(l_partkey) OVER (
            PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate,
            l_extendedprice, l_quantity) AS dst FROM lineitem) x WHERE dst IS NOT NULL
    """,
    "v_nodes": """
        SELECT l_partkey AS node, min(l_suppkey) AS stage_id FROM lineitem GROUP BY l_partkey
    """,
}

VIEW_NEEDS = {"v_executors": ("v_tasks",), "v_settings": ("v_beats",)}
