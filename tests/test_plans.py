"""Physical plans: no Python, cross joins or one-task windows where rows are unbounded."""

import pytest

import __spark_entry__ as entry
from tidewatch.operators import keyed, view
from tidewatch.plans import catalog
from tidewatch.plans.tables import Tables

FOLDER = "/root/testdata/sf0.001"
PYTHON = {"throttle", "exclusion_windows"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


BATCH = sorted(n for n in catalog.QUERIES
               if not n.startswith("stream_") and n not in {
                   "isolate_errors", "late_rows", "stateful_upsert_sink"})


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(catalog.QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    if name not in PYTHON:
        for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                     "MapInPandas"):
            assert node not in text


@pytest.mark.parametrize("name", ["index_sort", "page_deep", "app_id_sort", "live_count",
                                  "failures_in_interval_overall", "timeline_rows"])
def test_large_orderings_do_not_use_one_task(spark, small_tasks, name):
    text = plan(catalog.QUERIES[name](spark, FOLDER))
    for line in text.splitlines():
        if "SinglePartition" in line:
            pytest.fail(line)


def test_latest_by_key_limits_before_the_shuffle(spark):
    text = plan(keyed.latest_by_key(Tables(spark, FOLDER).beats, ["member_id"], "event_id"))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_bounds_and_columns_reach_the_scan(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet").select("o_orderkey", "o_totalprice")
    text = plan(view.view(orders, "o_totalprice", ["o_orderkey"], first=1.0, last=2.0))
    assert "GreaterThanOrEqual(o_totalprice,1.0)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_pages_are_top_k(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    assert "TakeOrderedAndProject" in plan(view.page(orders, ["o_orderkey"], 10, 5))


def test_rollup_is_one_scan_of_the_members(spark):
    text = plan(entry.entry(spark))
    assert text.count("supplier.parquet") <= 2


def test_event_logs_and_routes_are_one_scan(spark):
    for name in ("event_log_parse", "event_log_quarantine", "event_route", "validate_split"):
        assert plan(catalog.QUERIES[name](spark, FOLDER)).count("FileScan") == 1
