"""Order-dependent columns: spread over tasks they must equal plain windows."""

import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import sorting
from tidewatch.operators.view import numbered
from tidewatch.operators.ordered import Ordered

ROWS = 400


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = []
    for i in range(ROWS):
        # Key 1 holds a third of all rows; key null must work too.
        key = 1 if i % 3 == 0 else rng.choice([None, 2, 3, 4, 5, 6, 7])
        data.append((key, rng.randrange(60), i, rng.choice([None, -3, -1, 2, 5])))
    return spark.createDataFrame(data, "k int, t int, id int, v bigint")


def columns(df, keys, limit):
    steps = Ordered(df, keys, ["t desc", "id"], limit=limit)
    steps.row_number("rn").running("total", F.sum, F.col("v")).running("low", F.min, F.col("v"))
    steps.running("high_after", F.max, F.col("v"), following=True)
    steps.last_known("last", F.col("v")).next_known("soon", F.col("v"))
    steps.previous("before", F.col("v")).next("after", F.col("v"))
    return steps


@pytest.mark.parametrize("keys", [["k"], []])
def test_spread_equals_plain(spark, rows, keys):
    plain, spread = columns(rows, keys, 10_000), columns(rows, keys, 9)
    assert not plain.spread and spread.spread
    assert sorted(map(str, plain.df.collect())) == sorted(map(str, spread.df.collect()))


def test_hot_key_is_split(spark, rows):
    steps = Ordered(rows, ["k"], ["t", "id"], limit=20)
    parts = (steps.rows.filter("k = 1").groupBy("__chunk").count().collect())
    assert len(parts) > 3
    assert max(p["count"] for p in parts) < ROWS / 6


def test_bound_avoids_spreading(spark, rows):
    few = rows.groupBy("k", "t").agg(F.sum("v").alias("v"))
    assert not Ordered(few, ["k"], ["t"], limit=1000, bound=(rows, 1)).spread


def test_empty_input(spark, rows):
    empty = rows.filter("false")
    assert columns(empty, ["k"], 9).df.count() == 0
    assert columns(empty, [], 9).df.count() == 0


def test_looking_ahead_needs_names(rows):
    with pytest.raises(TypeError):
        Ordered(rows, ["k"], [F.col("t")], limit=10_000).next_known("x", F.col("v"))


def test_numbers_by_a_sort_key_take_texts_apart_once(spark, small_tasks):
    """The key is stored with the rows, so numbering a spread table does not compute it again."""
    days = [(i, f" {i % 12 + 1}/{i % 28 + 1}/20{i % 7 + 10}") for i in range(60)]
    rows = spark.createDataFrame(days, "id bigint, d string")
    got = numbered(sorting.with_sort_key(rows, "d", ["id"]), ["sort_key", "id"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan.lower() and "rlike" not in plan.lower()
    assert plan.count("Window [row_number") == 1 and plan.count("Window [") == 1
    def key(row):
        month, day, year = row[1].strip().split("/")
        return int(year), int(month), int(day), row[0]
    want = [r[0] for r in sorted(days, key=key)]
    assert [(r["rn"], r["id"]) for r in got.orderBy("rn").collect()] == list(enumerate(want, 1))
