"""Streams fed in several batches, with a restart, against the batch functions."""

import datetime as dt
import re
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import keyed, lifecycle, liveness, sequential
from tidewatch.operators import windows as failure_windows
from tidewatch.streaming import keyed_state, open_state, run, sinks, windows

from .test_rules import BASE, at, member_rows, stamped

SCHEMA = "m bigint, id bigint, ts timestamp, kind string"


def rows_of(df):
    return sorted(map(str, stamped(df).collect()))


@pytest.fixture
def fed(spark, tmp_path):
    """Feed rows in two runs of the stream with a restart between, then a row far ahead."""
    def feed(rows, build, schema=SCHEMA, column=2):
        folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
        rows = sorted(rows, key=lambda r: r[column])
        half = -(-len(rows) // 2)
        batches = [rows[:half], rows[half:]]
        # Inside a batch the order of rows must not matter.
        rng = random.Random(1)
        far = list(rows[-1])
        far[0], far[1], far[column] = 999, 999_999, at(BASE + 10**12)
        batches.append([tuple(far)])
        frame = spark.createDataFrame([], schema)
        result = None
        for n, batch in enumerate(batches):
            batch = list(batch)
            rng.shuffle(batch)
            spark.createDataFrame(batch, schema).coalesce(1).write.parquet(f"{folder}/{n}")
            stream = run.event_stream(spark, f"{folder}/*", frame.schema).withWatermark(
                "ts", "0 seconds")
            result = run.run_to_table(build(stream), path=out, checkpoint=state)
        return result
    return feed


def member_frame(spark, seed):
    rows = [(m, i, at(BASE + (t - BASE) * 1000), k) for m, i, t, k in member_rows(seed)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_live_intervals(spark, fed):
    rows, batch = member_frame(spark, 11)
    got = fed(rows, lambda s: keyed_state.live_intervals(s, "m", "ts", "id", "kind", 2_000_000,
                                                         700_000))
    want = liveness.live_intervals(batch, "m", "ts", "id", "kind", 2_000_000, 700_000,
                                   until_us=BASE + 10**12)
    assert rows_of(got.filter("m < 999")) == rows_of(want)


def test_reregister_requests(spark, fed):
    rows, batch = member_frame(spark, 12)
    got = fed(rows, lambda s: keyed_state.reregister_requests(s, "m", "ts", "id", "kind",
                                                              2_000_000, 700_000))
    want = liveness.reregister_requests(batch, "m", "ts", "id", "kind", 2_000_000, 700_000)
    assert {r["id"] for r in got.filter("m < 999").collect()} == {r["id"] for r in want.collect()}


def test_expire_workers(spark, fed):
    rows, batch = member_frame(spark, 13)
    got = fed(rows, lambda s: keyed_state.expire_workers(s, "m", "ts", "id", "kind", 1_500_000))
    want = liveness.expire_workers(batch, "m", "ts", "id", "kind", 1_500_000,
                                   until_us=BASE + 10**12)
    assert rows_of(got.filter("m < 999")) == rows_of(want)


def test_throttle(spark, fed):
    rows, batch = member_frame(spark, 14)
    end = F.col("kind") == "remove"
    got = fed(rows, lambda s: keyed_state.throttle(s.withColumn("end", end), "m", "ts", "id",
                                                   2_500_000, "end"))
    want = sequential.throttle(batch.withColumn("end", end), ["m"], "ts", "id", 2_500_000, "end")
    assert rows_of(got.filter("m < 999").select("m", "id", "ts")) == rows_of(want)


def test_exclusion(spark, fed):
    rows, batch = member_frame(spark, 15)
    got = fed(rows, lambda s: keyed_state.exclusion_windows(s, "m", "ts", "id", 2, 4_000_000,
                                                            3_000_000))
    want = sequential.exclusion_windows(batch, "m", "ts", "id", 2, 4_000_000, 3_000_000)
    columns = ["m", "ts", "recent", "tracked", "excluded_until"]
    assert rows_of(got.filter("m < 999").select(*columns)) == rows_of(want.select(*columns))


def test_quote_bars(spark, fed):
    rng = random.Random(16)
    rows = [(i % 3, i, at(BASE + i * 700_000 + rng.randrange(100)), rng.randrange(100) / 4)
            for i in range(80)]
    schema = "security bigint, event_id bigint, ts timestamp, price double"
    got = fed(rows, lambda s: liveness.quote_bars(s, "10 seconds"), schema)
    want = liveness.quote_bars(spark.createDataFrame(rows, schema), "10 seconds")
    assert rows_of(got.filter("security < 999")) == rows_of(want)


def test_upsert_table_over_batches_and_replays(spark, tmp_path):
    rng = random.Random(17)
    schema = "k int, seq int, v string, op string"
    rows = [(rng.randrange(12), i, f"v{i}", rng.choice(["put", "put", "delete"]))
            for i in range(90)]
    frame = spark.createDataFrame(rows, schema)
    table = sinks.UpsertTable(spark, str(tmp_path / "t"), frame.schema, ["k"], ["seq"], op_col="op")
    assert table.read().count() == 0
    for n in range(3):
        batch = spark.createDataFrame(rows[n * 30:(n + 1) * 30], schema)
        table.write_batch(batch, n)
        table.write_batch(batch, n)
    want = keyed.apply_changes(frame, ["k"], "seq")
    assert rows_of(table.read().drop("op")) == rows_of(want)
    for last in (1, 1, 2):
        table.compact(last)
        assert rows_of(table.read().drop("op")) == rows_of(want)
    # Replaced batches are not read any more.
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*batch_id#\d+L > 2", plan)


def test_threshold_action(spark, tmp_path):
    calls = []
    stored = spark.createDataFrame([("a",)] * 4 + [("b",)] * 3, "t string")
    batch = spark.createDataFrame([("a",), ("b",), ("c",)], "t string")
    sinks.on_threshold("t", 3, lambda kind, n: calls.append((kind, n)), lambda: stored)(batch, 0)
    assert calls == [("a", 4)]


def test_threshold_counts(spark, tmp_path):
    calls = []
    counts = sinks.ThresholdCounts(spark, str(tmp_path / "n"), "t", 3, lambda kind, n: calls.append((kind, n)))
    first = spark.createDataFrame([("a",)] * 3 + [("b",)] * 4, "t string")
    counts.write_batch(first, 0)
    counts.write_batch(first, 0)
    counts.write_batch(first.limit(0), 1)
    counts.write_batch(spark.createDataFrame([("a",)], "t string"), 2)
    assert calls == [("b", 4), ("b", 4), ("a", 4)]


def test_threshold_counts_read_one_batch(spark, tmp_path, monkeypatch):
    """Totals go from batch to batch, over a gap in the ids too; a batch that comes again changes nothing."""
    calls = []
    counts = sinks.ThresholdCounts(spark, str(tmp_path / "n"), "t", 10, lambda kind, n: calls.append((kind, n)))
    for batch_id in (3, 4, 7, 7):
        counts.write_batch(spark.createDataFrame([("a",)] * 4 + [(f"b{batch_id}",)], "t string"), batch_id)
    assert calls == [("a", 12), ("a", 12)]
    read = []
    before = counts._before

    def seen(batch_id, own):
        out = before(batch_id, own)
        read.append({f.split("/batch_id=")[1].split("/")[0] for f in out.inputFiles()})
        return out

    monkeypatch.setattr(counts, "_before", seen)
    counts.write_batch(spark.createDataFrame([("c",)], "t string"), 8)
    assert read == [{"7"}] and len(calls) == 2


def test_failures_are_kept(spark, tmp_path):
    log = sinks.FailureLog(spark, str(tmp_path / "log"))
    assert log.read().count() == 0
    log("x", 3, ValueError("one"))
    log("x", 3, ValueError("again"))
    log("x", 4, ValueError("two"))
    log("y", 3, KeyError("k"))
    assert sorted(map(tuple, log.read().collect())) == [("x", "again"), ("x", "two"), ("y", "'k'")]


def test_first_registrations(spark, fed):
    rows, _ = member_frame(spark, 35)
    rows = [(m, i, t, k) for n, (m, i, t, k) in enumerate(sorted(rows, key=lambda r: r[2])) if k == "register"]
    got = fed(rows, lambda s: keyed_state.first_registrations(s, "m", "ts", "id"))
    want = {}
    for m, i, t, _ in sorted(rows, key=lambda r: (r[2], r[1])):
        want.setdefault(m, i)
    assert {r["m"]: r["id"] for r in got.filter("m < 999").collect()} == want


def test_isolated_handlers(spark):
    seen, reports = [], []

    def broken(batch, batch_id):
        raise ValueError("no")

    handle = sinks.isolated({"x": broken, "y": lambda b, i: seen.append((i, b.count()))},
                            lambda name, batch_id, error: reports.append((name, batch_id)))
    handle(spark.range(5).toDF("id"), 3)
    assert seen == [(3, 5)] and reports == [("x", 3)]


def test_late_rows_replay(spark, tmp_path):
    def frame(*hours):
        return spark.createDataFrame([(h, dt.datetime(2024, 1, 1, h)) for h in hours],
                                     "h int, ts timestamp_ntz").withColumn(
            "ts", F.col("ts").cast("timestamp"))

    empty = sinks.LateRows(spark, str(tmp_path / "empty"), "ts", 3_600_000_000)
    empty.write_batch(frame(1).limit(0), 0)
    empty.write_batch(frame(9), 1)
    empty.write_batch(frame(1).limit(0), 2)
    empty.write_batch(frame(3, 9), 3)
    assert [r["h"] for r in empty.read(frame(1).schema).collect()] == [3]
    path = str(tmp_path / "late")
    first = sinks.LateRows(spark, path, "ts", 2 * 3_600_000_000)
    first.write_batch(frame(1, 8), 0)
    first.write_batch(frame(5, 7, 9), 1)
    again = sinks.LateRows(spark, path, "ts", 2 * 3_600_000_000)
    again.write_batch(frame(5, 7, 9), 1)
    again.write_batch(frame(6, 7, 8), 2)
    got = again.read(frame(1).schema).collect()
    assert sorted(r["h"] for r in got) == [5, 6, 7]


def test_fan_out_keeps_progress_apart(spark, tmp_path):
    frame = spark.createDataFrame([(i, at(BASE + i)) for i in range(10)], "id int, ts timestamp")
    frame.write.parquet(str(tmp_path / "in" / "0"))

    def start(names):
        stream = run.event_stream(spark, str(tmp_path / "in" / "*"), frame.schema)
        started = sinks.fan_out(stream, {n: str(tmp_path / n) for n in names},
                                str(tmp_path / "state"))
        for query in started.values():
            query.awaitTermination()

    start(["a"])
    frame.write.parquet(str(tmp_path / "in" / "1"))
    start(["a", "b"])
    for name in ("a", "b"):
        assert spark.read.parquet(str(tmp_path / name)).count() == 20


@pytest.fixture
def streamed(spark, tmp_path):
    """Rows as a stream of three files; the watermark stays behind, so rows wait in the state at the end."""
    def start(rows, schema=SCHEMA, delay="30 seconds", column=2):
        rows = sorted(rows, key=lambda r: r[column])
        third = -(-len(rows) // 3)
        for n in range(3):
            spark.createDataFrame(rows[n * third:][:third], schema).coalesce(1).write.parquet(str(tmp_path / "in" / str(n)))
        return run.event_stream(spark, str(tmp_path / "in" / "*"), spark.createDataFrame([], schema).schema,
                                files_per_trigger=1).withWatermark("ts", delay)
    return start


@pytest.mark.parametrize("delay", ["30 seconds", "10 days"])
def test_open_intervals_workers_and_waiting_rows(spark, streamed, delay):
    rows, batch = member_frame(spark, 31)
    rows += [(None, 10_000 + i, at(BASE + i * 900_000), "register" if not i else "heartbeat") for i in range(5)]
    batch = spark.createDataFrame(rows, SCHEMA)
    until, end = liveness.horizon(batch, "ts"), F.col("kind") == "remove"
    stream = streamed(rows, delay=delay)
    got = keyed_state.live_intervals(stream, "m", "ts", "id", "kind", 2_000_000, 700_000, until)
    want = liveness.live_intervals(batch, "m", "ts", "id", "kind", 2_000_000, 700_000, until)
    assert rows_of(got) == rows_of(want) and got.filter("end_reason = 'open'").count() > 0
    got = keyed_state.expire_workers(stream, "m", "ts", "id", "kind", 1_500_000, until)
    want = liveness.expire_workers(batch, "m", "ts", "id", "kind", 1_500_000, until)
    assert rows_of(got) == rows_of(want) and got.filter("expired IS NULL").count() > 0
    got = keyed_state.throttle(stream.withColumn("end", end), "m", "ts", "id", 2_500_000, "end", until)
    want = sequential.throttle(batch.withColumn("end", end), ["m"], "ts", "id", 2_500_000, "end")
    assert rows_of(got.select("m", "id", "ts")) == rows_of(want)
    got = keyed_state.exclusion_windows(stream, "m", "ts", "id", 2, 4_000_000, 3_000_000, until)
    want = sequential.exclusion_windows(batch, "m", "ts", "id", 2, 4_000_000, 3_000_000)
    columns = ["m", "ts", "recent", "tracked", "excluded_until"]
    assert rows_of(got.select(*columns)) == rows_of(want.select(*columns))


def test_open_windows(spark, streamed):
    rows, batch = member_frame(spark, 32)
    stream = streamed(rows, delay="3 seconds")
    got = open_state.run_to_end(windows.sessions(stream, "m", "ts", "2 seconds"),
                                lambda c: open_state.open_sessions(spark, c, "m"))
    want = liveness.liveness_sessions(batch, "m", "ts", "id", 2_000_000)
    assert rows_of(got) == rows_of(want)
    got = open_state.run_to_end(liveness.sliding_failures(stream, ["m"], "ts", "8 seconds", "2 seconds"),
                                lambda c: open_state.open_windows(spark, c, ["m"]))
    assert rows_of(got) == rows_of(liveness.sliding_failures(batch, ["m"], "ts", "8 seconds", "2 seconds"))
    priced = stream.selectExpr("m AS security", "id AS event_id", "ts", "CAST(id % 7 AS DOUBLE) AS price")
    got = open_state.run_to_end(liveness.quote_bars(priced, "5 seconds"), lambda c: open_state.open_bars(spark, c))
    priced = batch.selectExpr("m AS security", "id AS event_id", "ts", "CAST(id % 7 AS DOUBLE) AS price")
    assert rows_of(got) == rows_of(liveness.quote_bars(priced, "5 seconds"))


def test_snapshot_goes_on(spark, tmp_path):
    """The state after each run has every entity, open or ended, over all input so far."""
    rows, _ = member_frame(spark, 33)
    register, remove = F.col("kind") == "register", F.col("kind") == "remove"
    for n in range(2):
        spark.createDataFrame(rows[n::2], SCHEMA).write.parquet(str(tmp_path / "in" / str(n)))
        stream = run.event_stream(spark, str(tmp_path / "in" / "*"), spark.createDataFrame([], SCHEMA).schema)
        seen = lifecycle.final_snapshot(stream, ["m"], "ts", register, remove).drop("is_open")
        got = open_state.snapshot(seen, ["m"], ["started", "ended", "updates"], str(tmp_path / "state"))
        batch = spark.read.parquet(str(tmp_path / "in" / "*"))
        want = lifecycle.final_snapshot(batch, ["m"], "ts", register, remove).drop("is_open")
        assert rows_of(got) == rows_of(want)


def test_nothing_open_without_rows(spark, streamed):
    stream = streamed([], delay="3 seconds")
    assert keyed_state.live_intervals(stream, "m", "ts", "id", "kind", 2_000_000, 700_000, BASE).count() == 0


def failure_rows(spark):
    rows, _ = member_frame(spark, 34)
    rows += [(m, 50_000 + i, at(BASE + (i // 2) * 1_000_000), "failure") for m in (0, None) for i in range(60)]
    return rows, spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("interval", [5_000_000, 7, 0])
def test_failures_in_interval_per_event(spark, streamed, interval):
    """Exact counts: ties, edges, rows that wait; slices that are dropped in between."""
    rows, batch = failure_rows(spark)
    want = rows_of(failure_windows.failures_in_interval(batch, ["m"], "ts", interval))
    got = keyed_state.failures_in_interval(streamed(rows, delay="3 seconds"), "m", "ts", "id", interval,
                                           until_us=liveness.horizon(batch, "ts"))
    assert rows_of(got) == want


def test_failures_in_interval_over_a_restart(spark, fed):
    rows, _ = member_frame(spark, 34)
    # No two rows of one time: what comes at the watermark's time after it is late.
    rows += [(m, 50_000 + i, at(BASE + i * 517_013 + (m or 5)), "failure") for m in (0, None) for i in range(60)]
    batch = spark.createDataFrame(rows, SCHEMA)
    got = fed(rows, lambda s: keyed_state.failures_in_interval(s, "m", "ts", "id", 1_500_000))
    want = failure_windows.failures_in_interval(batch, ["m"], "ts", 1_500_000)
    assert rows_of(got.filter("m IS NULL OR m < 999")) == rows_of(want)


@pytest.mark.parametrize("kind", ["bigint", "string", "date"])
def test_members_share_states(spark, streamed, tmp_path, monkeypatch, kind):
    """Many members are few states, whatever their names; members of other types have one each."""
    monkeypatch.setattr(keyed_state, "SHARED_STATES", 3)
    rows = [(None if m == 7 else m, 100 * i + m, at(BASE + i * 700_000 + m), "register" if i % 5 == 0 else "heartbeat")
            for m in range(20) for i in range(12)]
    names = {"bigint": F.col("m") + 2**60, "string": F.concat(F.lit("ü"), "m"),
             "date": F.date_add(F.lit("2024-01-01").cast("date"), F.col("m").cast("int"))}
    name = names[kind].cast(kind)
    batch = spark.createDataFrame(rows, SCHEMA).withColumn("m", name)
    stream, until = streamed(rows, delay="2 seconds").withColumn("m", name), liveness.horizon(batch, "ts")
    got = keyed_state.live_changes(stream, "m", "ts", "id", "kind", 1_000_000, 300_000, until)
    want = liveness.live_intervals(batch, "m", "ts", "id", "kind", 1_000_000, 300_000, until)
    assert rows_of(keyed_state._intervals(got, "id")) == rows_of(want)
    asked = liveness.reregister_requests(batch, "m", "ts", "id", "kind", 1_000_000, 300_000)
    assert {r["id"] for r in got.filter("change = 'request'").collect()} == {r["id"] for r in asked.collect()}
    checkpoint = str(tmp_path / "checkpoint")
    run.run_to_table(keyed_state.live_changes(stream, "m", "ts", "id", "kind", 1_000_000, 300_000), checkpoint=checkpoint)
    states = open_state.stored(spark, checkpoint, "state").select("key").distinct().count()
    assert states <= 3 if kind in ("bigint", "string") else states > 3
