"""Rules against plain step-by-step loops on seeded random rows, plain and spread."""

import datetime as dt
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import (lifecycle, liveness, matching, ordered, placement, sequential, settings,
                                 tasks, windows)
from tidewatch.operators.quantiles import metric_quantiles

EPOCH = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
BASE = int(EPOCH.timestamp()) * 1_000_000


def at(us):
    return EPOCH + dt.timedelta(microseconds=us - BASE)


def us(stamp):
    stamp = stamp if stamp.tzinfo else stamp.astimezone(dt.timezone.utc)
    return round((stamp - EPOCH).total_seconds() * 1_000_000) + BASE


def stamped(df):
    """Times as whole microseconds, free of the driver's time zone."""
    for field in df.schema.fields:
        if field.dataType.typeName().startswith("timestamp"):
            df = df.withColumn(field.name, F.unix_micros(F.col(field.name).cast("timestamp")))
    return df


@pytest.fixture(params=[None, 20], ids=["plain", "spread"])
def limit(request, spark):
    if request.param:
        spark.conf.set("spark.tidewatch.rowsPerTask", str(request.param))
    yield request.param
    if request.param:
        spark.conf.unset("spark.tidewatch.rowsPerTask")


def random_times(rng, n, gap):
    t, out = BASE, []
    for _ in range(n):
        t += rng.choice([0, 1, gap // 2, gap, gap + 1, 3 * gap]) + rng.randrange(gap)
        out.append(t)
    return out


def test_clamped_sum(spark, limit):
    rng = random.Random(1)
    rows = [(k, i, rng.randrange(-9, 8)) for k in ("a", "b") for i in range(60)]
    want = {}
    for k in ("a", "b"):
        value = 0
        for key, i, delta in rows:
            if key == k:
                value = max(0, value + delta)
                want[k, i] = value
    df = windows.clamped_sum(spark.createDataFrame(rows, "k string, i int, d bigint"), ["k"],
                             ["i"], "d")
    assert {(r["k"], r["i"]): r["usage"] for r in df.collect()} == want


def test_throttle(spark, limit):
    rng = random.Random(2)
    rows, want = [], set()
    for k in (1, 2, 3):
        last = None
        for i, t in enumerate(random_times(rng, 80, 1000)):
            terminal = rng.random() < 0.1
            rows.append((k, k * 1000 + i, at(t), terminal))
            if last is None or terminal or t - last > 1500:
                want.add(k * 1000 + i)
                last = t
    df = sequential.throttle(spark.createDataFrame(rows, "k int, id int, ts timestamp, end boolean"),
                             ["k"], "ts", "id", 1500, "end")
    assert {r["id"] for r in df.collect()} == want


@pytest.mark.parametrize("interval", [4000, -1])
def test_exclusion_windows(spark, limit, interval):
    rng = random.Random(3)
    rows, want = [], {}
    for host in (1, 2):
        queue, until = [], None
        for i, t in enumerate(random_times(rng, 70, 800)):
            row_id = host * 1000 + i
            rows.append((host, row_id, at(t)))
            if until is not None and until > t:
                want[row_id] = (False, 0, None)
                continue
            queue.append(t)
            if interval > 0:
                queue = [q for q in queue if q >= t - interval]
            until = t + 3000 if len(queue) > 2 else None
            want[row_id] = (True, len(queue), until)
    df = sequential.exclusion_windows(
        spark.createDataFrame(rows, "host int, id int, ts timestamp"), "host", "ts", "id", 2,
        interval, 3000)
    got = {r["id"]: (r["tracked"], r["recent"], r["excluded_until"])
           for r in stamped(df).collect()}
    assert got == want


@pytest.mark.parametrize("rule", ["throttle", "endless exclusion", "exclusion"])
def test_regular_ticks_take_a_fixed_number_of_passes(spark, monkeypatch, rule):
    """One key, one row a second, forty chunks: the phase is never forgotten."""
    rows = [(1, i, at(i * 1000), i in (777, 1501)) for i in range(2000)]
    frame = spark.createDataFrame(rows, "k int, id int, ts timestamp, end boolean")

    def run(limit):
        if rule == "throttle":
            return sequential.throttle(frame, ["k"], "ts", "id", 6_500, "end", limit)
        interval = 0 if rule == "endless exclusion" else 11_500
        return sequential.exclusion_windows(frame, "k", "ts", "id", 3, interval, 7_000, limit)

    writes = []
    for module in (sequential, ordered):
        write = module.written
        monkeypatch.setattr(module, "written", lambda df, w=write: writes.append(1) or w(df))
    want = sorted(map(tuple, run(10_000).collect()))
    assert not writes
    assert sorted(map(tuple, run(50).collect())) == want
    assert 0 < len(writes) <= 6


def simulate_members(rows, timeout, check, until):
    """Step-by-step heartbeat receiver for one member: (intervals, unknown heartbeats)."""
    start = last = None
    tick = (rows[0][0] // check) * check
    intervals, unknown = [], []

    def run_ticks(now):
        nonlocal start, last, tick
        while tick + check <= now:
            tick += check
            if start is not None and tick - last > timeout:
                intervals.append((start, tick, "expired", last))
                start = None

    for t, kind, row_id in rows:
        run_ticks(t)
        if kind == "register":
            start, last = (start if start is not None else t), t
        elif kind == "heartbeat":
            if start is None:
                unknown.append(row_id)
            else:
                last = t
        elif start is not None:
            intervals.append((start, t, "removed", last))
            start = None
    run_ticks(until)
    if start is not None:
        intervals.append((start, None, "open", last))
    return intervals, unknown


def member_rows(seed):
    rng = random.Random(seed)
    rows = []
    for m in range(6):
        n = 60 if m == 0 else 15
        for i, t in enumerate(random_times(rng, n, 900)):
            kind = rng.choices(["register", "heartbeat", "remove"], [2, 6, 1])[0]
            rows.append((m, m * 1000 + i, t, kind))
    return rows


@pytest.mark.parametrize("seed", [4, 5])
def test_live_intervals(spark, limit, seed):
    rows = member_rows(seed)
    until = max(r[2] for r in rows)
    df = spark.createDataFrame([(m, i, at(t), k) for m, i, t, k in rows],
                               "m int, id int, ts timestamp, kind string")
    want, unknown = set(), set()
    for m in {r[0] for r in rows}:
        found, strange = simulate_members([(t, k, i) for n, i, t, k in rows if n == m], 2000, 700,
                                          until)
        want |= {(m, *f) for f in found}
        unknown |= set(strange)
    got = stamped(liveness.live_intervals(df, "m", "ts", "id", "kind", 2000, 700))
    assert {tuple(r) for r in got.collect()} == want
    asked = liveness.reregister_requests(df, "m", "ts", "id", "kind", 2000, 700)
    assert {r["id"] for r in asked.collect()} == unknown


def test_late_heartbeat_before_the_tick_saves_the_member(spark):
    df = spark.createDataFrame(
        [(1, 1, at(BASE), "register"), (1, 2, at(BASE + 1099), "heartbeat"),
         (1, 3, at(BASE + 5000), "heartbeat"),
         (2, 4, at(BASE), "register"), (2, 5, at(BASE + 2000), "heartbeat")],
        "m int, id int, ts timestamp, kind string")
    # Timeout 500, ticks every 1100 from the base: the beat at 1099 is late but comes in time.
    got = stamped(liveness.live_intervals(df, "m", "ts", "id", "kind", 500, 1100)).collect()
    ends = {(r["m"], r["end"]) for r in got}
    first_tick = -(-BASE // 1100) * 1100
    assert (2, first_tick + (1100 if first_tick - BASE <= 500 else 0)) in ends


@pytest.mark.parametrize("seed", [6, 7])
def test_expire_workers(spark, limit, seed):
    period = 1500
    rows = [r for r in member_rows(seed) if r[3] != "remove"]
    until = max(r[2] for r in rows)
    want = set()
    for m in {r[0] for r in rows}:
        mine = [(t, k) for n, _i, t, k in rows if n == m]
        state, tick = None, (mine[0][0] // period) * period

        def run_ticks(now):
            nonlocal state, tick
            while tick + period <= now:
                tick += period
                if state and tick - state[1] > period:
                    want.add((m, state[0], tick))
                    state = None

        for t, kind in mine:
            run_ticks(t)
            if kind == "register" and state is None:
                state = [t, 0]
            elif kind == "heartbeat" and state:
                state[1] = t
        run_ticks(until)
        if state:
            want.add((m, state[0], None))
    df = spark.createDataFrame([(m, i, at(t), k) for m, i, t, k in rows],
                               "m int, id int, ts timestamp, kind string")
    got = stamped(liveness.expire_workers(df, "m", "ts", "id", "kind", period))
    assert {tuple(r) for r in got.collect()} == want


def test_quantiles(spark, limit):
    rng = random.Random(8)
    rows = [(g, rng.randrange(-2, 30), rng.randrange(-8, 9))
            for g, n in ((1, 60), (2, 1), (3, 5)) for _ in range(n)] + [(4, -1, 3)]
    qs = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = {(r["g"], r["metric"], r["quantile"]): r["value"] for r in metric_quantiles(
        spark.createDataFrame(rows, "g int, run bigint, other bigint"), ["g"], ["run", "other"],
        qs, "run").collect()}
    want = {}
    for g in (1, 2, 3):
        n = sum(1 for r in rows if r[0] == g and r[1] >= 0)
        if not n:
            continue
        for name, i in (("run", 1), ("other", 2)):
            valid = sorted(r[i] for r in rows if r[0] == g and r[i] >= 0)
            for q in qs:
                index = min(int(q * n), n - 1)
                want[g, name, q] = float(valid[index]) if index < len(valid) else math.nan
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == value or (math.isnan(got[key]) and math.isnan(value)), key


def test_failures_at_the_edge_count(spark, limit):
    times = [0, 10, 10, 20, 21, 31, 45] + list(range(50, 80))
    df = spark.createDataFrame([("h", at(BASE + t)) for t in times], "h string, ts timestamp")
    got = {us: n for us, n in [(r["ts"] - BASE, r["recent_failures"]) for r in stamped(
        windows.failures_in_interval(df, ["h"], "ts", 10)).collect()]}
    assert got == {t: sum(1 for s in times if t - 10 <= s <= t) for t in times}
    forever = windows.failures_in_interval(df, ["h"], "ts", 0)
    assert max(r["recent_failures"] for r in forever.collect()) == len(times)


@pytest.mark.parametrize("requests,free", [(18, 2), (10, 0), (0, 0)])
def test_placement_rounds(spark, requests, free):
    local = spark.createDataFrame([("a", h, n) for h, n in
                                   (("h1", 30), ("h2", 30), ("h3", 20), ("h4", 10))],
                                  "app string, host_id string, tasks bigint")
    apps = spark.createDataFrame([("a", 30, requests)],
                                 "app string, aware_tasks bigint, requests bigint")
    none = spark.createDataFrame([], "app string, host_id string, expected double")
    needed = placement.expected_per_host(local, apps, none.select("app", "host_id"), none, "app",
                                         cpus_per_task=1, cores=2)
    need = {r["host_id"]: r["needed"] for r in needed.collect()}
    assert need == {"h1": 5, "h2": 5, "h3": 4, "h4": 2}
    rows = placement.placement_rounds(needed, apps, "app").collect()
    assert sum(1 for r in rows if r["host_id"] is None) == free
    aware = requests - free
    ratio = {h: math.ceil(n * aware / 5) for h, n in need.items()} if aware else {}
    sizes = {}
    for r in rows:
        if r["host_id"] is not None:
            sizes[r["request"]] = sizes.get(r["request"], 0) + 1
    want = [sum(1 for n in ratio.values() if n > i) for i in range(aware)]
    assert sorted(sizes.values(), reverse=True) == want
    if requests == 18:
        assert sorted(want, reverse=True) == [4] * 7 + [3] * 6 + [2] * 3


def test_tiered_match(spark, limit):
    rng = random.Random(9)
    racks = {h: h % 3 for h in range(8)}
    grants = [(i, rng.choice([0, 0, 0, rng.randrange(8)])) for i in range(40)]
    requests = [(i, rng.choice([None, 0, rng.randrange(8)])) for i in range(35)]
    left_g = [(g, h, racks[h]) for g, h in grants]
    left_r = [(r, h, racks.get(h)) for r, h in requests]
    want = {}
    for tier, place in (("host", 1), ("rack", 2), ("any", None)):
        rest = []
        for g in left_g:
            fit = next((r for r in left_r if place is None
                        or (r[place] is not None and r[place] == g[place])), None)
            if fit is None:
                rest.append(g)
            else:
                left_r.remove(fit)
                want[g[0]] = (fit[0], tier)
        left_g = rest
    want.update({g[0]: (None, "released") for g in left_g})
    g = spark.createDataFrame([(i, h, racks[h]) for i, h in grants], "g int, host int, rack int")
    r = spark.createDataFrame([(i, h, racks.get(h)) for i, h in requests],
                              "r int, host int, rack int")
    got = matching.tiered_match(g, r, [("host", ["host"]), ("rack", ["rack"]), ("any", [])],
                                "g", "r", ["g"], ["r"])
    assert {x["g"]: (x["r"], x["tier"]) for x in got.collect()} == want


@pytest.mark.parametrize("seed", range(4))
def test_tiered_match_with_several_hosts(spark, limit, seed):
    """Requests with up to four hosts, a hot host, ties in nothing but names; against a plain serial match."""
    if limit and seed > 1:
        pytest.skip("two seeds are enough for the rounds")
    rng = random.Random(seed)
    racks = {h: h % 3 for h in range(7)}
    grants = [(i, rng.choice([0, 0, rng.randrange(7)])) for i in range(45)]
    requests = [(i, rng.choice([[], [0], rng.sample(range(9), 2), rng.sample(range(7), 4), [0, rng.randrange(7)]]))
                for i in range(40)]
    want, left_g, left_r = {}, list(grants), [r for r, _ in requests]
    hosts = dict(requests)
    for tier, fits in (("host", lambda g, r: g in hosts[r]),
                       ("rack", lambda g, r: racks[g] in {racks[h] for h in hosts[r] if h in racks}),
                       ("any", lambda g, r: True)):
        rest = []
        for g, h in left_g:
            fit = next((r for r in left_r if fits(h, r)), None)
            if fit is None:
                rest.append((g, h))
            else:
                left_r.remove(fit)
                want[g] = (fit, tier)
        left_g = rest
    want.update({g: (None, "released") for g, _ in left_g})
    g = spark.createDataFrame([(i, h, racks[h]) for i, h in grants], "g int, host int, rack int")
    rows = [(i, h, racks.get(h)) for i, hs in requests for h in (hs or [None])]
    rng.shuffle(rows)
    r = spark.createDataFrame(rows, "r int, host int, rack int")
    got = matching.tiered_match(g, r, [("host", ["host"]), ("rack", ["rack"]), ("any", [])],
                                "g", "r", ["g"], ["r"])
    assert {x["g"]: (x["r"], x["tier"]) for x in got.collect()} == want


def test_matching_without_competition_takes_one_round(spark, monkeypatch):
    """Hosts that share no request settle at once, however many grants one of them has."""
    rows = [(i, i % 2) for i in range(300)] + [(300 + i, h) for i in range(50) for h in (5 + 2 * i, 6 + 2 * i)]
    g = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(400 + i, 5 + 2 * i) for i in range(50)], "g int, h int")
    r = spark.createDataFrame(rows, "r int, h int")
    stored = []
    write = matching.written
    monkeypatch.setattr(matching, "rows_per_task", lambda spark: 0)
    monkeypatch.setattr(matching, "written", lambda df: stored.append(1) or write(df))
    got = matching.several_keys(g, r, ["h"], "g", "r", ["g"], ["r"]).collect()
    assert len(stored) == 5
    assert {(x["g"], x["r"]) for x in got} == {(i, i) for i in range(300)} | {(400 + i, 300 + i) for i in range(50)}


@pytest.mark.parametrize("most, interval, timeout", [(0, 3000, 2000), (1, 900, 5000), (2, 4000, 3000), (3, 5900, 3000),
                                                     (2, 9000, 1500), (4, 700, 400)])
def test_exclusion_windows_of_any_length(spark, limit, most, interval, timeout):
    rng = random.Random(most)
    rows, want = [], {}
    for host in (1, 2, None):
        queue, until = [], None
        for i, t in enumerate(random_times(rng, 90 if host == 1 else 25, 400)):
            row_id = (host or 0) * 1000 + i
            rows.append((host, row_id, at(t)))
            if until is not None and until > t:
                want[row_id] = (False, 0, None)
                continue
            queue = [q for q in [*queue, t] if q >= t - interval]
            until = t + timeout if len(queue) > most else None
            want[row_id] = (True, len(queue), until)
    df = sequential.exclusion_windows(
        spark.createDataFrame(rows, "host int, id int, ts timestamp"), "host", "ts", "id", most, interval, timeout)
    got = {r["id"]: (r["tracked"], r["recent"], r["excluded_until"]) for r in stamped(df).collect()}
    assert got == want


@pytest.mark.parametrize("size,limit_,left", [(5, 5, 5), (6, 5, 5), (30, 20, 20), (21, 20, 19)])
def test_retention_counts(spark, size, limit_, left):
    df = spark.createDataFrame([("p", i, True) for i in range(size)], "p string, i int, done boolean")
    kept = windows.retain(df, ["p"], ["i"], limit_, F.col("done"))
    ids = sorted(r["i"] for r in kept.collect())
    assert ids == list(range(size - left, size))


def test_retention_never_removes_running_rows(spark):
    df = spark.createDataFrame([("p", i, i % 4 == 0) for i in range(40)],
                               "p string, i int, done boolean")
    kept = [r["i"] for r in windows.retain(df, ["p"], ["i"], 5, F.col("done")).collect()]
    assert sorted(kept) == [i for i in range(40) if i % 4]


def test_retain_tasks_removes_finished_first(spark):
    df = spark.createDataFrame([(1, i, i < 6) for i in range(12)], "s int, i int, running boolean")
    kept = windows.retain_tasks(df, ["s"], ["i"], 8, F.col("running"))
    assert sorted(r["i"] for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 10, 11]


def test_register_outcome_order_of_tests(spark):
    rows = spark.createDataFrame(
        [(1, "a", 1, "bad", 4), (2, "a", 2, "ok", 4), (3, "a", 3, "bad", 4), (4, "b", 4, "bad", 2)],
        "id int, m string, t int, host string, cores int")
    bad = spark.createDataFrame([("bad",)], "host string")

    def outcomes(duplicate_first):
        df = windows.register_outcome(rows, "m", ["t"], "id", bad, "host", "cores",
                                      duplicate_first)
        return {r["id"]: (r["outcome"], r["added_cores"]) for r in df.collect()}

    assert outcomes(True) == {1: ("rejected", 0), 2: ("accepted", 4), 3: ("duplicate", 0),
                              4: ("rejected", 0)}
    assert outcomes(False)[3] == ("rejected", 0)


def test_resource_dedup_closed_form(spark):
    rows = [(i, uri, uri.rsplit("/", 1)[1]) for i, uri in enumerate(
        ["/a/x", "/b/x", "/a/x", "/b/x", "/a/y", "/a/y"])]
    df = windows.resource_dedup(spark.createDataFrame(rows, "i int, uri string, name string"), [],
                                "uri", "name", ["i"], "i")
    got = [r["outcome"] for r in df.orderBy("i").collect()]
    assert got == ["accepted", "same name", "same path", "same name", "accepted", "same path"]


def test_outcome_classes(spark):
    reasons = ["Success", "TaskKilled", "TaskCommitDenied", "ExecutorLost", None]
    df = spark.createDataFrame([(r,) for r in reasons], "reason string")
    got = [r[0] for r in df.select(tasks.outcome_class(F.col("reason"))).collect()]
    assert got == ["completed", "killed", "killed", "failed", None]


def test_retention_beyond_the_window_limit(spark, small_tasks):
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        df = spark.createDataFrame([("p", i, True) for i in range(60)],
                                   "p string, i int, done boolean")
        kept = windows.retain(df, ["p"], ["i"], 40, F.col("done"))
        assert sorted(r["i"] for r in kept.collect()) == list(range(20, 60))
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_path_visibility(spark, limit):
    """Random trees with closed folders at all levels, names that sort around the slash, missing entries, files
    that are folders too, a closed root."""
    rng = random.Random(21)
    names = ["a", "b", "a-", "a.", "a0", "aa", "ü", " "]
    for closed in ([], ["/"], None):
        files, rights = [], {}
        for i in range(90):
            parts = [rng.choice(names) for _ in range(rng.randrange(1, 5))]
            files.append((i, "/" + "/".join(parts)))
            for n in range(len(parts) + 1):
                path = "/" + "/".join(parts[:n])
                if closed is None and n and rng.random() < 0.1:
                    continue
                rights.setdefault(path, rng.choice([5, 5, 5, 5, 7, 4, 1, 0]) if n else 5)
        rights.update({p: 4 for p in closed or []})
        files += files[:5]

        def entered(path):
            while path != "/":
                path = path.rsplit("/", 1)[0] or "/"
                if not rights.get(path, 0) & 1:
                    return False
            return True

        want = sorted((i, p, "PUBLIC" if rights.get(p, 0) & 4 and entered(p) else "PRIVATE") for i, p in files)
        got = matching.path_visibility(spark.createDataFrame(files, "i int, path string"), spark.createDataFrame(
            list(rights.items()), "path string, others int"))
        assert sorted(map(tuple, got.collect())) == want
        assert closed or len({v for *_, v in want}) == 2


def test_folders_under_one_root_meet_in_no_join(spark):
    """However many files and folders lie under a folder, it is a row or two of any join."""
    files = spark.range(100_000).selectExpr("id", "concat('/data/', id % 50000, '/', id) AS path")
    rights = files.selectExpr("path").unionByName(spark.range(50_000).selectExpr("concat('/data/', id) AS path")).unionByName(
        spark.createDataFrame([("/",), ("/data",)], "path string")).selectExpr("path", "IF(path = '/data/7', 4, 5) AS others")
    got = matching.path_visibility(files, rights)
    assert {(r["visibility"], r["count"]) for r in got.groupBy("visibility").count().collect()} == {
        ("PUBLIC", 99_998), ("PRIVATE", 2)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    # Both joins are of single paths with their rights; the one of folders comes after they are distinct.
    assert len(joins) == 2 and all("__path" in j for j in joins)
    assert re.search(r"Join.*__name.*\n.*\n?.*Aggregate \[__key", plan)


def test_walks_without_end(spark, monkeypatch):
    """Random graphs with chains, branches, circles and self-references, against a search."""
    for seed in range(6):
        rng = random.Random(seed)
        nodes = 40
        edges = {(rng.randrange(2), a, rng.randrange(a, nodes + 10) + 1) for a in range(nodes) for _ in range(rng.choice([0, 1, 1, 2]))}
        edges |= {(0, i, i + 1) for i in range(20, 35)}
        for _ in range(seed % 3):
            b = rng.randrange(1, nodes)
            edges.add((rng.randrange(2), b, rng.randrange(b)))
        edges |= {(1, 5, 5)} if seed == 5 else set()
        left = set(edges)
        while True:
            kept = {e for e in left if any(f[0] == e[0] and f[1] == e[2] for f in left)}
            if kept == left:
                break
            left = kept
        df = spark.createDataFrame(sorted(edges), "s int, a int, b int")
        assert {tuple(r) for r in settings._endless(df, ["s"], "a", "b").collect()} == {e[:2] for e in left}


def test_layers_store_no_more_than_the_edges(spark, monkeypatch):
    """Twenty layers of fifty nodes, each with an edge to all of the next layer; a long chain; a circle."""
    edges = [(f"{n}.{a}", f"{n + 1}.{b}") for n in range(20) for a in range(50) for b in range(50)]
    edges += [(f"c{i}", f"c{i + 1}") for i in range(300)] + [("x", "y"), ("y", "x"), ("to x", "x")]
    stored = []
    write = settings.written

    def counted(df):
        out = write(df)
        stored.append(out.count())
        return out

    monkeypatch.setattr(settings, "written", counted)
    got = settings._endless(spark.createDataFrame(edges, "a string, b string").coalesce(2), [], "a", "b")
    assert {r["a"] for r in got.collect()} == {"x", "y", "to x"}
    assert max(stored) <= len(edges) and len(stored) <= 24


@pytest.mark.parametrize("seed", range(3))
def test_effective_settings_of_any_shape(spark, limit, seed):
    """Random fallback trees with alternatives, shared fallbacks, circles and undefined fallbacks."""
    if limit and seed:
        pytest.skip("one seed is enough for the split path")
    rng = random.Random(seed)
    n = 60
    defs = []
    for i in range(n):
        fallback = rng.choice([None, f"k{rng.randrange(i)}" if i else None, f"k{i - 1}", f"k{rng.randrange(max(1, i // 3))}"])
        if seed == 2 and i < 3:
            fallback = f"k{(i + 1) % 3}"
        default = f"d{i}" if rng.random() < 0.1 or fallback is None and rng.random() < 0.6 else None
        alternatives = [f"alt{rng.randrange(20)}" for _ in range(rng.choice([0, 0, 1, 2]))] or None
        defs.append((f"k{i}", alternatives, default, fallback))
    by_key = {d[0]: d for d in defs}
    values = {(s, rng.choice([f"k{rng.randrange(n)}", f"alt{rng.randrange(20)}"])): f"v{i}" for i, s in enumerate([1, 2, 3] * 5)}
    values[4, "k0"] = None
    wanted = [(s, f"k{i}") for s in (1, 2, 3, 4) for i in range(n)] + [(1, "k1"), (1, "undefined")]

    def look(scope, key):
        seen, at = [], key
        circular = False
        while at is not None and at in by_key:
            if at in seen:
                circular = True
                break
            seen.append(at)
            at = None if by_key[at][2] is not None else by_key[at][3]
        for at in [key] if circular else seen:
            for name in [at, *(by_key[at][1] or [])]:
                if values.get((scope, name)) is not None:
                    return values[scope, name], name, None
        default = None if circular else by_key[seen[-1]][2]
        return default, "default" if default else None, "circular fallback" if circular else None

    want = {(s, k): look(s, k) for s, k in wanted if k in by_key}
    got = settings.effective_settings(
        spark.createDataFrame(wanted, "scope int, key string"),
        spark.createDataFrame(defs, "key string, alternatives array<string>, default string, fallback string"),
        spark.createDataFrame([(s, k, v) for (s, k), v in values.items()], "scope int, key string, value string"))
    rows = got.collect()
    assert len(rows) == len(want)
    assert {(r["scope"], r["key"]): (r["value"], r["source"], r["error"]) for r in rows} == want


def test_long_fallbacks_store_rows_in_number_of_the_keys(spark, monkeypatch):
    stored = []
    write = settings.written

    def counted(df):
        out = write(df)
        stored.append(out.count())
        return out

    monkeypatch.setattr(settings, "written", counted)
    n = 1000
    defs = spark.createDataFrame([(f"k{i}", None, None, f"k{i + 1}" if i < n else None) for i in range(n + 1)],
                                 "key string, alternatives array<string>, default string, fallback string")
    asked = spark.range(n).selectExpr("1 AS scope", "concat('k', id) AS key")
    got = settings.effective_settings(asked, defs, spark.createDataFrame([(1, f"k{n}", "last")], "scope int, key string, value string"))
    assert got.filter("value = 'last'").count() == n and max(stored) <= n + 2


def test_keys_of_settings_are_not_broadcast(spark, monkeypatch):
    """Tables of keys have small files and many rows: no join sends them through the driver. A table is stored for
    each doubling of the walks, not for each kind of question about them."""
    plans = []
    write = settings.written

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    monkeypatch.setattr(settings, "written", seen)
    # A chain of 200, a circle of 40 with a way into it, and two keys that share the fallback k150.
    links = {f"k{i}": f"k{i + 1}" for i in range(200)} | {f"c{i}": f"c{(i + 1) % 40}" for i in range(40)}
    links |= {"into": "c3", "s0": "k150", "s1": "s0"}
    defs = spark.createDataFrame([(k, None, None, f) for k, f in links.items()] + [("k200", None, "last", None)],
                                 "key string, alternatives array<string>, default string, fallback string")
    asked = [(1, k) for k in (*links, "k200")]
    held = {"k170": "held", "c7": "own"}
    rows = settings.effective_settings(
        spark.createDataFrame(asked, "scope int, key string"), defs,
        spark.createDataFrame([(1, k, v) for k, v in held.items()], "scope int, key string, value string"))
    plans.append(rows._jdf.queryExecution().executedPlan().toString())

    def want(key):
        if key in ("into", *(f"c{i}" for i in range(40))):
            return (held[key], key, None) if key in held else (None, None, "circular fallback")
        at = int(key[1:]) if key[0] == "k" else 150
        return ("held", "k170", None) if at <= 170 else ("last", "default", None)

    assert {r["key"]: (r["value"], r["source"], r["error"]) for r in rows.collect()} == {k: want(k) for _, k in asked}
    assert not [p for p in plans if "Broadcast" in p] and "SortMergeJoin" in "".join(plans)

    plans.clear()
    chain = defs.filter("key LIKE 'k%'")
    got = settings.fallback_paths(chain)
    assert not got.joined and got.places.filter("path = 'k200' AND default = 'last'").count() == 201
    assert len(plans) <= 10


def test_events_of_one_host_are_many_tasks(spark):
    hosts = spark.range(1000).selectExpr("id AS event_id", "1 AS host_id").unionByName(
        spark.createDataFrame([(1, None), (2, 9)], "event_id bigint, host_id int"))
    members = spark.range(20).selectExpr("id AS member_id", "1 AS host_id")
    got = lifecycle.host_to_members(hosts, members)
    assert got.columns == ["host_id", "event_id", "member_id"]
    assert got.count() == got.distinct().count() == 20_000
    assert got.select(F.spark_partition_id()).distinct().count() > 8


def test_substituted_texts_become_one_part(spark):
    """However many parts a referenced value has, texts side by side are one; plain text is not joined."""
    nodes = spark.createDataFrame(
        [(0, ":a", "x${b}y${c}"), (0, ":b", "${d}"), (0, ":c", "1${gone}${d}"), (0, ":d", "end")],
        "scope bigint, name string, value string")
    nodes = nodes.select("scope", "name", settings._parts(F.col("value")).alias("parts"))
    once = settings._substituted(nodes, nodes)
    found = {r["name"]: [tuple(p) for p in r["parts"]] for r in once.collect()}
    assert found == {":a": [("x", None), ("${d}", ":d"), ("y1", None), ("${gone}", ":gone"), ("", None),
                            ("${d}", ":d"), ("", None)],
                     ":b": [("end", None)], ":c": [("1${gone}end", None)], ":d": [("end", None)]}
    joins = once._jdf.queryExecution().optimizedPlan().toString().split("Join LeftOuter")[1]
    assert "isnotnull(part" in joins.split("Union")[0]


def test_quantiles_rank_in_as_many_tasks_as_rows_need(spark):
    """Groups that each fit a task are many tasks' work when all of them do not."""
    rows = spark.range(900).select((F.col("id") % 90).alias("g"), F.col("id").alias("t"), (-F.col("id")).alias("u"))
    want = sorted(map(str, metric_quantiles(rows, ["g"], ["t", "u"], [0.0, 0.5, 1.0], "t").collect()))
    spark.conf.set("spark.tidewatch.rowsPerTask", "60")
    try:
        got = metric_quantiles(rows, ["g"], ["t", "u"], [0.0, 0.5, 1.0], "t")
        assert sorted(map(str, got.collect())) == want and len(want) == 540
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "RepartitionByExpression" in plan and "], 30" in plan
    finally:
        spark.conf.unset("spark.tidewatch.rowsPerTask")
