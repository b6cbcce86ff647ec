"""Text, format and settings rules at their boundaries."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import formats, text
from tidewatch.operators import settings, sorting, view
from tidewatch.sources import event_log, files


def values(spark, kind, items, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_format_duration(spark):
    got = values(spark, "bigint", [0, 99, 100, 949, 999, 1000, 59_999, 60_000, 599_999, 600_000,
                                   3_600_000, 5_400_000], formats.format_duration)
    assert got == ["0 ms", "99 ms", "0.1 s", "0.9 s", "1.0 s", "1 s", "60 s", "1.0 min",
                   "10.0 min", "10 min", "1.0 h", "1.5 h"]


def test_format_duration_verbose(spark):
    week, year = 7 * 86_400_000, 365 * 86_400_000
    got = values(spark, "bigint", [35, 1000, 5035, 60_000, 3_600_000 + 1000, 86_400_000 * 2, week,
                                   year + week], formats.format_duration_verbose)
    assert got == ["35 ms", "1 second ", "5 seconds 35 ms", "1 minute ", "1 hour  1 second",
                   "2 days  ", "1 week  ", "1 year 1 week 1 day"]


def test_format_number_unit(spark):
    got = values(spark, "double", [1999.0, 2000.0, 1_999_999.0, 2e6, 2e9, 2e12],
                 formats.format_number_unit)
    assert got == ["1999", "2.0 K", "2000.0 K", "2.0 M", "2.0 B", "2.0 T"]


def test_format_bytes(spark):
    got = values(spark, "bigint", [0, 999, 1000, 2000, 1_500_000], formats.format_bytes)
    assert got == ["0.0 B", "999 B", "1 KB", "2 KB", "1.5 MB"]


def test_format_bytes_of_large_sizes(spark):
    # 1000 times 10^12 and more: in the last unit asked for; halves go up although doubles see less.
    sizes = [10**15, 10**15 + 10**14, 9_007_199_254_740_993, 3_049_999_999_999_999, 9_223_372_036_854_775_807]
    got = values(spark, "bigint", sizes, lambda n: formats.format_bytes(n, formats.BYTE_UNITS[:5]))
    assert got == ["1000 TB", "1100 TB", "9007.2 TB", "3050 TB", "9223372 TB"]
    exact = values(spark, "bigint", [1_049_999_999_999_999_999, 9_223_372_036_854_775_807], formats.format_bytes)
    assert exact == ["1 EB", "9.2 EB"]


def test_times(spark):
    assert values(spark, "bigint", [0], formats.format_time) == ["1970/01/01 00:00:00"]
    assert values(spark, "bigint", [-1, 0, 1000], formats.format_listing_time) == [
        "-", "-", "1970-01-01 00:00:01"]


def test_ratios_with_zero_denominators(spark):
    df = spark.createDataFrame([(0, 0)], "a bigint, b bigint")
    a, b = F.col("a"), F.col("b")
    row = df.select(formats.active_ratio(a, b), formats.failed_ratio(a, b), formats.gc_ratio(a, b),
                    formats.gc_heavy(a, b), formats.percent_completed(a, b)).first()
    assert list(row) == [1.0, 1.0, 1.0, False, None]


def test_host_port(spark):
    items = ["h", "h:1", "a:b:2", " h : 3 ", "h:x"]
    assert values(spark, "string", items, text.host_of) == ["h", "h", "a:b", "h", "h"]
    assert values(spark, "string", items, text.port_of) == [0, 1, 2, 3, None]


def test_trim_keeps_line_ends(spark):
    got = values(spark, "string", [" a ", "\t\n a\r \t", " \x01 ", ""], text.trim_keep_crlf)
    assert got == ["a", "\n a\r", "", ""]


def test_split_list(spark):
    assert values(spark, "string", [" a, ,b ,,c", "", ","], text.split_list) == [
        ["a", "b", "c"], [], []]


def test_class_names(spark):
    names = ["a.b.C", "a.b.C$", "C$D", "a.$iw$$iw$C$", "$$"]
    assert values(spark, "string", names, text.simple_class_name) == ["C", "C", "C$D", "C", "$$"]
    assert values(spark, "string", names, text.formatted_class_name) == ["C", "C", "CD", "C", ""]


def test_short_name(spark):
    got = values(spark, "string", ["x" * 35, "x" * 36], text.short_name)
    assert got == ["x" * 35, "x" * 32 + "..."]


def test_strip_xss(spark):
    got = values(spark, "string", ["a'b%27%0d%0Ac\r\nd<&>\"", "%2%277", "%'0A"], text.strip_xss)
    assert got == ["abcd&lt;&amp;&gt;&quot;", "%27", "%0A"]
    assert values(spark, "string", ["é & \u00a0α€ 日", None], text.strip_xss) == [
        "&eacute; &amp; &nbsp;&alpha;&euro; 日", None]


def test_trimming_of_control_characters(spark):
    assert values(spark, "string", ["a,\tb ,\n c\x00,\x1f"], text.split_list) == [["a", "b", "c"]]
    assert values(spark, "string", ["\th:\t12\n", "a:"], text.host_of) == ["h", "a"]
    assert values(spark, "string", ["\th:\t12\n", "a:"], text.port_of) == [12, None]


def test_times_are_whole_numbers(spark):
    from tidewatch.operators.settings import time_ms

    assert values(spark, "string", ["\t5s", "-1500us", "999us", "9007199254740993ms", "9007199254740993",
                                    "9223372036854775807ms", "9223372036854775807d", "5x", None], time_ms) == [
        5000, -1, 0, 9007199254740993, 9007199254740993, (1 << 63) - 1, (1 << 63) - 1, None, None]


def test_url_functions(spark):
    got = values(spark, "string", ["a%2520b", "100%", "a+b"], text.url_decode_fixpoint)
    assert [tuple(r) for r in got] == [("a b", True), ("100%", True), ("a b", True)]
    deep = "%" + "25" * 8 + "41"
    assert tuple(values(spark, "string", [deep], text.url_decode_fixpoint)[0]) == ("A", True)
    assert tuple(values(spark, "string", ["a+%zz"], text.url_decode_fixpoint)[0]) == ("a+%zz", True)
    assert values(spark, "string", ["http://x/?a=1+2&b=%41", "http://x/"],
                  lambda c: text.url_param(c, "a")) == ["1 2", ""]
    assert values(spark, "string", ["<b>x</b>\n<i\n>y"], text.strip_tags) == ["x y"]


def test_same_filesystem(spark):
    df = spark.createDataFrame([("hdfs://nn:1/a", "hdfs://nn:1/b"), ("hdfs://nn/a", "file:///a"),
                                ("file:///a", "file:///b"), ("/a", "/a"),
                                ("hdfs://nn:1/a", "hdfs://nn:2/a")], "l string, r string")
    got = [r[0] for r in df.select(text.same_filesystem(F.col("l"), F.col("r"))).collect()]
    assert got == [True, False, True, False, False]


def test_status_label(spark):
    df = spark.createDataFrame([(True, True, []), (False, True, []), (False, True, [1, 2]),
                                (False, False, [1])], "x boolean, a boolean, s array<int>")
    got = [r[0] for r in df.select(formats.status_label(F.col("x"), F.col("a"), F.col("s")))
           .collect()]
    assert got == ["Blacklisted", "Active", "Active (Blacklisted in Stages: [1, 2])", "Dead"]


def test_typed_text(spark):
    def kind(items):
        df = spark.createDataFrame(list(enumerate(items)), "i int, v string")
        return sorting.guess_text_type(df, "v", ["i"])

    assert kind(["", "£1,234.5", "x"]) == "numeric"
    assert kind(["02/03/20", "13/02/20"]) == "ddmm"
    assert kind(["02/03/20", "02/13/20"]) == "mmdd"
    assert kind(["02/03/20", "b"]) == "ddmm"
    assert kind(["a", "b"]) == "alpha"
    assert values(spark, "string", ["£1,2", "x", "-3%", "1.2.3"],
                  lambda c: sorting.typed_sort_key(c, "numeric")) == [12.0, 0.0, -3.0, 1.2]


def test_app_ids(spark):
    got = values(spark, "string", ["app_1", "application_12_7", "local", "a_b_c_d",
                                   "a_b_12345678901"], sorting.app_sort_key)
    assert got == ["app_1", "application_12_0000000007", "local", "a_b_000000000c",
                   "a_b_12345678901"]


def test_view_arguments(spark):
    df = spark.createDataFrame([(i, i % 3, i // 3) for i in range(12)], "id int, p int, x int")
    with pytest.raises(ValueError):
        view.view(df, "x", ["id"], parent_index="p")
    with pytest.raises(ValueError):
        view.view(df, "x", ["id"], parent=1)
    with pytest.raises(ValueError):
        view.view(df, "x", ["id"], max=0)
    got = view.view(df, "x", ["id"], first=2, last=1, reverse=True).collect()
    assert [r["id"] for r in got] == [8, 7, 6, 5, 4, 3]
    got = view.view(df, "x", ["id"], parent_index="p", parent=1, skip=1, max=2).collect()
    assert [r["id"] for r in got] == [4, 7]
    assert [r["id"] for r in view.tail_n(df, "id", 2).collect()] == [10, 11]
    rows, more = view.batch_next(df, ["id"], (9,), 2)
    assert [r["id"] for r in rows.collect()] == [10, 11] and more is False


def test_deep_page_uses_row_numbers(spark, small_tasks, monkeypatch):
    monkeypatch.setattr(view, "TOP_K_ROWS", 5)
    df = spark.createDataFrame([(i,) for i in range(50)], "id int")
    assert [r["id"] for r in view.page(df, ["id"], 30, 3).collect()] == [30, 31, 32]


def test_filter_status_without_statuses(spark):
    df = spark.createDataFrame([(1, "A"), (2, None)], "id int, status string")
    for none in (None, []):
        assert [r["id"] for r in view.filter_status(df, none, "id").collect()] == [2, 1]


def test_array_keys_sort_by_element_then_length(spark):
    df = spark.createDataFrame([([2],), ([1, 2],), ([1],), ([2**31 - 1],), ([-2**31],)],
                               "k array<int>")
    got = [r["k"] for r in df.orderBy("k").collect()]
    assert got == [[-2**31], [1], [1, 2], [2], [2**31 - 1]]


def test_references(spark):
    rows = [("s", "spark.a", "1"), ("s", "spark.b", "x${spark.a}y${spark.a}"),
            ("s", "spark.c", "${spark.b}-${env:HOME}-${nope:z}-${plain}"), ("s", "plain", "p"),
            ("s", "spark.x", "${spark.y}"), ("s", "spark.y", "${spark.x}"),
            ("s", "spark.z", "see ${spark.x}"), ("s", "spark.me", "${spark.me}"),
            ("t", "spark.q", "${spark.a}"), ("s", "spark.odd", "$1 \\ ${spark.a}")]
    env = spark.createDataFrame([("s", "HOME", "/h/${spark.a}")], "scope string, key string, value string")
    df = settings.resolve_references(
        spark.createDataFrame(rows, "scope string, key string, value string"),
        providers={"env": env})
    got = {(r["scope"], r["key"]): (r["value"], r["error"]) for r in df.collect()}
    assert got["s", "spark.b"] == ("x1y1", None)
    assert got["s", "spark.c"] == ("x1y1-/h/1-${nope:z}-${plain}", None)
    assert got["t", "spark.q"] == ("${spark.a}", None)
    assert got["s", "spark.odd"] == ("$1 \\ 1", None)
    for key in ("spark.x", "spark.y", "spark.z", "spark.me"):
        assert got["s", key][1] is not None, key


def test_typed_values(spark):
    rows = [("int", "5", 5), ("int", "5x", None), ("time", "2min", 120_000), ("time", "10us", 0),
            ("time", "3", 3), ("time", "3w", None), ("bytes", "-2k", -2048), ("bytes", "1g", 1 << 30),
            ("long", str(2**40), 2**40), ("int", str(2**40), None), ("int", "1.5", None)]
    df = spark.createDataFrame([(i, "k", t, v) for i, (t, v, _n) in enumerate(rows)],
                               "i int, key string, type string, value string")
    got = settings.typed_settings(df).orderBy("i").collect()
    assert [r["number"] for r in got] == [n for _t, _v, n in rows]
    assert got[1]["error"] == "k should be int, but was 5x"
    assert got[0]["error"] is None


def test_validate(spark):
    df = spark.createDataFrame([(1, "h"), (2, "h:1"), (3, None)], "id int, host string")
    good, bad = settings.validate(df, {"no port": settings.is_host(F.col("host"))})
    assert [r["id"] for r in good.collect()] == [1]
    assert {r["id"]: r["errors"] for r in bad.collect()} == {2: ["no port"], 3: ["no port"]}


def test_event_log_quarantine(spark, tmp_path):
    path = tmp_path / "log"
    path.write_text('{"Event":"Add","id":"a","time":5}\n{"Event":"Add","id":"b","time":"x"}\n'
                    '{"Event":"Odd"}\nnot json\n{"id":1}\n')
    typed, bad = event_log.read_event_log(spark, str(path), {"Add": "id string, time bigint"})
    assert [tuple(r) for r in typed["Add"].collect()] == [("a", 5)]
    assert sorted(r["reason"] for r in bad.collect()) == [
        "does not fit its type", "no event type", "no event type", "unknown event type"]


def test_event_log_stored_by_type(spark, tmp_path):
    lines = spark.createDataFrame([('{"Event":"A","x":1}',), ('{"Event":"B","x":2}',), ("odd",)],
                                  "value string")
    stored = event_log.store_by_type(lines, str(tmp_path / "log"))
    typed, bad = event_log.parse_events(stored, {"A": "x int", "B": "x int"},
                                        type_col="event_type")
    assert [r["x"] for r in typed["B"].collect()] == [2]
    assert [r["line"] for r in bad.collect()] == ["odd"]
    plan = typed["A"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_type" in plan


def test_properties_file(spark, tmp_path):
    path = tmp_path / "p.properties"
    path.write_text("# note\n\nspark.a = 1 \n  spark.b:x\\n\nspark.c two words\nspark.d\n! more\n")
    got = {r["key"]: r["value"] for r in files.read_properties(spark, str(path)).collect()}
    assert got == {"spark.a": "1", "spark.b": "x\n", "spark.c": "two words", "spark.d": ""}


def test_entities_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 0, 0, 0, 123456), {"a": "b"}, None)],
                               "id int, ts timestamp_ntz, m map<string,string>, n bigint")
    files.write_entities(df, str(tmp_path / "e"))
    assert files.read_entities(spark, str(tmp_path / "e"), df.schema).collect() == df.collect()
    assert list((tmp_path / "e").glob("*.json.gz"))


def test_whole_files(spark, tmp_path):
    (tmp_path / "one.txt").write_text("a\nb\n")
    row = files.read_whole_files(spark, str(tmp_path)).first()
    assert row["content"] == "a\nb\n" and row["path"].endswith("one.txt")


def test_property_files(spark, tmp_path):
    from tidewatch.sources import files

    text = ("# comment \\\nfruits = apple, \\\n   banana\\\n  #pear\n! x\n\nkey\\ one\\:two : v\\\\\\\\\n"
            "plain value here\r\nuni=\\u00e9\\ud83d\\ude42\\n \n  a:\nlone\nlast=x\\")
    (tmp_path / "a.properties").write_bytes(text.encode())
    got = {r.key: r.value for r in files.read_properties(spark, str(tmp_path)).collect()}
    assert got == {"fruits": "apple, banana#pear", "key one:two": "v\\\\", "plain": "value here",
                   "uni": "é🙂\n", "a": "", "lone": "", "last": "x"}


def test_count_up_in_blocks(spark):
    from tidewatch.functions.arrays import count_up

    frame = spark.createDataFrame([(1, 0, 7), (2, -3, -3), (3, 5, 4), (4, 10, 12)], "k int, a int, b int")
    got = sorted(map(tuple, count_up(frame, F.col("a"), F.col("b"), "n", at_once=3).select("k", "n").collect()))
    assert got == [*((1, n) for n in range(8)), (2, -3), *((4, n) for n in (10, 11, 12))]
