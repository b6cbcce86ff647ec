"""Quality rules against plain loops; the ratio's verdict against labels."""

import math
import re
from collections import Counter

from tidewatch.llm import quality_llr
from tidewatch.llm.queries import QUERIES

from .helpers import FOLDER, no_documents, odd_documents, odd_rows, table

SF = "/root/testdata/sf0.01"
EXTRA = [
    "a b c d e f g h " * 2, "a b c d e f g h i a b c d e f g h", " ".join(map(str, range(40))) + " " + " ".join(map(str, range(9))),
    "x " * 100, "l1\nl1\n \n \nl2 \nl1\n", "|<>#*$%&|", "é ü\x0bö\x0cß\r\n" * 12,
]


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered), failed)


def digest(rows):
    return sorted(((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                               r.base_failed)) for r in rows), key=repr)


def test_query_is_plain_loops(spark):
    got = QUERIES["op10_quality_rules"](spark, SF).collect()
    docs = {d.doc_id: d.text for d in table(spark, "documents", SF).collect()}
    assert digest(got) == sorted(((i, base(t)) for i, t in docs.items()), key=repr)
    assert not any(r.kept and r.base_failed for r in got)
    label = {r.doc_id: r.quality for r in table(spark, "labels", SF).collect()}
    clean = [r.kept for r in got if label.get(r.doc_id) == 1 and not r.base_failed]
    junk = [r.kept for r in got if label.get(r.doc_id) == 0 and not r.base_failed]
    assert sum(clean) / len(clean) > 0.99 and sum(junk) / len(junk) < 0.1


def test_odd_rows(spark):
    got = quality_llr.quality(odd_documents(spark), [0.0] * 16, 0.0).collect()
    assert digest(got) == sorted(((r[0], base(r[1])) for r in odd_rows()), key=repr)
    extra = spark.createDataFrame(list(enumerate(EXTRA)), "doc_id bigint, text string")
    assert digest(quality_llr.quality(extra, [0.0] * 16, 0.0).collect()) == [
        (i, base(t)) for i, t in enumerate(EXTRA)]
    assert quality_llr.quality(no_documents(spark), [0.0] * 16, 0.0).collect() == []


def test_weights_are_the_ratio(spark):
    docs = spark.createDataFrame([(0, "aaa bbb aaa"), (1, "ccc"), (2, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(0, 1), (0, 1), (1, 0), (2, 1), (None, 1)], "doc_id bigint, quality int")
    trusted = quality_llr.trusted_ids(labels)
    weights = quality_llr.fit(docs, trusted, buckets=1 << 20, prior=2.0)
    # aaa, bbb, aaa, aa-bb, bb-aa are trusted; ccc is not: 6 n-grams in all.
    want = Counter([0.0] * ((1 << 20) - 5))
    for raw, good in ((2, 2), (1, 1), (1, 1), (1, 1), (1, 0)):
        want[round(math.log((good + 2) / (raw * 5 / 6 + 2)), 9)] += 1
    assert Counter(round(w, 9) for w in weights) == want
    none = quality_llr.trusted_ids(labels.limit(0))
    assert set(quality_llr.fit(docs, none, buckets=64)) == {0.0}
    assert quality_llr.fit_threshold(docs, none, [0.0] * 64) == -math.inf
    assert set(quality_llr.fit(no_documents(spark), trusted, buckets=64)) == {0.0}
    assert quality_llr.trusted_ids(labels, most=1).count() == 1


def test_all_trusted_documents_count(spark):
    labels = spark.range(20_001).selectExpr("id AS doc_id", "1 AS quality")
    assert quality_llr.trusted_ids(labels).count() == 20_001


def test_exact_rank_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(quality_llr, "RANK_VALUES", 5)
    monkeypatch.setattr(quality_llr, "RANK_PARTS", 3)
    values = [((i * 37) % 101) / 7 for i in range(90)] + [3.0] * 20 + [-1e9, 1e-300]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for rank in (0, 1, 40, 110, 111):
        assert quality_llr.at_rank(df, "v", rank) == sorted(values)[rank]


def test_query_is_fit_and_quality(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    trusted = quality_llr.trusted_ids(labels)
    weights = quality_llr.fit(docs, trusted)
    want = quality_llr.quality(docs, weights, quality_llr.fit_threshold(docs, trusted, weights)).collect()
    assert sorted(quality_llr.fitted_quality(docs, trusted).collect()) == sorted(want)


def test_no_python_on_the_path(spark):
    plan = quality_llr.quality(table(spark, "documents"), [0.0] * 16, 0.0)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
