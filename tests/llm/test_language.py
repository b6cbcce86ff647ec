"""Language identification: held-out accuracy, filters, odd rows."""

import tracemalloc

import numpy as np

from tidewatch.llm import language_id
from tidewatch.llm.queries import QUERIES

from .helpers import no_documents, odd_documents, odd_rows, remainder, table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in table(spark, "documents", SF).select("doc_id", "lang").collect()}
    got = QUERIES["op7_language_id"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(truth)
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    held = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out]
    assert len(held) > 100 and sum(held) / len(held) > 0.99


def test_counts_are_those_of_a_loop(spark):
    docs = odd_documents(spark).select("lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL")
    want: dict = {}
    for _, text, lang, *_ in odd_rows():
        if lang is None or text is None:
            continue
        chars = [(c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in f" {text} "]
        chars[0] = chars[-1] = " "
        for a, b, c in zip(chars, chars[1:], chars[2:]):
            if b != " ":
                key = (lang, ord(a) << 42 | ord(b) << 21 | ord(c))
                want[key] = want.get(key, 0) + 1
    got = {(r.lang, r.gram): r.n for r in language_id.gram_counts(docs).collect()}
    assert got == want


def test_portions_are_whole(monkeypatch):
    texts = ["abc déf", None, "", "x" * 50, "one two"]
    whole = [np.concatenate(x) for x in zip(*language_id.trigrams(texts))]
    monkeypatch.setattr(language_id, "AT_ONCE", 4)
    parts = [np.concatenate(x) for x in zip(*language_id.trigrams(texts))]
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_a_worker_holds_little():
    """Arrays that live at a time, for a text of 4 million letters; the tables of letters are made first."""
    model = language_id.Model(["a", "b"], "a", [np.zeros(1 << 20, np.uint8)])
    model.predict(["a"])
    tracemalloc.start()
    model.predict(["ab" * 1_000_000] * 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20


def test_odd_rows(spark):
    model = language_id.fit(table(spark, "documents"))
    got = language_id.predict(odd_documents(spark), model).collect()
    texts = [(r[0], r[1]) for r in odd_rows()]
    assert len(got) == len(texts)
    without = {i for i, t in texts if t is None or not any(c.isalpha() for c in t)}
    assert {r.doc_id for r in got if r.lang_pred == "und"} == without
    assert language_id.predict(no_documents(spark), model).collect() == []


def test_nothing_learned(spark):
    model = language_id.fit(no_documents(spark))
    assert model.languages == []
    assert {r.lang_pred for r in language_id.predict(odd_documents(spark), model).collect()} == {"und"}


def test_many_languages(spark):
    """More languages than one mask has bits, and a filter so small that false positives matter."""
    names = [f"l{i:03}" for i in range(70)]
    word = {n: chr(0x4e00 + 3 * i) + chr(0x4e01 + 3 * i) + chr(0x4e02 + 3 * i) for i, n in enumerate(names)}
    docs = spark.createDataFrame([(i, " ".join([word[n]] * 5), n) for i, n in enumerate(names)],
                                 "doc_id bigint, text string, lang string")
    model = language_id.fit(docs, slot_bits=12)
    assert len(model.words) == 2
    got = {r.doc_id: r.lang_pred for r in language_id.predict(docs, model).collect()}
    assert got == dict(enumerate(names))


def test_rare_trigrams_and_scripts_stay(spark):
    """A language with more than 50,000 trigrams, a short text of its rarest ones, and an unlabelled text
    in a script that no label covers."""
    chars = np.random.default_rng(5).integers(0x4e00, 0x9000, 70_000)
    common, rare, other = "".join(map(chr, chars)), "\u9a6c\u9a7c\u9a8c", "\u0e01\u0e02\u0e03"
    rows = [(0, common, "zh"), (1, common, "zh"), (2, rare, "zh"), (3, other, None), (4, "12", None), (5, None, "zh")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.fit(docs)
    assert {r.doc_id for r in language_id.identified(docs, model).collect()} == {0, 1, 2, 3}
    score = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(docs, model).collect()}
    assert score[2] == ("zh", 1.0) and score[3][0] == "zh" and score[4] == score[5] == ("und", 0.0)
    assert model.false_rate.max() < 0.01


def test_tables_are_those_of_a_loop(spark):
    """Slots put together on executors, over more languages than a mask has bits and more trigrams than slots."""
    rows = [(lang, gram) for lang in range(70) for gram in range(lang * 100, lang * 100 + 1500)]
    chosen = spark.createDataFrame(rows, "code int, gram bigint").repartition(5)
    languages = [f"l{i}" for i in range(70)]
    for bits in (4, 10, 15):
        want = [np.zeros(1 << bits, np.uint64) for _ in range(2)]
        for code, gram in rows:
            for slot in language_id.slots_of(np.array([gram]), bits, 3):
                want[code // 64][int(slot[0])] |= np.uint64(1 << (code % 64))
        got = language_id.slot_table(chosen, languages, bits, 3)
        assert all((a == b).all() for a, b in zip(want, got)) and len(got) == 2


def test_tables_are_bounded(spark):
    assert language_id.slot_bits_for(1, 4) == 20
    assert language_id.slot_bits_for(10 ** 9, 4) == 26
    assert language_id.slot_bits_for(10 ** 9, 64) == 23
    assert language_id.slot_bits_for(10 ** 9, 2000) == 18
    assert language_id.slot_bits_for(10 ** 9, 10 ** 9) == 1
    docs = table(spark, "documents").filter("lang IS NOT NULL")
    small = language_id.fit(docs, table_bytes=1 << 16)
    assert small.slot_bits == 16 and small.false_rate.max() > language_id.fit(docs).false_rate.max()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    right = [r.lang_pred == truth[r.doc_id] for r in language_id.predict(docs, small).collect()]
    assert sum(right) > 0.95 * len(right)


def test_every_language_stays(spark):
    """More languages than one table of the cap that once was."""
    rows = [(i, chr(0x4e00 + i) * 30, f"l{i:04}") for i in range(1100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.fit(docs)
    assert len(model.languages) == 1100 and sum(w.nbytes for w in model.words) <= language_id.TABLE_BYTES
    got = {r.doc_id: r.lang_pred for r in language_id.predict(docs, model).collect()}
    assert all(got[i] == lang for i, _, lang in rows)
