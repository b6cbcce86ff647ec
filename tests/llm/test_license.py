"""Licence scan against a plain search for phrases."""

import re

import pytest

from tidewatch.llm import license_scan
from tidewatch.llm.queries import QUERIES

from .helpers import FOLDER, no_documents, odd_documents, odd_rows, table

TEXTS = [
    "mit license mit license", "MIT-License; the Apache\nLicense, Version 2.0", "cc by cc by-nc 4.0", "cc", "license",
    "gnu gnu general public license version 3 general public license", "ccby", "é mit license", "mité license",
    "All Rights Reserved. Released under the MIT License.", "cc " * 50 + "by", "apache " * 40 + "license license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "mit licensed",
]


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def expected(doc_id, text):
    w = words(text)
    places = []
    for t in license_scan.TEMPLATES:
        k = t.key.split()
        places += [(i, t.label, t.base) for i in range(len(w)) if w[i:i + len(k)] == k]
    base = [p for p in places if p[2]]
    join = lambda x: ",".join(sorted({p[1] for p in x}))
    return (doc_id, len(w), len(base), min((p[0] for p in base), default=None),
            max((p[0] for p in base), default=None), join(base), join(places))


def digest(rows):
    return sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels)
                   for r in rows), key=repr)


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_query_is_plain_search(spark, folder):
    got = QUERIES["op2_license_scan"](spark, folder).collect()
    docs = [(d.doc_id, d.text) for d in table(spark, "documents", folder).collect()]
    assert digest(got) == sorted((expected(*d) for d in docs), key=repr)
    assert any(r.n_base for r in got) and all(0 <= r.score <= 1 for r in got)
    assert all((r.score >= 0.5) == bool(r.labels) for r in got)


def test_fixture(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    got = license_scan.licence_labels(docs).collect()
    assert digest(got) == sorted((expected(i, t) for i, t in enumerate(TEXTS)), key=repr)


def test_odd_rows(spark):
    got = license_scan.licence_labels(odd_documents(spark)).collect()
    assert digest(got) == sorted((expected(r[0], r[1]) for r in odd_rows()), key=repr)
    assert license_scan.licence_labels(no_documents(spark)).collect() == []


def test_full_template_scores_higher(spark):
    docs = spark.createDataFrame([(0, "mit license"), (1, "released under the mit license"), (2, "none")],
                                 "doc_id bigint, text string")
    score = {r.doc_id: r.score for r in license_scan.licence_labels(docs).collect()}
    assert score[2] == 0 and 0.5 < score[0] < score[1] <= 1


def test_no_python_on_the_path(spark):
    plan = license_scan.licence_labels(table(spark, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
