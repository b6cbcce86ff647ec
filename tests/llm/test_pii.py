"""Personal data against Python's regular expressions; disclosing terms on a planted corpus."""

import hashlib
import random
import re

import pytest


from tidewatch.llm import pii
from tidewatch.llm.queries import QUERIES

from .helpers import FOLDER, no_documents, odd_documents, odd_rows, table

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    "a@b.c%d@e.f x@y @z.w a@b..c a.@-.-", "a@b.c@d.e", "é🙂 a@b.co é", "a" * 3000, "1" * 3000, "1.2.3.4.5.6.7.8 300.1.2.3.4 0001.02.3.255",
    "1.2.3.999999999999999999999999999999999999999999", "4111 1111 1111 1111 4111-1111-1111-1111", "4111111111111111x4111111111111112",
    "4111  1111 1111 1111 1", "6011000990139424-5 378282246310005", "0000 0000 0000 0000 000", "00000000000000000000",
    "+1 (269) 555-3296 4524132264652876", "+1 (269) 555-3296 and +44.20.7946.0958. +1-2", "++12345678 +123456789012345 +1234567890123456",
    "+1 ( ( ( 2345678", "mail\n1.1.1.1\n+12 34 56 78\t4111111111111111", "1.1.1.1@x.y 5@1.1.1.1",
]


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain(text):
    out = {}
    for kind, pattern in PLAIN.items():
        spans = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 16 <= len(digits) <= 19 and luhn(digits),
                    "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                spans.append((m.start(), m.end()))
        out[kind] = spans
    return out


def expected(doc_id, text):
    found = plain(text)
    spans = ",".join(f"{k}:{s}:{e}" for k in PLAIN for s, e in found[k])
    return (doc_id, *(len(found[k]) for k in PLAIN), hashlib.sha256(spans.encode()).hexdigest(), spans)


def base_of(spans):
    return ",".join(s for s in spans.split(",") if not s.startswith("term:"))


def digest(rows):
    return sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, base_of(r.spans))
                   for r in rows), key=repr)


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_query_is_plain_search(spark, folder):
    got = QUERIES["op6_pii"](spark, folder).collect()
    docs = [(d.doc_id, d.text) for d in table(spark, "documents", folder).collect()]
    assert digest(got) == sorted((expected(*d) for d in docs), key=repr)
    assert not any("term:" in r.spans and not base_of(r.spans) for r in got)


def test_odd_texts(spark):
    random.seed(9)
    texts = TEXTS + ["".join(random.choice("a1.@+-() 4é") for _ in range(60)) for _ in range(400)]
    texts += ["".join(random.choice("12.@a ") for _ in range(40)) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = pii.span_digest(pii.personal_data(docs, support=10**9)).collect()
    assert digest(got) == sorted((expected(i, t) for i, t in enumerate(texts)), key=repr)


def test_odd_rows(spark):
    got = pii.span_digest(pii.personal_data(odd_documents(spark))).collect()
    assert digest(got) == sorted((expected(r[0], r[1]) for r in odd_rows()), key=repr)
    assert pii.personal_data(no_documents(spark)).collect() == []


def planted(spark):
    """'zorblax' stands next to one address in four texts; 'common' stands
    next to addresses but also everywhere else; 'copied' is near one in copies of one text only."""
    rows = [f"number {'abcdefgh'[i]} zorblax common wrote from joe@x.org today" for i in range(4)]

    rows += ["copied words with ann@y.org here"] * 9
    rows += [f"common words of text {i} and nothing else" for i in range(60)]
    return spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")


def test_disclosing_terms(spark):
    found = pii.disclosing_terms(pii.found_spans(planted(spark))).collect()
    assert {r.term for r in found} >= {"zorblax"} and not {r.term for r in found} & {"common", "copied"}
    rows = pii.personal_data(planted(spark)).withColumn("clean", pii.sanitised_text()).collect()
    text = {r.doc_id: r.clean for r in rows}
    assert "zorblax" not in text[0] and "[TERM]" in text[0] and "[EMAIL]" in text[0] and "common" in text[0]
    assert text[4] == "copied words with [EMAIL] here"
    assert text[20] == "common words of text 7 and nothing else"
    spans = {r.doc_id: r.term for r in rows}
    assert [(t.start, t.end, t.match) for t in spans[1] if t.match == "zorblax"] == [(9, 16, "zorblax")]


def test_terms_at_the_ends_of_texts(spark):
    """'zorblax' opens and 'quimbly' closes every text that has it."""
    rows = [f"zorblax wrote from joe@x.org in {w} and {w}" for w in ("spring", "summer", "autumn", "winter")]
    rows += [f"in {w} one wrote to ann@y.org quimbly" for w in ("spring", "summer", "autumn", "winter")]
    rows += [f"one wrote in {w} and spring summer autumn winter from to text {w}{w}" for w in "abcdefghijkl"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    found = {r.term for r in pii.disclosing_terms(pii.found_spans(docs)).collect()}
    assert found >= {"zorblax", "quimbly"} and not found & {"wrote", "spring", "from"}


def test_terms_of_any_form_and_place(spark):
    """Short names, ids with digits, words with marks, and a name far from the address."""
    far = "some words that say nothing of anyone at all " * 5
    rows = [f"from Li and k7 and नमस्ते then {far}{w} joe@x.org {w}" for w in ("red", "blue", "grey", "pink")]
    rows += [f"from and then {far} red blue grey pink x org {w}" for w in "abcdefghijklmnopqrst"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    found = {r.term for r in pii.disclosing_terms(pii.found_spans(docs)).collect()}
    assert found == {"Li", "k7", "नमस्ते"}
    for r in pii.personal_data(docs).withColumn("clean", pii.sanitised_text()).collect():
        if r.doc_id < 4:
            assert r.clean.startswith("from [TERM] and [TERM] and [TERM] then some ") and "[EMAIL]" in r.clean
        else:
            assert r.clean == rows[r.doc_id]


def test_terms_beside_and_inside_entities(spark):
    """A word inside an entity is neither evidence nor lost; an entity's edge ends a word."""
    rows = [f"joe xq1.2.3.4 joe@x.org {w}" for w in ("red", "blue", "grey")] + ["mail joe@x.org", "mail to joe@y.org"]
    rows += [f"red blue grey to x org mail {w}" for w in "abcdefghijkl"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    found = {}
    for r in pii.disclosing_terms(pii.found_spans(docs)).collect():
        found.setdefault(r.term, []).append(r.text_key)
    assert {t: len(k) for t, k in found.items()} == {"joe": 5, "xq": 3}
    spans = {r.doc_id: [(t.start, t.end, t.match) for t in r.term] for r in pii.personal_data(docs).collect()}
    assert spans[0] == [(0, 3, "joe"), (4, 6, "xq"), (14, 17, "joe")] and spans[4] == [(8, 11, "joe")]


def test_sanitised_text(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    found = pii.personal_data(docs, support=10**9)
    for remove in (False, True):
        got = {r.doc_id: r.clean for r in found.withColumn("clean", pii.sanitised_text(remove)).collect()}
        for i, text in enumerate(TEXTS):
            out, at = "", 0
            spans = sorted((s, e, k) for k, v in plain(text).items() for s, e in v)
            for s, e, k in spans:
                if s >= at:
                    out += text[at:s] + ("" if remove else f"[{k.upper()}]")
                at = max(at, e)
            assert got[i] == out + text[at:]


def test_no_python_on_the_path(spark):
    plan = pii.span_digest(pii.personal_data(planted(spark)))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

