"""The pipeline, stage by stage, against plain Python."""

import re

from tokenizers import Tokenizer

import corpus_pipeline
from tidewatch.llm.common import tokenizer_path

from .helpers import FOLDER, no_documents, odd_documents, table
from .test_pii import plain
from .test_simhash import expected as near_expected
from .test_tokens import check_packing


def rows_of(df):
    return {(r.doc_id, r.text): r for r in df.collect()}


def plain_exact(rows):
    best: dict = {}
    for i, t in rows:
        best.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append((i is None, i, t))
    return {min(x, key=lambda y: (y[0], y[1] or 0))[1:] for x in best.values()}


def plain_clean(text):
    spans = sorted((s, e, k) for k, v in plain(text).items() for s, e in v)
    out, at = "", 0
    for s, e, k in spans:
        if s >= at:
            out += text[at:s] + f"[{k.upper()}]"
        at = max(at, e)
    return out + text[at:]


def test_stages(spark):
    docs = table(spark, "documents")
    first = corpus_pipeline.language(spark, docs, FOLDER)
    rows = rows_of(first)
    have = {(r.doc_id, r.text) for r in docs.collect()}
    assert set(rows) == {x for x in have if x[1] and any(c.isalpha() for c in x[1])}
    second = corpus_pipeline.exact(spark, first, FOLDER)
    rows = rows_of(second)
    assert set(rows) == plain_exact([(r.doc_id, r.text) for r in first.collect()])
    third = corpus_pipeline.near(spark, second, FOLDER)
    stay = {i for i, _, c in near_expected(list(rows)) if i == c}
    assert {i for i, _ in rows_of(third)} == stay
    fourth = corpus_pipeline.personal(spark, third, FOLDER)
    clean = {r.doc_id: r for r in fourth.collect()}
    assert fourth.columns == docs.columns and fourth.dtypes == docs.dtypes
    for r in third.collect():
        c = clean[r.doc_id]
        assert c.text.replace("[TERM]", "") == plain_clean(r.text) or "[TERM]" in c.text
        assert (c.lang, c.source, c.n_chars) == (r.lang, r.source, len(c.text))
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    last = corpus_pipeline.run(spark, FOLDER).collect()
    check_packing(last, [(i, r.text) for i, r in clean.items()], library, 1024)


def test_odd_rows(spark):
    for docs in (odd_documents(spark), no_documents(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, FOLDER)
            assert out.columns == docs.columns
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    kept = corpus_pipeline.exact(spark, odd_documents(spark), FOLDER).collect()
    assert {(r.doc_id, r.text) for r in kept} == plain_exact(
        [(r.doc_id, r.text) for r in odd_documents(spark).collect()])
    assert len(kept) == len({(r.doc_id, r.text) for r in kept})
