"""Exact duplicates: the query against its SQL, collisions, directory doubling, odd rows."""

import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import exact_dedup
from tidewatch.llm.queries import QUERIES, SQL

from .helpers import FOLDER, no_documents, odd_documents, odd_rows, table


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    groups: dict = {}
    for i, t in rows:
        groups.setdefault(normalised(t), []).append(i)
    out, stayed = [], set()
    for i, t in sorted(rows, key=repr):
        ids = groups[normalised(t)]
        keep = min((x for x in ids if x is not None), default=None)
        kept = i == keep and normalised(t) not in stayed
        if kept:
            stayed.add(normalised(t))
        out.append((i, keep, len(ids), kept, hashlib.sha256(normalised(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_query_is_its_sql(spark, folder):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = db.execute("SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM "
                      f"({SQL['op8_exact_dedup']}) q").fetchall()
    got = QUERIES["op8_exact_dedup"](spark, folder)
    assert result(got) == sorted(want, key=repr)
    assert result(got) == expected([(r.doc_id, r.text) for r in table(spark, "documents", folder).collect()])


@pytest.mark.parametrize("key_bits, capacity", [(64, 20_000), (64, 3), (4, 3), (1, 1), (0, 2)])
def test_odd_rows_with_colliding_keys(spark, key_bits, capacity):
    got = exact_dedup.exact_duplicates(odd_documents(spark), key_bits=key_bits, capacity=capacity)
    assert result(got) == expected([(r[0], r[1]) for r in odd_rows()])


def test_no_rows(spark):
    assert exact_dedup.exact_duplicates(no_documents(spark)).collect() == []
    assert exact_dedup.drop_exact_duplicates(no_documents(spark)).collect() == []


def test_chains_hold_each_text_once(spark):
    index = exact_dedup.build_index(table(spark, "documents"), key_bits=3, capacity=10).collect()
    texts = {normalised(r.text) for r in table(spark, "documents").collect()}
    assert {r.text_sha256 for r in index} == {hashlib.sha256(t.encode()).hexdigest() for t in texts}
    places: dict = {}
    for r in index:
        places.setdefault((r.bucket, r.key), []).append(r.chain)
    assert len({k for _, k in places}) <= 8
    assert all(sorted(p) == list(range(1, len(p) + 1)) for p in places.values())


def test_directory_doubles_where_it_is_full(spark):
    """Keys crowd at zero: that corner is split often, the rest is not."""
    keys = [(i << 40,) for i in range(200)] + [(i << 58,) for i in range(1, 31)] + [(-(i << 58),) for i in range(1, 31)]
    entries = spark.createDataFrame(keys, "key bigint")
    slots, depth, buckets = exact_dedup.directory(entries, capacity=20)
    rows = slots.collect()
    # A slot is in one bucket, and a bucket's slots lie together, as many as its local depth leaves.
    assert len({r.slot for r in rows}) == len(rows)
    by_bucket: dict = {}
    for r in rows:
        by_bucket.setdefault(r.bucket, []).append(r)
    assert len(by_bucket) == buckets
    for bucket, own in by_bucket.items():
        assert sorted(r.slot for r in own) == list(range(bucket, bucket + (1 << depth - own[0].local_depth)))
    sizes: dict = {}
    for (key,) in keys:
        slot = (key % (1 << 64)) >> (64 - depth) if depth else 0
        bucket = next(r.bucket for r in rows if r.slot == slot)
        sizes[bucket] = sizes.get(bucket, 0) + 1
    local = {r.bucket: r.local_depth for r in rows}
    assert all(n <= 20 or local[b] == depth for b, n in sizes.items())
    assert len(set(local.values())) > 1


def test_dropping_keeps_columns_and_one_row_of_each(spark):
    docs = odd_documents(spark)
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    want = [(i, s) for i, _, _, k, s in expected([(r[0], r[1]) for r in odd_rows()]) if k]
    got = [(r.doc_id, hashlib.sha256(normalised(r.text).encode()).hexdigest()) for r in kept.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_many_copies_of_one_row(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "COPIES_AT_ONCE", 7)
    docs = spark.range(100).select(F.lit(5).cast("bigint").alias("doc_id"), F.lit("same text").alias("text"))
    rows = exact_dedup.exact_duplicates(docs).collect()
    assert len(rows) == 100 and sum(r.kept for r in rows) == 1 and {r.group_size for r in rows} == {100}


def test_no_python_on_the_path(spark):
    plan = exact_dedup.exact_duplicates(table(spark, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
