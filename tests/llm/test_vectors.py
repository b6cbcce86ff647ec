"""Vector codes and centroid clusters against their SQL and plain Python."""

import hashlib
import math
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T

from tidewatch.llm import centroids, vector_codes
from tidewatch.llm.queries import QUERIES, SQL
from tidewatch.llm.vectors import MOST

from .helpers import FOLDER, as_set

NAN, INF = float("nan"), float("inf")


def schema(kind):
    return T.StructType([
        T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(kind)),
        T.StructField("label", T.IntegerType()),
        *[T.StructField(n, T.StringType()) for n in ("q", "cluster", "distance", "near", "size", "n", "code")]])


def odd_rows(width):
    """Vectors with ties, copies, equal and null ids, null and odd components, other lengths, huge values."""
    rng = np.random.default_rng(5)
    base = [[float(x) for x in np.round(v, 2)] for v in rng.normal(size=(40, width))]
    rows = [(i, v, i % 3 if i % 5 else None) for i, v in enumerate(base)]
    rows += [(100 + i, base[0], 1) for i in range(30)]
    rows += [(7, base[3], 2), (7, base[3], 2), (None, base[4], None), (None, base[4], 0), (-5, base[5], 1)]
    rows += [(200, None, 1), (201, [None] * width, 1), (202, [NAN] + base[0][1:], 1), (203, [INF] + base[0][1:], 1),
             (204, base[0][:-1] + [-INF], 1), (205, base[0][:-1] + [None], 1), (206, [], 1), (207, [0.0] * (width - 1), 1),
             (208, [0.0] * (2 * width), 1), (209, [1e30] * width, 3), (210, [-1e30] * width, 3),
             (211, [-0.0] * width, 1), (212, [-1e-9] * width, 1)]
    return [(*r, *["clash"] * 7) for r in rows]


def kept(rows, scale, fits):
    out = []
    for i, v, label, *_ in rows:
        if v is not None and fits(len(v)) and all(x is not None and math.isfinite(x) for x in v):
            out.append((i, [math.floor(max(-MOST, min(MOST, x * scale))) for x in v], label))
    return out


def nearest(q, book):
    return min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(book))


def lloyd(points, book, rounds):
    for _ in range(rounds):
        own = [nearest(q, book)[1] for q in points]
        book = [[sum(x) // len(x) for x in zip(*of)] if (of := [q for q, o in zip(points, own) if o == n]) else c
                for n, c in enumerate(book)]
    return book, [nearest(q, book) for q in points]


def plain_clusters(rows, width, clusters, rounds):
    rows = kept(rows, 1024, lambda n: n == width)
    digest = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    book = [q for _, q, _ in sorted(rows, key=lambda r: (digest(r[0]), r[1]))[:clusters]]
    book, near = lloyd([q for _, q, _ in rows], book, rounds)
    own = Counter()
    for d, n in near:
        own[n] += d
    return sorted([(i, n, d, own[n], sum(own.values()), hashlib.sha256(",".join(map(str, book[n])).encode()).hexdigest())
                   for (i, _, _), (d, n) in zip(rows, near)], key=repr)


def plain_codes(rows, parts, width, entries, rounds):
    rows = kept(rows, 4096, lambda n: n == parts * width)
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    codes, errors, books = [""] * len(rows), [0] * len(rows), []
    for p in range(parts):
        cut = lambda q: q[p * width:(p + 1) * width]  # noqa: B023, E731
        book, near = lloyd([cut(q) for _, q, _ in rows], [cut(q) for _, q, _ in order], rounds)
        books += book
        codes = [c + f"{n:02x}" for c, (_, n) in zip(codes, near)]
        errors = [e + d for e, (d, _) in zip(errors, near)]
    of_label = Counter()
    for (_, _, label), e in zip(rows, errors):
        of_label[label] += e
    digest = hashlib.sha256(",".join(str(x) for c in books for x in c).encode()).hexdigest()
    return sorted([(i, c, e, of_label[label], digest) for (i, _, label), c, e in zip(rows, codes, errors)], key=repr)


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_centroid_clusters"])
def test_query_is_its_sql(spark, name):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{FOLDER}/embeddings.parquet'")
    got = QUERIES[name](spark, FOLDER)
    want = db.execute(f"SELECT {', '.join(got.columns)} FROM ({SQL[name]}) q").fetchall()
    assert len(want) == 500 and as_set(got) == sorted(want, key=repr)


@pytest.mark.parametrize("kind", [T.FloatType(), T.DoubleType()])
@pytest.mark.parametrize("clusters", [1, 8, 500])
def test_clusters_of_odd_rows(spark, kind, clusters):
    df = spark.createDataFrame(odd_rows(6), schema(kind)).repartition(4)
    rows = [tuple(r) for r in df.collect()]
    got = centroids.members(centroids.cluster(df, clusters=clusters, rounds=4, dimension=6))
    assert as_set(got) == plain_clusters(rows, 6, clusters, 4)


@pytest.mark.parametrize("kind", [T.FloatType(), T.DoubleType()])
@pytest.mark.parametrize("entries, block, leaf", [(16, 2048, 8), (5, 7, 1), (256, 20, 3), (1, 10, 2)])
def test_codes_of_odd_rows(spark, kind, entries, block, leaf):
    df = spark.createDataFrame(odd_rows(8), schema(kind)).repartition(3)
    rows = [tuple(r) for r in df.collect()]
    got = vector_codes.compressed(df, parts=4, entries=entries, rounds=3, block=block, leaf=leaf)
    assert as_set(got) == plain_codes(rows, 4, 2, entries, 3)


def test_no_rows(spark):
    for rows in ([], [(1, None, 1, *["x"] * 7)], [(1, [], 1, *["x"] * 7)]):
        df = spark.createDataFrame(rows, schema(T.FloatType()))
        assert centroids.members(centroids.cluster(df)).collect() == []
        assert vector_codes.compressed(df).collect() == []


def test_codes_take_the_most_common_length(spark):
    rows = [(i, [float(i)] * 8, None, *["x"] * 7) for i in range(3)] + [(9, [1.0] * 16, None, *["x"] * 7), (10, [1.0] * 9, 1, *["x"] * 7)]
    got = vector_codes.compressed(spark.createDataFrame(rows, schema(T.DoubleType())))
    assert sorted(r.vec_id for r in got.collect()) == [0, 1, 2]


def test_trees_prune_and_assign_whole_nodes():
    """Far apart groups: no part needs an integer distance; the answers are those of all distances."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-100_000, 100_000, (16, 8))
    points = np.concatenate([c + rng.integers(-9, 9, (200, 8)) for c in centres]).astype(np.int64)
    tree = vector_codes.part_tree(points)
    found = vector_codes.assign(tree, centres, vector_codes.EntryTree(centres))
    assert len(found[2]) < len(points) / 10
    assert len(found[0]) < 200
    counts, sums = vector_codes.entry_sums(tree, found, 16)
    own = ((points[:, None] - centres[None]) ** 2).sum(2).argmin(1)
    assert counts.tolist() == np.bincount(own, minlength=16).tolist()
    assert all((sums[e] == points[own == e].sum(0)).all() for e in range(16))
    assert (vector_codes.entry_of_rows(tree, found) == own[tree.order]).all()


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 100, 1000])
@pytest.mark.parametrize("spread", [1, 3, 1000])
def test_ties_go_to_the_first_entry(n, spread):
    rng = np.random.default_rng(n)
    points = rng.integers(-spread, spread + 1, (n, 3)).astype(np.int64)
    for entries in (1, 2, 5, 16):
        book = rng.integers(-spread, spread + 1, (entries, 3)).astype(np.int64)
        tree = vector_codes.part_tree(points, leaf=4)
        got = vector_codes.entry_of_rows(tree, vector_codes.assign(tree, book, vector_codes.EntryTree(book)))
        assert (got == ((tree.points[:, None] - book[None]) ** 2).sum(2).argmin(1)).all()


def test_clusters_run_without_python(spark):
    found = centroids.cluster(spark.read.parquet(f"{FOLDER}/embeddings.parquet"), rounds=1)
    plan = centroids.members(found)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
