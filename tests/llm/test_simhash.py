"""SimHash fingerprints, links and components against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from tidewatch.llm import simhash
from tidewatch.llm.components import components
from tidewatch.llm.queries import QUERIES

from .helpers import FOLDER, no_documents, odd_documents, odd_rows, table


def plain_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\f\r":
        lower = lower.replace(c, " ")
    words = [w for w in lower.split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=3):
    """Union-find over all pairs of values."""
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in parent:
        for b in parent:
            if a < b and (a ^ b).bit_count() <= distance:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {p: root(p) for p in prints}


def expected(rows):
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    roots = plain_components({p for _, p in prints})
    ids: dict = {}
    for i, p in prints:
        ids.setdefault(roots[p], []).append(i)
    smallest = {r: min((i for i in x if i is not None), default=None) for r, x in ids.items()}
    return sorted(((i, f"{p:016x}", smallest[roots[p]]) for i, p in prints), key=repr)


def test_query_is_brute_force(spark):
    got = sorted(map(tuple, QUERIES["op3_simhash_near_dedup"](spark, FOLDER).collect()), key=repr)
    assert got == expected([(d.doc_id, d.text) for d in table(spark, "documents").collect()])


def test_odd_rows(spark):
    got = simhash.near_duplicates(odd_documents(spark)).select(
        "doc_id", simhash.hex_digits(simhash.F.col("fp")), "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == expected([(r[0], r[1]) for r in odd_rows()])
    assert simhash.near_duplicates(no_documents(spark)).collect() == []


def test_long_text_is_whole():
    random.seed(1)
    text = " ".join(random.choice("abcdefgh") * random.randint(1, 3) for _ in range(150_000))
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("blocks, limit", [(4, 20_000), (4, 8), (5, 20_000), (6, 5), (8, 20_000)])
def test_links_lose_no_component(spark, blocks, limit):
    """A dense ball of fingerprints, sparse ones, and pairs at exactly three and four bits."""
    random.seed(blocks * 100 + limit)
    flip = lambda x, n: x ^ sum(1 << b for b in random.sample(range(64), n))
    centre = random.getrandbits(64)
    prints = {flip(centre, random.randint(0, 4)) for _ in range(150)}
    for _ in range(60):
        x = random.getrandbits(64)
        prints |= {x, flip(x, random.randint(1, 5))}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    edges = [(r.a, r.b) for r in simhash.links(frame, blocks=blocks, bucket_limit=limit).collect()]
    mask = (1 << 64) - 1
    assert all(((a ^ b) & mask).bit_count() <= 3 for a, b in edges)
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(root(a & mask), root(b & mask))] = min(root(a & mask), root(b & mask))
    assert {p: root(p) for p in prints} == plain_components(prints)


def test_forest_is_linear():
    prints = np.unique(np.random.default_rng(1).integers(0, 1 << 8, 200).astype(np.uint64))
    edges = sum(len(reached) for _, reached in simhash.forest(prints, 8))
    assert edges == len(prints) - 1


def test_blocks_grow_with_the_input():
    assert [simhash.blocks_for(n) for n in (0, 10_000, 10**7, 10**9, 10**11)] == [4, 4, 5, 6, 7]


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 101), (7, 7)]
    random.seed(2)
    random.shuffle(chain)
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 103: 100}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_one_row_of_a_component_stays(spark):
    """Null ids beside kept rows and alone, and ids that repeat with near and with other texts."""
    base = [" ".join(f"{p}{i}" for i in range(300)) for p in "abcd"]
    near = [t.replace("7 ", "7  ", 1) for t in base]  # other bytes, same words
    rows = [(1, base[0]), (None, near[0]), (None, base[1]), (None, near[1]), (5, base[2]), (5, near[2]),
            (1, near[3]), (0, base[3]), (0, base[3])]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id bigint, text string, row int")
    got = simhash.drop_near_duplicates(docs.repartition(3)).collect()
    assert sorted((r.doc_id, r.text[0]) for r in got if r.doc_id is not None) == [(0, "d"), (1, "a"), (5, "c")]
    assert [r.text[0] for r in got if r.doc_id is None] == ["b"]
    assert {r.text for r in got} == {base[0], min(base[1], near[1], key=digest), min(base[2], near[2], key=digest), base[3]}


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()
