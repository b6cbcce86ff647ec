"""Token counts, byte-level BPE and packing against the libraries themselves."""

import hashlib
import random
import zlib

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidewatch.llm import byte_bpe, packing, token_counts
from tidewatch.llm.common import tiktoken_ranks, tokenizer_path
from tidewatch.llm.pretokens import Cache, pretokens
from tidewatch.llm.queries import QUERIES

from .helpers import FOLDER, ODD_TEXTS, as_set, no_documents, odd_documents, odd_rows, table

JSON = tokenizer_path("byte_bpe_50k.json")
MULTI = tokenizer_path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def multi():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=tiktoken_ranks(MULTI), special_tokens={})


def strange_texts(n=300):
    random.seed(5)
    ranges = [(0, 0x250), (0x20, 0x7f), (0x250, 0x3000), (0x3000, 0xd7ff), (0x1f000, 0x1faff), (0x11d00, 0x11e00)]
    return ["".join(chr(random.randint(*random.choice(ranges))) if random.random() < .7
                    else random.choice(" \n'st1") for _ in range(random.randint(0, 60)))
            for _ in range(n)]


def test_pretokens_cover_the_text():
    for text in [t for t in ODD_TEXTS if t] + strange_texts():
        assert "".join(pretokens(text)) == text


def test_cache_is_bounded():
    cache = Cache(lambda k: k * 2, 10)
    assert [cache[str(i % 13)] for i in range(100)] == [str(i % 13) * 2 for i in range(100)]
    assert len(cache) <= 5 and len(cache.old) <= 5


def test_codec_is_the_library(multi):
    codec = byte_bpe.Codec(tiktoken_ranks(MULTI), cache_size=100)
    for text in [t for t in ODD_TEXTS if t] + strange_texts():
        ids = codec.encode(text)
        assert ids == multi.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_counts_are_the_library(spark, library):
    want = sorted(((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
                   for i, t, *_ in odd_rows()), key=repr)
    for size in (0, 5, 1000):
        got = token_counts.token_counts(odd_documents(spark), JSON, limit=3, table_size=size).collect()
        assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=repr) == want
        assert all(r.over_limit == (r.n_tokens > 3) for r in got)
    assert token_counts.token_counts(no_documents(spark), JSON).collect() == []


def test_count_query(spark, library):
    got = {r.doc_id: r for r in QUERIES["op4_token_counts"](spark, FOLDER).collect()}
    docs = table(spark, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        n = len(library.encode(d.text, add_special_tokens=False).ids)
        assert (got[d.doc_id].n_tokens, got[d.doc_id].over_limit) == (n, n > 1024)
        assert got[d.doc_id].n_bytes == len(d.text.encode())


def test_frequent_table_is_bounded(spark):
    found = token_counts.frequent_pretokens(table(spark, "documents"), JSON, table_size=50, digest_size=100)
    assert 0 < len(found) <= 50


def test_encode_and_decode(spark, multi):
    ids = byte_bpe.encode(odd_documents(spark), MULTI)
    assert sorted(((r.doc_id, r.ids) for r in ids.collect()), key=repr) == sorted(
        ((i, multi.encode_ordinary(t or "")) for i, t, *_ in odd_rows()), key=repr)
    back = byte_bpe.decode(ids, MULTI)
    assert sorted(((r.doc_id, bytes(r.data)) for r in back.collect()), key=repr) == sorted(
        ((i, (t or "").encode()) for i, t, *_ in odd_rows()), key=repr)
    assert byte_bpe.encode(no_documents(spark), MULTI).collect() == []


def test_round_trip_query(spark, multi):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for d in table(spark, "documents").collect():
        ids = multi.encode_ordinary(d.text)
        want.append((d.doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha(d.text.encode())))
    assert as_set(QUERIES["op9_byte_bpe"](spark, FOLDER)) == sorted(want, key=repr)


def test_first_fit_decreasing_is_plain_first_fit():
    random.seed(3)
    for _ in range(50):
        lengths = [random.randint(1, 50) for _ in range(random.randint(0, 80))]
        bins: list[list[int]] = []
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            for b in bins:
                if sum(lengths[j] for j in b) + lengths[i] <= 50:
                    b.append(i)
                    break
            else:
                bins.append([i])
        assert packing.first_fit_decreasing(lengths, 50) == bins


def test_pack_uses_each_token_once():
    random.seed(4)
    for _ in range(200):
        lengths = [random.choice([1, 7, 16, 64, 65, 130, random.randint(1, 200)])
                   for _ in range(random.randint(1, 60))]
        sequences = packing.pack(lengths, 64, random.choice([1, 4, 16]))
        assert all(0 < sum(p[2] for p in s) <= 64 for s in sequences)
        seen = sorted((d, s + i) for q in sequences for d, s, n in q for i in range(n))
        assert seen == [(d, i) for d, n in enumerate(lengths) for i in range(n)]


def check_packing(pieces, documents, library, length):
    by_doc: dict = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
    want: dict = {}
    for i, t in documents:
        want.setdefault(i, []).append([*library.encode(t or "", add_special_tokens=False).ids, 0])
    assert by_doc.keys() == want.keys()
    for i, texts in want.items():
        if len(texts) == 1:
            ids = []
            for p in sorted(by_doc[i], key=lambda p: p.start):
                assert p.start == len(ids) and p.doc_tokens == len(texts[0])
                ids += memoryview(bytes(p.tokens)).cast("I").tolist()
                assert p.length * 4 == len(p.tokens)
            assert ids == texts[0]
        else:
            assert sum(p.length for p in by_doc[i]) == sum(map(len, texts))
    by_sequence: dict = {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for s in by_sequence.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= length
    return sum(p.length for p in pieces) / (length * len(by_sequence))


def test_packing(spark, library):
    odd = packing.packed_sequences(odd_documents(spark), JSON, length=64, group_docs=8).collect()
    check_packing(odd, [(r[0], r[1]) for r in odd_rows()], library, 64)
    assert packing.packed_sequences(no_documents(spark), JSON).collect() == []
    docs = table(spark, "documents")
    got = packing.packed_sequences(docs, JSON).collect()
    assert check_packing(got, [(d.doc_id, d.text) for d in docs.collect()], library, 1024) > 0.98


def test_packing_query(spark):
    got = QUERIES["op5_packing"](spark, FOLDER).collect()
    pieces = packing.packed_sequences(table(spark, "documents"), JSON).collect()
    assert sorted((p.doc_id, p.start, zlib.crc32(bytes(p.tokens))) for p in pieces) == sorted(
        (g.doc_id, g.start, g.ids_crc32) for g in got)


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 2_000_000, "a" * 2_000_000, ("x" + " " * 150) * 10_000,
                                  "\t \u2003\n" * 500_000, "." * 2_000_000, "7" * 2_000_000, ("y" + "\n" * 5_000) * 300],
                         ids=["blanks", "lines", "letters", "runs", "mixed", "points", "digits", "long runs"])
def test_packing_takes_any_run(library, text):
    encoder = packing.Encoder(JSON)
    assert encoder.agrees
    assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_packing_long_runs_as_a_job(spark, library):
    texts = [" " * 1_500_000, "short", "\n" * 1_500_000 + "x", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    rows = packing.packed_sequences(docs, JSON).collect()
    for i, text in enumerate(texts):
        pieces = sorted((r.start, bytes(r.tokens)) for r in rows if r.doc_id == i)
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        assert b"".join(p for _, p in pieces) == b"".join(x.to_bytes(4, "little") for x in ids)


def test_packing_asks_the_library_where_merges_differ(library):
    """With merges out of the ids' order the faster engine would give other ids."""
    encoder = packing.Encoder(JSON)
    encoder.agrees = False
    encoder.coder = None
    for text in [t for t in ODD_TEXTS if t]:
        assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_rows_with_equal_ids_are_spread(spark):
    """A third of all rows without an id, many with one text: no task gets much more than its share."""
    docs = spark.range(30_000).selectExpr("IF(id % 3 = 0, NULL, id) AS doc_id", "IF(id % 6 = 0, 'same', CAST(id AS STRING)) AS text")
    rows = packing.packed_sequences(docs.repartition(16), JSON, task_bytes=5_000)
    tasks = rows.filter("start = 0").groupBy((rows.sequence_id / (1 << 32)).cast("long")).count()
    sizes = [r["count"] for r in tasks.collect()]
    assert sum(sizes) == 30_000 and len(sizes) == 28 and max(sizes) < 2_000
