"""Every document query over very long texts beside ordinary ones."""

import hashlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewatch.llm.common import tokenizer_path
from tidewatch.llm.queries import QUERIES

from .helpers import FOLDER

N = 2_000_000
LONG = {
    1_000_000: " " * N, 1_000_001: "\n" * N, 1_000_002: "a" * N, 1_000_003: "1 " * (N // 4), 1_000_004: "é\t" * (N // 4),
    1_000_005: " ".join(f"word{i % 5000} of{i % 17}" for i in range(60_000)),
    1_000_006: "\n".join(f"line {i % 50} mit license a{i % 9}@mail.example.org" for i in range(2_000)),
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("long"))
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = spark.createDataFrame([(i, t, None, None, len(t)) for i, t in LONG.items()], docs.schema)
    docs.unionByName(rows).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{FOLDER}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if int(n[2:].split("_")[0]) <= 10 and n != "op5_packing"))
def test_one_row_for_each(spark, folder, name):
    got = {r["doc_id"]: r for r in QUERIES[name](spark, folder).collect()}
    ids = {r["doc_id"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id").collect()}
    assert set(got) == ids
    if name == "op2_license_scan":
        assert got[1_000_006]["n_words"] == 2_000 * 8 and got[1_000_006]["n_base"] == 2_000
    if name == "op4_token_counts":
        library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
        for i, text in LONG.items():
            assert got[i]["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids)
    if name == "op6_pii":
        assert got[1_000_006]["n_email"] == 2_000 and got[1_000_002]["n_email"] == 0
    if name == "op8_exact_dedup":
        assert got[1_000_000]["group_size"] == 2 and not got[1_000_001]["kept"]
    if name == "op9_byte_bpe":
        assert all(got[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest() for i, t in LONG.items())
    if name == "op10_quality_rules":
        assert got[1_000_003]["n_words"] == N // 4 and got[1_000_003]["n_repeat_words"] == N // 4


def test_packing(spark, folder):
    pieces = QUERIES["op5_packing"](spark, folder).filter("doc_id >= 1000000")
    sums = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
    assert {r["doc_id"] for r in sums.collect() if r["n"] == r["all"]} == set(LONG)
