"""The registered queries of the document operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, language_id, quality_llr, toxicity_crf, vector_codes, warc
from .byte_bpe import round_trip
from .common import prepare, remainder, tokenizer_path
from .exact_dedup import exact_duplicates
from .license_scan import licence_labels
from .packing import packed_sequences
from .pii import personal_data, span_digest
from .simhash import hex_digits, near_duplicates
from .token_counts import token_counts
from .vector_sql import clusters_sql, codes_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run
    return register


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    field = toxicity_crf.fit(docs, toxicity_crf.learning_labels(labels))
    return toxicity_crf.tag(docs, field).select(
        "doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted", "spans")


@query("op2_license_scan")
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_labels(read(spark, sf_dir, "documents"))


@query("op3_simhash_near_dedup")
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packed_sequences(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


@query("op6_pii")
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digest(personal_data(read(spark, sf_dir, "documents")))


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language_id.fit(language_id.learning_rows(docs))
    return language_id.predict(docs, model).select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


@query("op8_exact_dedup", r"""
    WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''),
                   '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
         g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size
               FROM n GROUP BY text_sha256)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
    FROM n JOIN g USING (text_sha256)
""")
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read(spark, sf_dir, "documents"))


@query("op9_byte_bpe")
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read(spark, sf_dir, "documents"),
                      tokenizer_path("byte_bpe_multi_50k.tiktoken"))


@query("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality_llr.fitted_quality(docs, quality_llr.trusted_ids(read(spark, sf_dir, "labels")))


@query("op11_vector_codes", codes_sql())
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(read(spark, sf_dir, "embeddings"))


@query("op12_centroid_clusters", clusters_sql())
def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.members(centroids.cluster(read(spark, sf_dir, "embeddings")))


@query("op13_warc", """
    WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                      sha256(coalesce(html, '')) AS payload_digest FROM pages),
         g AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest)
                         ELSE page_id END AS first_id FROM p)
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
           CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM g
""")
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(read(spark, sf_dir, "pages"))
