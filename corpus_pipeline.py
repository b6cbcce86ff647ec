"""From raw documents to packed training sequences, in five stored stages.

language     documents whose language cannot be determined go
exact        one document of each group of equal texts stays
near         one document of each group of near-duplicates stays
personal     personal data and terms that give it away are replaced in the texts
pack         token pieces in sequences of at most 1024 tokens

Each stage is a function of (spark, docs, sf_dir) over all rows that the one before kept; its result
is written as Parquet and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import exact_dedup, language_id, packing, pii, simhash
from tidewatch.llm.common import prepare, tokenizer_path
from tidewatch.session import written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null texts and texts without a letter go; rows with equal or null ids are judged by their own text."""
    prepare(spark)
    return language_id.identified(docs, language_id.fit(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts, repeated rows with them, one stays, that with the smallest id; null texts are
    equal to empty ones, null ids come last."""
    prepare(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each linked group stays, that with the smallest id, null ids last; texts without words, null
    ones with them, are one group."""
    prepare(spark)
    return simhash.drop_near_duplicates(docs)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null texts stay null; rows with equal or null ids are rewritten each by their own text. ``n_chars``, where
    there is such a column, is that of the new text."""
    prepare(spark)
    clean = pii.sanitise(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A null or empty text is its end id alone; rows with equal or null ids are documents of their own."""
    prepare(spark)
    return packing.packed_sequences(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [("language", language), ("exact", exact), ("near", near), ("personal", personal),
          ("pack", pack)]

#: SQL has no fingerprints over shingles, spans or bin packing; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
