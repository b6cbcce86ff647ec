"""Rows that document operators must survive, and shared checks."""

from __future__ import annotations

import zlib

from pyspark.sql import types as T

FOLDER = "/root/testdata/sf0.001"

#: Texts with everything that went wrong somewhere: null, empty, blanks, ties, copies, other scripts,
#: characters newer than some libraries' Unicode, special strings, surrogate-pair characters.
ODD_TEXTS = [
    None, "", " ", "\n\t \x0b\f\r", "a", "a", "A", "a b", "a  b", "a\tb", "ab", "é", "é",
    "don't we'll it's I'D", "  two  blanks   three\n\n\nlines   nbsp  em\x85next\x1cfs",
    "12 345 6789 ²³ ½ ٣٤ Ⅷ", "日本語の文章です。 中文 한국어", "🙂🙂 👩‍👩‍👧 \U0001f9ff", "՘x ࢏ \U00011de0 \U00011de1y",
    "<|endoftext|>", "a<|endoftext|>b  <|endoftext|> c", "x" * 5000, "word " * 3000, "ab\n" * 40,
    "\x00\x01\x7f", "a_b_c __init__", "mit license", "The MIT License and CC BY 4.0",
    "mail a.b+c@x-y.example.org now", "one two three four five six seven eight nine ten",
    "one two three four five six seven eight nine ten",
]

#: Names that operators use inside.
INNER_NAMES = ("key", "group", "n", "word", "score", "ids", "kept", "_", "_key", "_row_id", "text_key", "fp", "row", "carried",
               "words", "terms", "outside", "bucket", "trusted_id", "lang_pred", "spans")

ODD_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    *[T.StructField(n, T.StringType()) for n in INNER_NAMES]])


def odd_rows() -> list[tuple]:
    rows = [(i, t, "en" if i % 2 else None, None, None) for i, t in enumerate(ODD_TEXTS)]
    rows += [(3, ODD_TEXTS[3], None, None, None), (3, ODD_TEXTS[3], None, None, None),
             (None, "no id", "en", "s", 5), (None, None, None, None, None), (7, "other text", "en", "s", 1)]
    return [(*r, *["clash"] * len(INNER_NAMES)) for r in rows]


def odd_documents(spark):
    return spark.createDataFrame(odd_rows(), ODD_SCHEMA).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


def table(spark, name, folder=FOLDER):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_set(df):
    return sorted(map(tuple, df.collect()), key=repr)


def remainder(doc_id, divisor):
    return zlib.crc32(str(doc_id if doc_id is not None else "").encode()) % divisor
