"""Licence scan by a positional index of rare words (DataFrame functions only).

Licence templates are indexed by word: each word's postings name templates and offsets. Document
frequencies of the licence words over the whole corpus make some of them rare; each template is
entered at its rarest key word. A file looks up those of its words (every occurrence), each hit gives
a template's start; the second-rarest key word must stand at its relative place, then the whole
mandatory key phrase is verified. Everything happens within the file's row: no shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, pick, settled

#: Words of lower-cased text: digits, a to z, and every character beyond ASCII.
LICENCE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """``key`` must stand in a text word for word; ``before`` and ``after`` only raise the score."""

    label: str
    key: str
    before: str = ""
    after: str = ""
    base: bool = False

    @property
    def words(self) -> list[str]:
        return f"{self.before} {self.key} {self.after}".split()


# Licence names and the usual words around them. The first four are the base phrases.
TEMPLATES = [
    Template("gpl", "gnu general public license", "licensed under the", "version 3", base=True),
    Template("apache", "apache license", "licensed under the", "version 2 0", base=True),
    Template("cc-by", "cc by", "licensed under", "4 0", base=True),
    Template("mit", "mit license", "released under the", base=True),
    Template("agpl", "gnu affero general public license", "licensed under the", "version 3"),
    Template("all-rights-reserved", "all rights reserved", "copyright"),
    Template("apache-2.0", "apache license version 2 0", "licensed under the"),
    Template("bsd", "redistribution and use in source and binary forms", "",
             "with or without modification are permitted provided that"),
    Template("bsd", "bsd license", "released under the"),
    Template("cc-by-nc", "cc by nc", "licensed under", "4 0"),
    Template("cc-by-nd", "cc by nd", "licensed under", "4 0"),
    Template("cc-by-sa", "cc by sa", "licensed under", "4 0"),
    Template("creative-commons", "creative commons attribution", "licensed under a", "license"),
    Template("gpl-2.0", "gnu general public license version 2", "licensed under the"),
    Template("gpl-3.0", "gnu general public license version 3", "licensed under the"),
    Template("isc", "isc license", "released under the"),
    Template("lgpl", "gnu lesser general public license", "licensed under the", "version 3"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy", "",
             "of this software and associated documentation files the software"),
    Template("mpl", "mozilla public license", "subject to the terms of the", "v 2 0"),
    Template("public-domain", "released into the public domain",
             "this is free and unencumbered software"),
]


def vocabulary(templates: list[Template]) -> list[str]:
    return sorted({w for t in templates for w in t.words})


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(LICENCE_WORD), F.lit(0))


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def word_idf(docs: DataFrame, text_col: str = "text", templates: list[Template] = TEMPLATES
             ) -> dict[str, float]:
    """Inverse document frequency of each licence word over all of ``docs``."""
    words = vocabulary(templates)
    found = words_of(F.coalesce(docs[text_col], F.lit("")))
    # The row for the word "" counts documents.
    counts = (docs.select(F.explode(F.concat(F.array_intersect(found, _strings(words)),
                                             F.array(F.lit("")))).alias("word"))
              .groupBy("word").agg(F.count("*").alias("n")))
    n = {r["word"]: r["n"] for r in counts.collect()}
    return {w: math.log((n.get("", 0) + 1) / (n.get(w, 0) + 1)) for w in words}


def _index(templates: list[Template], idf: dict[str, float]) -> tuple[Column, list[str]]:
    """The index as one constant column, and the words it can be entered at.

    The index is an array of (word, offset, second, second_offset, label, base, key, context): the key
    phrase's rarest word and its place, its second-rarest word, and the template's other words with
    their places relative to the key phrase and their weights.
    """
    entries, anchors = [], []
    for t in templates:
        key = t.key.split()
        order = sorted(range(len(key)), key=lambda i: (-idf[key[i]], i))
        first, second = order[0], order[min(1, len(order) - 1)]
        around = [(w, i - len(t.before.split())) for i, w in enumerate(t.words)]
        # Words of equal frequency in all files weigh nothing; a little keeps sums above zero.
        context = [F.struct(F.lit(w).alias("word"), F.lit(at).alias("at"),
                            F.lit(idf[w] + 1e-6).alias("weight")) for w, at in around]
        anchors.append(key[first])
        entries.append(F.struct(
            F.lit(key[first]).alias("word"), F.lit(first).alias("offset"),
            F.lit(key[second]).alias("second"), F.lit(second).alias("second_offset"),
            F.lit(t.label).alias("label"), F.lit(t.base).alias("base"),
            _strings(key).alias("key"), F.array(*context).alias("context")))
    return F.array(*entries), sorted(set(anchors))


def _word_at(words: Column, at: Column) -> Column:
    """The word at a place counted from 0; null beyond both ends."""
    return F.when(at >= 0, F.get(words, at))


def licence_matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    templates: list[Template] = TEMPLATES,
                    idf: dict[str, float] | None = None) -> DataFrame:
    """doc_id, n_words, matches: an array of (label, base, start, length, score) per row, by start
    (in words, from 0).

    The score is 0.5 for the key phrase, up to 1 with the IDF share of the template's words that stand
    in their places. A null or empty text has no words and no matches. Ids may repeat or be null.
    """
    idf = word_idf(docs, text_col, templates) if idf is None else idf
    index, anchors = _index(templates, idf)
    rows = (pick(docs, id_col, text_col).select("doc_id", words_of(F.col("text")).alias("words"))
            .withColumn("n_words", F.size("words").cast("bigint")))
    words = F.col("words")
    hits = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at"))),
                    lambda h: F.array_contains(_strings(anchors), h["word"]))
    starts = F.flatten(F.transform(hits, lambda h: F.transform(
        F.filter(index, lambda p: p["word"] == h["word"]),
        lambda p: F.struct((h["at"] - p["offset"]).alias("start"), p.alias("posting")))))
    rows = rows.withColumn("candidates", F.when(
        F.arrays_overlap(words, _strings(anchors)), starts))

    def verified(c: Column) -> Column:
        p, start = c["posting"], c["start"]
        in_place = _word_at(words, start + p["second_offset"]) == p["second"]
        return (start >= 0) & in_place & (
            F.slice(words, F.greatest(start, F.lit(0)) + 1, F.size(p["key"])) == p["key"])

    def scored(c: Column) -> Column:
        p, start = c["posting"], c["start"]
        add = lambda match: lambda total, x: total + F.when(match(x), x["weight"]).otherwise(0.0)
        here = F.aggregate(p["context"], F.lit(0.0), add(
            lambda x: F.coalesce(_word_at(words, start + x["at"]) == x["word"], F.lit(False))))
        whole = F.aggregate(p["context"], F.lit(0.0), add(lambda x: F.lit(True)))
        return F.struct(start.cast("bigint").alias("start"), p["label"].alias("label"),
                        p["base"].alias("base"), F.size(p["key"]).alias("length"),
                        F.least(F.lit(1.0), 0.5 + 0.5 * here / whole).alias("score"))

    found = F.sort_array(F.transform(F.filter("candidates", verified), scored))
    none = F.array().cast("array<struct<start:bigint,label:string,base:boolean,length:int,score:double>>")
    return settled(rows.select("doc_id", "n_words", F.coalesce(found, none).alias("matches")))


def licence_labels(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   templates: list[Template] = TEMPLATES) -> DataFrame:
    """One row per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (of
    the best match; 0 without one)."""
    rows = licence_matches(docs, id_col, text_col, templates)
    base = rows.withColumn("base", F.filter("matches", lambda m: m["base"]))
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return base.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min("base.start").alias("first_word"), F.array_max("base.start").alias("last_word"),
        joined(F.col("base.label")).alias("base_labels"),
        joined(F.col("matches.label")).alias("labels"),
        F.coalesce(F.array_max("matches.score"), F.lit(0.0)).alias("score"))
