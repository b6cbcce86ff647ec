"""Quality rules and a hashed n-gram log-likelihood ratio (DataFrame functions only).

Two multinomials over hashed n-grams are compared: that of trusted documents and that of the whole raw
corpus. The n-grams are word endings (the last three characters) and pairs of neighbouring
endings (the last two), which say how words are made and not which words there are. A document's
ratio is the mean of its n-grams' log weights. One threshold decides for every document: it lies a
fixed slack below nearly all trusted documents.

Everything but the counts happens within a document's row, and texts are read once: the rules' counts
and the n-grams are stored, and the weights, the ratios and the threshold come from them. The counts meet in
a table of ``BUCKETS`` rows, which is the whole model. All trusted documents count.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import small_side, written
from .common import pick, settled

BUCKETS = 1 << 14
#: Occurrences added to each bucket on both sides; they draw rare buckets' weights to zero.
PRIOR = 50.0
#: The threshold is this slack (in natural logarithms) below this quantile of the trusted documents.
SLACK = 0.03
QUANTILE = 0.002

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
SPACE = r"[\x20\x09-\x0D]"
NO_SYMBOL = r"[^#*$%&|<>]+"

#: For an exact rank: parts that a range of values is cut into, and most values that the driver sorts.
RANK_PARTS = 1000
RANK_VALUES = 10_000


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def ngrams(words: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of all n-grams of a word array, an array of ints; ``words`` must be a plain column."""
    pair = F.transform(words, lambda w: F.substring(w, -2, 2))
    ends = F.transform(words, lambda w: F.pmod(F.xxhash64(F.substring(w, -3, 3)), F.lit(buckets)).cast("int"))
    pairs = F.zip_with(pair, F.slice(pair, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.when(
        b.isNotNull(), F.pmod(F.xxhash64(a, b, F.lit(2)), F.lit(buckets)).cast("int")))
    return F.concat(ends, F.filter(pairs, lambda x: x.isNotNull()))


def trusted_ids(labels: DataFrame, label_id: str = "doc_id", label_col: str = "quality",
                most: int | None = None) -> DataFrame:
    """Ids of the documents with label 1 (trusted_id); with ``most`` at most so many, those with the smallest
    hashes."""
    ids = labels.filter(labels[label_col] == 1).select(labels[label_id].alias("trusted_id")).distinct()
    ids = ids.filter("trusted_id IS NOT NULL")
    return ids if most is None else ids.orderBy(F.xxhash64("trusted_id"), "trusted_id").limit(most)


def _joined(rows: DataFrame, trusted: DataFrame, how: str) -> DataFrame:
    """Ids are broadcast up to a counted bound; more of them meet their documents in a shuffle."""
    return rows.join(F.broadcast(trusted) if small_side(trusted) else trusted,
                     F.col("doc_id") == F.col("trusted_id"), how)


def _weights(rows: DataFrame, trusted: DataFrame, buckets: int, prior: float) -> list[float]:
    counts = (_joined(rows.select("doc_id", "grams"), trusted, "left")
              .select(F.explode("grams").alias("bucket"), F.col("trusted_id").isNotNull().cast("long").alias("trusted"))
              .groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("trusted"))).collect()
    # At most one row per bucket. The raw counts are scaled to the number of trusted n-grams.
    scale = sum(r["trusted"] for r in counts) / max(1, sum(r["raw"] for r in counts))
    out = [0.0] * buckets
    for r in counts:
        out[r["bucket"]] = math.log((r["trusted"] + prior) / (r["raw"] * scale + prior))
    return out


def fit(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        buckets: int = BUCKETS, prior: float = PRIOR) -> list[float]:
    """The log weight of each bucket: trusted share over raw share, both smoothed.

    The raw counts are of all documents, the trusted ones of all with an id in ``trusted`` (``trusted_ids``).
    Without trusted documents, or without any n-gram, all weights are zero.
    """
    rows = pick(docs, id_col, text_col).select("doc_id", words_of(F.col("text")).alias("words"))
    return _weights(rows.select("doc_id", ngrams(F.col("words"), buckets).alias("grams")), trusted, buckets, prior)


def at_rank(values: DataFrame, name: str, rank: int) -> float:
    """The value with ``rank`` smaller or equal ones before it, exactly, of a column without nulls.

    The range that holds it is cut into parts and counted, round after round, until the driver can sort what is left.
    """
    while True:
        n, low, high = values.agg(F.count(name), F.min(name), F.max(name)).first()
        if low == high:
            return low
        if n <= RANK_VALUES:
            return sorted(r[0] for r in values.select(name).collect())[rank]
        part = F.floor((F.col(name) - F.lit(low)) / F.lit(high - low) * RANK_PARTS)
        for row in values.groupBy(part.alias("part")).count().orderBy("part").collect():
            if rank < row["count"]:
                values = values.filter(part == row["part"])
                break
            rank -= row["count"]


def _threshold(rated: DataFrame, trusted: DataFrame, quantile: float, slack: float) -> float:
    # One id may have many rows; each row counts.
    found = _joined(rated.filter("NOT base_failed AND llr IS NOT NULL"), trusted, "left_semi").select("llr")
    found = written(found)
    place = quantile * (found.count() - 1)
    if place < 0:
        return -math.inf
    low, high = (at_rank(found, "llr", rank) for rank in (math.floor(place), math.ceil(place)))
    return low + (place - math.floor(place)) * (high - low) - slack


def fit_threshold(docs: DataFrame, trusted: DataFrame, weights: list[float], id_col: str = "doc_id",
                  text_col: str = "text", quantile: float = QUANTILE, slack: float = SLACK) -> float:
    """``slack`` below the ratio that all but ``quantile`` of the trusted documents reach; without any
    trusted document, minus infinity. The quantile is exact, so the threshold does not hang on how partial
    results meet."""
    rated = settled(_rated(measured(docs, len(weights), id_col, text_col), weights))
    return _threshold(rated, trusted, quantile, slack)


def repeated_words(rows: DataFrame, words: str = "words", window: int = WINDOW) -> DataFrame:
    """``rows`` with n_repeat_words: words in windows of ``window`` words that are found twice or more.

    Windows are compared by 64-bit hashes within a document. A document without a repeat is done
    after one look at the distinct hashes; for others the hashes are sorted with their
    places, repeated ones are put back in order, and each covers what the last one did not.
    """
    word_hash = F.transform(F.col(words), lambda w: F.xxhash64(w))
    rows = rows.withColumn("_hashes", word_hash)
    count = F.size("_hashes") - (window - 1)
    places = F.when(count > 1, F.sequence(F.lit(1), count))
    rows = rows.withColumn("_windows", F.transform(
        places, lambda i: F.xxhash64(F.slice("_hashes", i, window))))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    rows = rows.withColumn("_sorted", F.when(repeats, F.sort_array(F.transform(
        "_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    before = lambda i: F.get("_sorted", i - 1)["h"]
    after = lambda i: F.get("_sorted", i + 1)["h"]
    same = F.transform("_sorted", lambda x, i: F.when(
        (F.when(i > 0, before(i)) == x["h"]) | (after(i) == x["h"]), x["i"]))
    rows = rows.withColumn("_places", F.sort_array(F.filter(same, lambda i: i.isNotNull())))
    covered = F.aggregate(
        "_places", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-window).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(F.lit(window), i - s["last"])).alias("n"), i.alias("last")),
        lambda s: s["n"])
    return (rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint")))
            .drop("_hashes", "_windows", "_sorted", "_places"))


def measured(docs: DataFrame, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, and the
    buckets of its n-grams (grams)."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = pick(docs, id_col, text_col).select(
        "doc_id", words_of(F.col("text")).alias("words"), lines.alias("lines"),
        F.length(F.regexp_replace("text", NO_SYMBOL, "")).cast("bigint").alias("n_symbols"))
    rows = repeated_words(rows.select(
        "doc_id", "words", "n_symbols", F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        ngrams(F.col("words"), buckets).alias("grams")))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), "grams")


def _rated(rows: DataFrame, weights: list[float]) -> DataFrame:
    """``measured`` rows with llr, the mean weight of their n-grams, in place of these."""
    # The weights are a constant of at most BUCKETS numbers.
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    total = F.aggregate("grams", F.lit(0.0), lambda s, b: s + F.get(table, b))
    return rows.withColumn("llr", F.when(F.size("grams") > 0, total / F.size("grams"))).drop("grams")


def _judged(rated: DataFrame, threshold: float) -> DataFrame:
    return rated.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("llr") >= F.lit(threshold), F.lit(False)))


def quality(docs: DataFrame, weights: list[float], threshold: float, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    llr (null without words), kept.

    ``weights`` and ``threshold`` are those of ``fit`` and ``fit_threshold``. A null text has no words, fails the base rules and is not kept.
    Rows are independent, whatever their ids.
    """
    return settled(_judged(_rated(measured(docs, len(weights), id_col, text_col), weights), threshold))


def fitted_quality(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``quality`` of ``docs`` by the model and threshold that are fitted on them and all ``trusted`` ids; texts
    are read once."""
    rows, trusted = written(measured(docs, BUCKETS, id_col, text_col)), written(trusted)
    rated = written(_rated(rows, _weights(rows, trusted, BUCKETS, PRIOR)))
    return _judged(rated, _threshold(rated, trusted, QUANTILE, SLACK))
