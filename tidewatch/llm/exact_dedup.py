"""Exact duplicates by an extendible-hash index on shared files (DataFrame functions only).

1. Texts are normalised and grouped by (64-bit key, text). The grouping compares the bytes, so
   texts that only share a key stay apart; copies collapse in the map tasks, before the shuffle,
   so a group with a third of all rows sends one row per task.
2. The directory: counts per fine key prefix give, for every prefix length, the size of the
   bucket with that prefix. A bucket over capacity is split by one more bit until its parts
   fit; the directory has one slot per fine prefix and several slots may name one bucket.
3. Index entries are routed through the slots to their bucket. The task that owns a bucket (a
   key range) chains entries with the same key and writes them to the shared folder.
4. Every row looks its chain entry up by key and text digest.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .common import free_names, pick

#: Runs that are not already one blank.
LOOSE_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"

#: Entries a bucket holds before it splits, and the number of buckets from which they grow instead.
BUCKET_ENTRIES = 20_000
MOST_BUCKETS = 20_000

#: Rows made from one counted row at a time.
COPIES_AT_ONCE = 1_000_000


def normalised(text: Column) -> Column:
    """Every run of ASCII white space becomes one blank."""
    return F.regexp_replace(text, LOOSE_SPACE, " ")


def key_of(text: Column, key_bits: int) -> Column:
    """The top ``key_bits`` bits of the text's hash; the other bits are zero."""
    key = F.xxhash64(text)
    return key if key_bits == 64 else F.shiftleft(F.shiftright(key, 64 - key_bits), 64 - key_bits)


def prefix(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("bigint")


def directory(entries: DataFrame, capacity: int = BUCKET_ENTRIES,
              most_buckets: int = MOST_BUCKETS) -> tuple[DataFrame, int, int]:
    """Slots (slot, bucket, local_depth) of an extendible-hash directory over ``entries.key``,
    its global depth and the number of its buckets.

    ``bucket`` is the smallest slot that points to the bucket. A bucket with more than ``capacity``
    entries has the global depth already: its keys agree on all of the directory's bits. Over
    ``most_buckets`` buckets the capacity grows with the input. Empty input: one empty bucket.
    """
    total = entries.count()
    capacity = max(capacity, math.ceil(total / most_buckets))
    depth = min(40, max(0, math.ceil(math.log2(max(1, total / capacity))) + 2)) if total > capacity else 0
    slots = entries.groupBy(prefix(F.col("key"), depth).alias("slot")).agg(F.count("*").alias("n"))
    sizes = (slots.select("n", "slot", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("d"))
             .groupBy("d", F.expr(f"shiftright(slot, {depth} - d)").alias("part"))
             .agg(F.sum("n").alias("n")))
    fits = (F.col("n") <= capacity) | (F.col("d") == depth)
    # A bucket is a part that fits and whose parent did not.
    parent = sizes.filter(F.col("n") > capacity).select(
        (F.col("d") + 1).alias("d"), F.col("part").alias("parent"), F.lit(True).alias("split"))
    leaves = (sizes.filter(fits).withColumn("parent", F.expr("shiftright(part, 1)"))
              .join(parent, ["d", "parent"], "left")
              .filter(F.col("split") | (F.col("d") == 0)))
    low = F.expr(f"shiftleft(part, {depth} - d)")
    out = leaves.select(
        F.explode(F.sequence(low, low + F.expr(f"shiftleft(1L, {depth} - d)") - 1)).alias("slot"),
        low.alias("bucket"), F.col("d").alias("local_depth"))
    out = written(out)
    return out, depth, out.select("bucket").distinct().count()


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_bits: int = 64,
                capacity: int = BUCKET_ENTRIES) -> DataFrame:
    """The stored index: bucket, local_depth, key, chain (place in the key's chain), text_sha256,
    keep_id (smallest id), group_size; one row per distinct normalised text."""
    rows = pick(docs, id_col, text_col).select("doc_id", normalised(F.col("text")).alias("text"))
    groups = (rows.groupBy(key_of(F.col("text"), key_bits).alias("key"), "text")
              .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    entries = written(groups.select("key", F.sha2("text", 256).alias("text_sha256"), "keep_id",
                                    "group_size"))
    slots, depth, buckets = directory(entries, capacity)
    routed = (entries.withColumn("slot", prefix(F.col("key"), depth)).join(slots, "slot")
              .drop("slot").repartition(max(1, buckets), "bucket"))
    chain = Window.partitionBy("bucket", "key").orderBy("text_sha256", "keep_id")
    return written(routed.withColumn("chain", F.row_number().over(chain)).withColumn(
        "twin", F.lag("text_sha256").over(chain) == F.col("text_sha256")))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     key_bits: int = 64, capacity: int = BUCKET_ENTRIES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised bytes are. A null text counts as empty. Of equal texts
    the smallest id stays; a null id is larger than any other. Rows that repeat both id and text
    count as rows, and one of them is kept. Rows of an id with different texts are different
    documents. Two different texts with one SHA-256 would end the job with an error.
    """
    index = build_index(docs, id_col, text_col, key_bits, capacity)
    text = normalised(F.col("text"))
    rows = (pick(docs, id_col, text_col)
            .select("doc_id", key_of(text, key_bits).alias("key"),
                    F.sha2(text, 256).alias("text_sha256"))
            .groupBy("key", "text_sha256", "doc_id").agg(F.count("*").alias("copies")))
    found = rows.join(index, ["key", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", "text_sha256", "copies",
        F.when(F.col("twin"), F.raise_error(F.lit("two texts have one SHA-256"))).alias("twin"))
    batch = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(copies - 1) div {COPIES_AT_ONCE}")))
    first = F.col("batch") * COPIES_AT_ONCE
    return (found.withColumn("batch", batch)
            .withColumn("copy", F.explode(F.sequence(
                first, F.least(first + COPIES_AT_ONCE, F.col("copies")) - 1)))
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)
                     & F.col("twin").isNull()).alias("kept"), "text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_duplicates`` drops; all columns stay as they are."""
    names = free_names(docs, "_row_none", "_row_id", "_row_sha")
    others = free_names(docs, "_kept_none", "_kept_id", "_kept_sha")

    def keys(id_: Column, sha: Column) -> list[Column]:
        """Columns without nulls, so that the join and the last step share one shuffle."""
        return [id_.isNull(), F.coalesce(id_.cast("string"), F.lit("")), sha]

    kept = exact_duplicates(docs, id_col, text_col).filter("kept").select(
        *[c.alias(n) for n, c in zip(others, keys(F.col("doc_id"), F.col("text_sha256")))])
    # Visibly never null, else a filter would compute the digest once more.
    sha = F.coalesce(F.sha2(normalised(F.coalesce(docs[text_col], F.lit(""))), 256), F.lit(""))
    marked = docs.withColumns(dict(zip(names, keys(docs[id_col], sha))))
    same = [F.col(a) == F.col(b) for a, b in zip(names, others)]
    return marked.join(kept, same, "left_semi").dropDuplicates(names).drop(*names)
