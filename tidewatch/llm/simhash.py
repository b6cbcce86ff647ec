"""SimHash near-duplicates: pigeonhole blocks, then Hamming distance.

Fingerprints that differ in at most ``distance`` bits agree on at least m - distance of m blocks. A table
per choice of m - distance blocks keys every distinct fingerprint by these blocks; equal keys
make a bucket. m grows with the number of fingerprints, so chance buckets stay small; the result
does not depend on it. A bucket gives a spanning forest of its links, not all pairs: a
fingerprint that has been linked is taken out before the next comparison. Buckets too large for
one task are cut into chunks, and each pair of chunks is a group of its own.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import free_names, pick
from .components import components

BITS = 64
DISTANCE = 3
SHINGLE_WORDS = 3
SEED = 42
#: Shingles whose bits are counted at a time.
AT_ONCE = 1 << 16
#: Distinct fingerprints of a bucket that one task compares.
BUCKET_LIMIT = 20_000
#: Blocks are added until a chance bucket has no more than this many fingerprints.
CHANCE = 4


def fingerprint(text: str, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """64 bits; a bit is set if it is set in over half of the shingles' hashes. No word: zero."""
    parts = text.encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not parts:
        return 0
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    span = min(words, len(parts)) - 1
    starts, ends = starts[:len(parts) - span], ends[span:]
    digest = xxhash.xxh64_intdigest
    total = np.zeros(BITS, np.int64)
    for i in range(0, len(starts), AT_ONCE):
        hashes = np.array([digest(joined[s:e], seed) for s, e in
                           zip(starts[i:i + AT_ONCE].tolist(), ends[i:i + AT_ONCE].tolist())], "<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1,
                               bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed number), one row per row."""
    def run(batches):
        for batch in batches:
            prints = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], "<u8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view("<i8"))],
                                             names=["doc_id", "fp"])

    rows = pick(docs, id_col, text_col)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp bigint")


def blocks_for(prints: int, distance: int = DISTANCE, chance: int = CHANCE) -> int:
    """The number of blocks for so many distinct fingerprints."""
    m = distance + 1
    while m < 3 * distance and prints / 2 ** (BITS * (m - distance) / m) > chance:
        m += 1
    return m


def block_keys(fp: Column, m: int, distance: int = DISTANCE) -> Column:
    """An array of (table, key): the bits of the blocks that each table keeps."""
    edges = [BITS * i // m for i in range(m + 1)]
    masks = [sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in kept)
             for kept in combinations(range(m), m - distance)]
    signed = [mask - (1 << 64) if mask >> 63 else mask for mask in masks]
    return F.array(*[F.struct(F.lit(i).alias("block_table"), fp.bitwiseAND(F.lit(mask).cast("bigint"))
                              .alias("key")) for i, mask in enumerate(signed)])


def forest(prints: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, np.ndarray]]:
    """Links that connect all of ``prints`` (distinct) that chains of links connect."""
    out, left, frontier = [], prints, []
    while len(left):
        if not frontier:
            frontier, left = [left[0]], left[1:]
        x = frontier.pop()
        near = np.bitwise_count(left ^ x) <= distance
        if near.any():
            reached = left[near]
            out.append((x, reached))
            left = left[~near]
            frontier.extend(reached)
    return out


def _links(distance: int):
    def bucket_links(prints: np.ndarray, found: list) -> None:
        for x, reached in forest(prints, distance):
            found.append((np.full(len(reached), x, np.uint64), reached))

    def batch_of(found: list) -> pa.RecordBatch:
        a, b = (np.concatenate([f[i] for f in found]).view(np.int64) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches):
        group, held = None, []
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            keys, prints = columns[:4], columns[4].view(np.uint64)
            new = np.any([k[1:] != k[:-1] for k in keys], axis=0)
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(prints)]
            found: list = []
            for s, e in zip(cuts, cuts[1:]):
                if e == s:
                    continue
                # Only the first and the last bucket of a batch can go on in another batch.
                if s == 0 or e == len(prints):
                    key = tuple(int(k[s]) for k in keys)
                    if key != group:
                        if held and len(p := np.concatenate(held)) > 1:
                            bucket_links(p, found)
                        group, held = key, []
                    held.append(prints[s:e])
                elif e - s > 1:
                    bucket_links(prints[s:e], found)
            if found:
                yield batch_of(found)
        found = []
        if held and len(p := np.concatenate(held)) > 1:
            bucket_links(p, found)
        if found:
            yield batch_of(found)

    return run


def links(prints: DataFrame, distance: int = DISTANCE, blocks: int | None = None,
          bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) at most ``distance`` bits apart: not all of
    them, but enough to connect whatever links connect."""
    m = blocks or blocks_for(prints.count(), distance)
    keyed = prints.select("fp", F.inline(block_keys(F.col("fp"), m, distance)))
    large = (keyed.groupBy("block_table", "key").agg(F.count("*").alias("size"))
             .filter(F.col("size") > bucket_limit)
             .select("block_table", "key", F.ceil(2 * F.col("size") / bucket_limit).cast("int").alias("chunks")))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1))
    grouped = (keyed.join(large, ["block_table", "key"], "left")
               .withColumn("own", F.coalesce(own, F.lit(0))).withColumn("other", other)
               .select("block_table", "key", F.least("own", "other").alias("low"),
                       F.greatest("own", "other").alias("high"), "fp"))
    names = ["block_table", "key", "low", "high"]
    return (grouped.repartition(*names).sortWithinPartitions(*names)
            .mapInArrow(_links(distance), "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    distance: int = DISTANCE, blocks: int | None = None,
                    bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """doc_id, fp, component_id (smallest id reachable over links), one row per row.

    A null text counts as empty; texts without words have fingerprint zero and are linked like any
    others. Null ids are larger than any other; a component of null ids only has a null id.
    Rows with the same id are rows of their own.
    """
    rows = written(fingerprints(docs, id_col, text_col))
    prints = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = written(components(links(prints.select("fp"), distance, blocks, bucket_limit)))
    rooted = (prints.join(roots, prints["fp"] == roots["node"], "left")
              .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_print = rooted.join(smallest, "root").select("fp", "component_id")
    return rows.join(of_print, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs``, with all its columns, per component: that with the smallest id.

    A null id is larger than any other. Of rows that share the id the one with the smallest digest of its
    text stays; of rows that share both, any one."""
    id_ = F.col(id_col)
    sha = F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"), 256)
    key = F.struct(id_.isNull().alias("none"), id_.alias("id"), sha.alias("sha"))
    found = near_duplicates(docs.select(key.alias("_key"), F.col(text_col).alias("_text")), "_key", "_text")

    names = free_names(docs, "_row_none", "_row_id", "_row_sha")
    others = free_names(docs, "_stay_none", "_stay_id", "_stay_sha")

    def keys(key: Column, names: list[str]) -> list[Column]:
        """Columns without nulls, so that the join and the last step share one shuffle."""
        return [key["none"].alias(names[0]), F.coalesce(key["id"].cast("string"), F.lit("")).alias(names[1]),
                F.coalesce(key["sha"], F.lit("")).alias(names[2])]

    stay = found.select("component_id").distinct().select(*keys(F.col("component_id"), others))
    marked = docs.select(*[docs[c] for c in docs.columns], *keys(key, names))
    same = [F.col(a) == F.col(b) for a, b in zip(names, others)]
    return marked.join(stay, same, "left_semi").dropDuplicates(names).drop(*names)


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
