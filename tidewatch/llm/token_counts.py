"""Token counts from a broadcast table of frequent pre-tokens and worker caches.

A few tasks count the pre-tokens of a bounded sample of documents and keep their most frequent ones; only
these short digests, of a fixed number, are added up. The overall most frequent pre-tokens and their
token counts are broadcast as a table of at most ``table_size`` entries of at most ``LONGEST`` characters. Then
a pass over all documents looks every pre-token up there, then in the worker's bounded cache, and encodes
what is in neither. No pre-token of that pass is shuffled, and the table only saves time: it never
changes a count, so neither does the sample.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_worker, pick
from .pretokens import Cache, pretokens

TABLE_SIZE = 32_768
#: About so many documents are looked at for frequent pre-tokens, in so many tasks.
SAMPLE_DOCUMENTS = 50_000
SAMPLE_TASKS = 16
SEED = 4
DIGEST_SIZE = 8_192
LONGEST = 32
CACHE_SIZE = 400_000


class Lengths:
    """Token counts of pre-tokens and of whole texts, by the library."""

    def __init__(self, path: str, cache_size: int = CACHE_SIZE):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Strings that the tokenizer matches inside texts, before it looks for pre-tokens.
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache = Cache(self.encode, cache_size)

    def encode(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def plain(self, text: str) -> bool:
        return not any(s in text for s in self.special)


def lengths_of(path: str) -> Lengths:
    return per_worker(("lengths", path), lambda: Lengths(path))


def frequent_pretokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                       table_size: int = TABLE_SIZE, digest_size: int = DIGEST_SIZE,
                       sample: int = SAMPLE_DOCUMENTS, tasks: int = SAMPLE_TASKS) -> dict[str, int]:
    """Token counts of the most frequent pre-tokens of about ``sample`` documents; at most ``table_size``
    entries."""

    def digest(batches):
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(pretokens(text))
            if len(counts) > 16 * digest_size:
                counts = Counter(dict(counts.most_common(4 * digest_size)))
        top = [(p, n) for p, n in counts.most_common(digest_size) if len(p) <= LONGEST and n > 1]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
            names=["piece", "n"])

    def lengths(batches):
        encode = lengths_of(path).encode
        for batch in batches:
            pieces = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(map(encode, pieces)), pa.int32())],
                names=["piece", "tokens"])

    rows = docs.count()
    some = docs.sample(sample / rows, SEED) if rows > sample else docs
    top = (pick(some, id_col, text_col).select("text").coalesce(tasks).mapInArrow(digest, "piece string, n bigint")
           .groupBy("piece").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "piece").limit(table_size).select("piece")
           .mapInArrow(lengths, "piece string, tokens int"))
    return {r["piece"]: r["tokens"] for r in top.collect()}


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024, table_size: int = TABLE_SIZE) -> DataFrame:
    """One row per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    ``path`` is a byte-level tokenizer file of the tokenizers library. A null text counts as empty
    (0 tokens). Texts with a special string of the tokenizer are encoded whole, as the library does.
    Ids may repeat or be null; each row has its own count.
    """
    table = docs.sparkSession.sparkContext.broadcast(
        frequent_pretokens(docs, path, id_col, text_col, table_size))

    def count(batches):
        first, own = table.value, lengths_of(path)
        cache = own.cache
        for batch in batches:
            numbers = []
            for text in batch.column(2).to_pylist():
                if not own.plain(text):
                    numbers.append(own.encode(text))
                    continue
                total = 0
                for piece in pretokens(text):
                    n = first.get(piece)
                    total += cache[piece] if n is None else n
                numbers.append(total)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(numbers, pa.int64()),
                 pa.array([n > limit for n in numbers], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = pick(docs, id_col, text_col).select(
        "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
