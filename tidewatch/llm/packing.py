"""Packing token pieces into fixed-length sequences: first-fit decreasing in random groups.

Documents are dealt to tasks at random, each by its own hash, and shuffled once, as text. A task takes
them in the order of their hashes, a group at a time: it encodes the group's documents, cuts
full-length pieces off long ones and packs the rest first-fit decreasing; a tournament tree over the bins' free space finds the first bin with room in
logarithmic time. Then the emptiest bins are cut up to fill the holes that are left in the others.
Groups are independent, so nothing grows with the input but their number.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_worker, pick

LENGTH = 1024
GROUP_DOCS = 2048
#: A group with more tokens than this is packed in several parts, so long documents fit a task.
GROUP_TOKENS = 4_000_000
#: Smaller holes are left as padding instead of being filled with a cut-off piece.
LEAST_CUT = 16
#: Bytes of text that a task is dealt.
TASK_BYTES = 24 << 20
#: The faster engine's pattern recurses over runs of white space; texts with a longer run than this are given
#: to the tokenizers library, which gives the same ids.
LONGEST_RUN = 200
END_ID = 0
SEED = 20

_LONG_RUN = re.compile(rf"\s{{{LONGEST_RUN}}}")


class Bins:
    """First fit over bins of equal capacity; a tournament tree keeps the largest free space
    below every node. Bins that were never used are full-capacity leaves."""

    def __init__(self, most: int, capacity: int):
        self.size = 1
        while self.size < most:
            self.size *= 2
        self.free = [capacity] * (2 * self.size)

    def put(self, need: int) -> int:
        """The first bin with room for ``need``, which is taken."""
        free, node = self.free, 1
        while node < self.size:
            node *= 2
            if free[node] < need:
                node += 1
        found = node - self.size
        free[node] -= need
        while node > 1:
            node //= 2
            best = max(free[2 * node], free[2 * node + 1])
            if free[node] == best:
                break
            free[node] = best
        return found


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices into ``lengths``. Ties keep the given order."""
    if not lengths:
        return []
    bins = Bins(len(lengths), capacity)
    out: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = bins.put(lengths[i])
        if at == len(out):
            out.append([])
        out[at].append(i)
    return out


def pack(lengths: list[int], capacity: int = LENGTH, least_cut: int = LEAST_CUT
         ) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) for documents of the given lengths.

    Full pieces are cut off the front of long documents. After first fit, the bin with the most
    free space is taken apart as long as its pieces fit into holes of at least ``least_cut``.
    """
    full = [[(d, s, capacity)] for d, n in enumerate(lengths)
            for s in range(0, n - capacity + 1, capacity)]
    rest = [(d, n - n % capacity, n % capacity) for d, n in enumerate(lengths) if n % capacity]
    bins = [[rest[i] for i in b] for b in first_fit_decreasing([r[2] for r in rest], capacity)]
    bins.sort(key=lambda b: -sum(p[2] for p in b))
    sizes = [sum(p[2] for p in b) for b in bins]
    holes = [capacity - n if capacity - n >= least_cut else 0 for n in sizes]
    room, target = sum(holes), 0
    for last in range(len(bins) - 1, 0, -1):
        room -= holes[last]
        if sizes[last] > room:
            break
        room -= sizes[last]
        for doc, start, n in bins.pop():
            while n:
                while not holes[target]:
                    target += 1
                take = min(n, holes[target])
                bins[target].append((doc, start, take))
                holes[target] -= take
                start, n = start + take, n - take
    return full + bins


class Encoder:
    """The ids that the tokenizers library gives for a byte-level tokenizer file, by a faster
    engine that reads the same vocabulary from that file where it is known to agree."""

    def __init__(self, path: str):
        import json

        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab = model["vocab"]
        # The file writes printable bytes as themselves and the others as letters from U+0100 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        self.library = Tokenizer.from_file(path)
        special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items()
                 if token not in special}
        self.coder = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks,
                                       special_tokens=special)
        self.special = list(special)
        # The faster engine merges in order of the ids, the library in order of the file's merges.
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ids = [vocab[a + b] for a, b in merges]
        self.agrees = all(a < b for a, b in zip(ids, ids[1:]))

    def encode(self, text: str) -> list[int]:
        if not self.agrees or _LONG_RUN.search(text):
            return self.library.encode(text, add_special_tokens=False).ids
        if any(s in text for s in self.special):
            return self.coder.encode(text, allowed_special="all")
        return self.coder.encode_ordinary(text)


def packed_sequences(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     length: int = LENGTH, group_docs: int = GROUP_DOCS,
                     least_cut: int = LEAST_CUT, task_bytes: int = TASK_BYTES) -> DataFrame:
    """One row per piece: doc_id, start, length, tokens (ids as little-endian unsigned 32-bit
    numbers), doc_tokens, sequence_id, offset.

    A document is its text's ids and an end id 0; a null or empty text is the end id alone.
    Each id is in exactly one piece; a sequence's pieces lie without gaps from offset 0 and hold
    ``length`` tokens at most. Rows with equal or null ids are documents of their own, and are spread over
    the tasks like others: a task follows from id, text and the input's partition.
    """
    rows = pick(docs, id_col, text_col)
    size = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    tasks = max(1, -(-size // task_bytes))
    dealt = rows.withColumn("deal", F.xxhash64("doc_id", "text", F.spark_partition_id(), F.lit(SEED)))
    kind = rows.schema["doc_id"].dataType

    def run(batches):
        encoder = per_worker(("encoder", path), lambda: Encoder(path))
        held: list = []
        task, sequence, tokens = 0, 0, 0

        def packed():
            nonlocal held, sequence, tokens
            out = []
            for pieces in pack([len(ids) for _, ids in held], length, least_cut):
                offset = 0
                for at, start, n in pieces:
                    doc, ids = held[at]
                    out.append((doc, start, n, ids[start:start + n].tobytes(), len(ids),
                                (task << 32) + sequence, offset))
                    offset += n
                sequence += 1
            held, tokens = [], 0
            columns = list(zip(*out)) if out else [()] * 7
            types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["doc_id", "start", "length", "tokens", "doc_tokens", "sequence_id", "offset"])

        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc, text, task in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if held and (len(held) >= group_docs or tokens >= GROUP_TOKENS):
                    yield packed()
                ids = np.array([*encoder.encode(text), END_ID], dtype="<u4")
                held.append((doc, ids))
                tokens += len(ids)
        if held:
            yield packed()

    return (dealt.repartition(tasks, "deal").sortWithinPartitions("deal")
            .select("doc_id", "text", F.spark_partition_id().alias("task"))
            .mapInArrow(run, f"doc_id {kind.simpleString()}, start bigint, length bigint, "
                             "tokens binary, doc_tokens bigint, sequence_id bigint, offset bigint"))

