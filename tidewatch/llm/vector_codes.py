"""Product codes of vectors by dual-tree Lloyd rounds in exact integers.

Vectors are cut into parts; each part position has a codebook. Blocks of vectors get a tree per part
position once: every node holds the box, the number and the sum of its parts. A round walks that tree
and a tree over the codebook's entries together. The bounds between a node of parts and a node of
entries prune entries that cannot be nearest to any part below; a node with one entry left is assigned
whole, with its stored sum; where leaves of both trees meet with several entries left, integer distances
decide. Blocks are rows of a stored table, so a lost executor costs a reread, and only a
codebook's sums leave a task.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .vectors import integer_vectors

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Vectors of a block, and parts of a leaf.
BLOCK = 2048
LEAF = 8


@dataclass
class PartTree:
    """A balanced tree over the rows of ``points``, which are in tree order; the children of node i are
    2i + 1 and 2i + 2, the last level's nodes are the leaves."""

    points: np.ndarray
    order: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def leaf(self, nodes: np.ndarray) -> np.ndarray:
        return nodes >= len(self.starts) // 2


def node_ranges(n: int, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """First row and row after the last of every node of a tree over ``n`` rows."""
    depth = 0
    while (n >> depth) > leaf and (2 << depth) <= n:
        depth += 1
    bounds = [np.arange((1 << d) + 1) * n >> d for d in range(depth + 1)]
    return np.concatenate([b[:-1] for b in bounds]), np.concatenate([b[1:] for b in bounds])


def part_tree(points: np.ndarray, leaf: int = LEAF) -> PartTree:
    """The tree over ``points`` (int64, a row per part; one at least): halves along the widest side."""
    starts, ends = node_ranges(len(points), leaf)
    order = np.arange(len(points))
    levels = (len(starts) + 1).bit_length() - 1
    for level in range(levels - 1):
        nodes = slice((1 << level) - 1, (2 << level) - 1)
        at = points[order]
        wide = (np.maximum.reduceat(at, starts[nodes]) - np.minimum.reduceat(at, starts[nodes])).argmax(1)
        node = np.repeat(np.arange(1 << level), ends[nodes] - starts[nodes])
        order = order[np.lexsort((at[np.arange(len(at)), wide[node]], node))]
    at = points[order]
    per_level = [starts[(1 << d) - 1:(2 << d) - 1] for d in range(levels)]
    low, high, sums = (np.concatenate([f.reduceat(at, s) for s in per_level])
                       for f in (np.minimum, np.maximum, np.add))
    return PartTree(at, order, low, high, sums, starts, ends)


class EntryTree:
    """A tree over the entries of a codebook; leaves are single entries (``entry`` >= 0)."""

    def __init__(self, book: np.ndarray):
        self.low, self.high, self.left, self.right, self.entry = [], [], [], [], []
        self._add(book, np.arange(len(book)))
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.left, self.right, self.entry = map(np.array, (self.left, self.right, self.entry))

    def _add(self, book: np.ndarray, own: np.ndarray) -> int:
        node, at = len(self.entry), book[own]
        self.low.append(at.min(0))
        self.high.append(at.max(0))
        self.left.append(-1)
        self.right.append(-1)
        self.entry.append(int(own[0]) if len(own) == 1 else -1)
        if len(own) > 1:
            own = own[np.argsort(at[:, (self.high[node] - self.low[node]).argmax()], kind="stable")]
            self.left[node] = self._add(book, own[:len(own) // 2])
            self.right[node] = self._add(book, own[len(own) // 2:])
        return node


def assign(tree: PartTree, book: np.ndarray, entries: EntryTree
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, their entries, rows, their entries): which nodes of ``tree`` belong wholly to one entry,
    and the entries of the remaining rows (in tree order). Of equally near entries the first wins."""
    nodes, others = np.zeros(1, np.int64), np.zeros(1, np.int64)
    whole, leaves = [], []
    while len(nodes):
        low, high = tree.low[nodes], tree.high[nodes]
        e_low, e_high = entries.low[others], entries.high[others]
        nearest = (np.maximum(0, np.maximum(e_low - high, low - e_high)) ** 2).sum(1)
        farthest = (np.maximum(np.abs(high - e_low), np.abs(e_high - low)) ** 2).sum(1)
        first = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]])
        sizes = np.diff(np.r_[first, len(nodes)])
        # Some entry is at most this far from every part of the node; equal bounds stay, for ties.
        bound = np.repeat(np.minimum.reduceat(farthest, first), sizes)
        left = nearest <= bound
        nodes, others = nodes[left], others[left]
        first = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]])
        sizes = np.diff(np.r_[first, len(nodes)])
        single = entries.entry[others] >= 0
        alone = np.repeat(sizes == 1, sizes) & single
        whole.append((nodes[alone], entries.entry[others[alone]]))
        # Entries of a leaf of parts go on to single entries; then integer distances decide.
        settled = np.repeat(np.logical_and.reduceat(single, first), sizes) & tree.leaf(nodes) & ~alone
        leaves.append((nodes[settled], entries.entry[others[settled]]))
        open_ = ~alone & ~settled
        nodes, others, single = nodes[open_], others[open_], single[open_]
        others = np.r_[np.where(single, others, entries.left[others]), entries.right[others[~single]]]
        nodes = np.r_[nodes, nodes[~single]]
        leaf = tree.leaf(nodes)
        others = np.r_[others, others[~leaf]]
        nodes = np.r_[np.where(leaf, nodes, 2 * nodes + 1), 2 * nodes[~leaf] + 2]
        by_node = np.argsort(nodes, kind="stable")
        nodes, others = nodes[by_node], others[by_node]
    at, entry = (np.concatenate(x) for x in zip(*leaves))
    counts = tree.ends[at] - tree.starts[at]
    rows = np.repeat(tree.starts[at] - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
    entry = np.repeat(entry, counts)
    distance = ((tree.points[rows] - book[entry]) ** 2).sum(1)
    best = np.lexsort((entry, distance, rows))
    rows, entry = rows[best], entry[best]
    first = np.r_[True, rows[1:] != rows[:-1]] if len(rows) else np.zeros(0, bool)
    return *(np.concatenate(x) for x in zip(*whole)), rows[first], entry[first]


def entry_sums(tree: PartTree, found, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Number and sum of the parts of every entry."""
    nodes, of_node, rows, of_row = found
    counts = np.zeros(entries, np.int64)
    sums = np.zeros((entries, tree.points.shape[1]), np.int64)
    np.add.at(counts, of_node, tree.ends[nodes] - tree.starts[nodes])
    np.add.at(sums, of_node, tree.sums[nodes])
    np.add.at(counts, of_row, 1)
    np.add.at(sums, of_row, tree.points[rows])
    return counts, sums


def entry_of_rows(tree: PartTree, found) -> np.ndarray:
    """The entry of every row, in tree order."""
    nodes, of_node, rows, of_row = found
    out = np.empty(len(tree.points), np.int64)
    out[rows] = of_row
    for start, end, entry in zip(tree.starts[nodes], tree.ends[nodes], of_node):
        out[start:end] = entry
    return out


def _stored(tree: PartTree) -> dict:
    return {"points": tree.points.astype("<i4").tobytes(), "order": tree.order.astype("<i4").tobytes(),
            "low": tree.low.astype("<i4").tobytes(), "high": tree.high.astype("<i4").tobytes(),
            "sums": tree.sums.astype("<i8").tobytes()}


def _read(row: dict, width: int, leaf: int) -> PartTree:
    def array(name: str, kind: str) -> np.ndarray:
        return np.frombuffer(row[name], kind).astype(np.int64)

    points = array("points", "<i4").reshape(-1, width)
    return PartTree(points, array("order", "<i4"), *(array(n, k).reshape(-1, width) for n, k in
                    (("low", "<i4"), ("high", "<i4"), ("sums", "<i8"))), *node_ranges(len(points), leaf))


@dataclass
class Codes:
    """``blocks`` as stored; ``books[part][entry]`` are the final codebooks."""

    blocks: DataFrame
    books: np.ndarray
    leaf: int


def build_blocks(vectors: DataFrame, parts: int, width: int, block: int, leaf: int) -> DataFrame:
    """``vectors`` (vec_id, q, label) as stored blocks: vec_ids, labels and a tree per part position."""
    kind = {n: vectors.schema[n].dataType.simpleString() for n in ("vec_id", "label")}
    tree = "points: binary, order: binary, low: binary, high: binary, sums: binary"

    def run(batches):
        types = [pa.binary()] * 5
        stored = pa.struct(list(zip(("points", "order", "low", "high", "sums"), types)))

        def made(held):
            batch = pa.Table.from_batches(held).combine_chunks()
            ids, labels = batch.column("vec_id").combine_chunks(), batch.column("label").combine_chunks()
            values = batch.column("q").combine_chunks().flatten().to_numpy().reshape(len(ids), parts, width)
            trees = [_stored(part_tree(values[:, p], leaf)) for p in range(parts)]
            return pa.RecordBatch.from_arrays(
                [pa.array([ids.to_pylist()], pa.list_(ids.type)), pa.array([labels.to_pylist()], pa.list_(labels.type)),
                 pa.array([trees], pa.list_(stored))], names=["vec_ids", "labels", "trees"])

        held, size = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, block - size)
                batch = batch.slice(part.num_rows)
                held.append(part)
                size += part.num_rows
                if size == block:
                    yield made(held)
                    held, size = [], 0
        if size:
            yield made(held)

    return written(vectors.select("vec_id", "q", "label").mapInArrow(
        run, f"vec_ids array<{kind['vec_id']}>, labels array<{kind['label']}>, trees array<struct<{tree}>>"))


def next_books(blocks: DataFrame, books: np.ndarray, leaf: int) -> np.ndarray:
    """The codebooks after one round; an entry without parts stays as it is."""
    parts, entries, width = books.shape
    shared = blocks.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        books = shared.value
        trees = [EntryTree(b) for b in books]
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            for row in batch.column(0).to_pylist():
                for p, stored in enumerate(row):
                    tree = _read(stored, width, leaf)
                    n, s = entry_sums(tree, assign(tree, books[p], trees[p]), entries)
                    counts[p] += n
                    sums[p] += s
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(counts[p, e]),
             *(pa.array(sums[p, e, i]) for i in range(width))],
            names=["part", "entry", "n", *(f"s{i}" for i in range(width))])

    names = [f"s{i}" for i in range(width)]
    sums = blocks.select("trees").mapInArrow(
        run, "part int, entry int, n bigint, " + ", ".join(f"{n} bigint" for n in names))
    sums = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(n).alias(n) for n in names])
    out = books.copy()
    for row in sums.collect():  # a row per part position and entry at most
        out[row["part"], row["entry"]] = [row[n] // row["n"] for n in names]
    return out


def fit(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
        parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
        dimension: int | None = None, block: int = BLOCK, leaf: int = LEAF) -> Codes | None:
    """Codebooks of all rows whose vector is there and has only finite components; None without such rows.

    Vectors need a common length, a multiple of ``parts``: ``dimension``, or without it the most common such
    length (of equally common ones the smallest); others are left out. Rows with equal or null ids
    are vectors of their own. The first codebooks are cut from the rows with the smallest ids, null
    ids last, equal ids in order of their components; fewer rows than ``entries`` give as many entries.
    Scaled components saturate at 2^27, so distances are exact.
    """
    kept = integer_vectors(vectors, id_col, vector_col, scale, vectors[label_col].alias("label"))
    if dimension is None:
        sizes = kept.groupBy(F.size("q").alias("size")).count().filter(f"size > 0 AND size % {parts} = 0")
        row = sizes.orderBy(F.desc("count"), "size").first()
        if row is None:
            return None
        dimension = row["size"]
    kept = kept.filter(F.size("q") == dimension)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(entries).select("q").collect()
    if not first:
        return None
    width = dimension // parts
    books = np.array([r["q"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    blocks = build_blocks(kept, parts, width, block, leaf)
    for _ in range(rounds):
        books = next_books(blocks, books, leaf)
    return Codes(blocks, books, leaf)


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encoded(found: Codes) -> DataFrame:
    """One row per kept row: vec_id, label, code (two hex digits per part), error (squared distance to the
    decoded vector)."""
    parts, _, width = found.books.shape
    shared = found.blocks.sparkSession.sparkContext.broadcast((found.books, found.leaf))
    kind = {n: found.blocks.schema[f"{n}s"].dataType.elementType.simpleString() for n in ("vec_id", "label")}

    def run(batches):
        books, leaf = shared.value
        entry_trees = [EntryTree(b) for b in books]
        for batch in batches:
            for at in range(batch.num_rows):
                n = len(batch.column(0)[at])
                codes, error = np.empty((n, parts), np.uint8), np.zeros(n, np.int64)
                for p, stored in enumerate(batch.column(2)[at].as_py()):
                    tree = _read(stored, width, leaf)
                    entry = entry_of_rows(tree, assign(tree, books[p], entry_trees[p]))
                    codes[tree.order, p] = entry
                    error[tree.order] += ((tree.points - books[p][entry]) ** 2).sum(1)
                hexed = codes.tobytes().hex()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[at].values, batch.column(1)[at].values,
                     pa.array([hexed[i:i + 2 * parts] for i in range(0, 2 * parts * n, 2 * parts)], pa.string()),
                     pa.array(error)], names=["vec_id", "label", "code", "error"])

    return found.blocks.mapInArrow(run, f"vec_id {kind['vec_id']}, label {kind['label']}, code string, error bigint")


def compressed(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
               label_col: str = "label", **settings) -> DataFrame:
    """One row per row that ``fit`` keeps: vec_id, code, error, label_error (errors of all rows with an equal
    label, null labels together), codebooks_sha256."""
    found = fit(vectors, id_col, vector_col, label_col, **settings)
    schema = (f"vec_id {vectors.schema[id_col].dataType.simpleString()}, code string, error bigint, "
              "label_error bigint, codebooks_sha256 string")
    if found is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = written(encoded(found))
    # A row per label, stored, so that the join is planned by its real size.
    totals = written(rows.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error")))
    return rows.join(totals, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", "error", "label_error",
        F.lit(books_digest(found.books)).alias("codebooks_sha256"))
