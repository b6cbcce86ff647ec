"""Rules whose next step depends on their last decision: throttling and exclusion windows.

``fold`` runs a small state machine over each key's rows in order, batch by batch, so memory does
not grow with a key. Keys whose rows suit one task are replayed there. A larger key is cut into
ordered chunks, whose entry states are found first.

Throttling, and exclusion without a finite interval, move from one counted row to the next by a
pointer that depends on that row alone (``Pointers``). One backward pass per chunk then says for each
row that could be the first counted one where its chain leaves the chunk; these few pieces are
chained over the chunks of a key, and one more pass marks the rows: a fixed number of passes.

Exclusion with a finite interval under twice the timeout has a state of several times. There a chunk is
summed up as a function of the state it is entered with (``exclusion.IntervalChunks``), the functions are
applied in order per key, and one more pass marks the rows: again a fixed number of passes.

For other rules chunks run from a guessed entry state and are run again while the exit state of the
chunk before differs. That is exact when it stops, after at most as many rounds as a key has chunks:
few if the rule forgets within a chunk, one per chunk if it does not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructType

from ..session import rows_per_task, written
from .exclusion import IntervalChunks, interval_step
from .lifecycle import micros
from .ordered import CHUNK, largest_group, split_by_order

STATE = "__state"

#: (column values in order, entry state) -> (columns to add, exit state)
Step = Callable[[dict[str, np.ndarray], list[int]], tuple[dict[str, np.ndarray], list[int]]]


@dataclass(frozen=True)
class Pointers:
    """A rule by pointers: after a counted row at time t the next one is the first row from ``reach``(t) on,
    or an earlier row that is terminal. The first ``free`` rows of a key count in any case.

    ``enter`` gives the step's state from (the time from which rows count, or None; rows counted).
    """

    reach: Callable[[np.ndarray], np.ndarray]
    enter: Callable[[int | None, int], list[int]]
    free: int = 0
    terminal: str | None = None


def fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], step: Step, added: str,
         limit: int | None = None, pointers: Pointers | None = None,
         functions: IntervalChunks | None = None) -> DataFrame:
    """``df`` with the columns ``added`` (DDL) that ``step`` computes per key in ``order``.

    ``pointers`` or ``functions`` give the entry states of chunks in a fixed number of passes. ``step`` sees a key's rows in pieces, each with the exit state of the piece before. Pass only
    the columns the rule needs plus a row id; they travel through Arrow.
    """
    keys, order = list(keys), list(order)
    extra = StructType.fromDDL(added).fields
    shape = StructType(list(df.schema.fields) + list(extra))
    limit = limit or rows_per_task(df.sparkSession)
    total, largest = largest_group(df, keys)
    # The explicit number keeps small inputs from being merged into one Python worker.
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // limit))
    if largest <= limit:
        groups, rows = keys, df
    else:
        chunks = split_by_order(df, keys, order, total, limit)
        if pointers:
            entries = _pointer_entries(chunks, keys, order, pointers, parts)
        elif functions:
            entries = _function_entries(chunks, keys, order, functions, parts)
        else:
            entries = _entry_states(chunks, keys, order, step, parts)
        groups, rows = [*keys, CHUNK], _attach(chunks, entries, keys)
    names = shape.names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, columns, _ends in _replayed(batches, groups, step):
            if len(pdf):
                yield pdf.assign(**columns)[names]

    return _in_order(rows, groups, order, parts).mapInPandas(run, shape)


def _in_order(rows: DataFrame, groups: list[str], order: list[str], parts: int) -> DataFrame:
    """Each group in one partition, sorted."""
    return rows.repartition(parts, *groups).sortWithinPartitions(*groups, *order)


def _grouped(batches: Iterator[pd.DataFrame], groups: list[str], columns: list[str]):
    """(key, {column: values}) of each group of sorted batches, whole."""
    current, held = None, []
    for pdf in batches:
        if not len(pdf):
            continue
        places = pdf.groupby(groups, sort=False, dropna=False).ngroup().to_numpy()
        starts = np.concatenate(([0], np.flatnonzero(np.diff(places)) + 1, [len(pdf)]))
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            key = tuple(None if pd.isna(pdf[g].iloc[a]) else pdf[g].iloc[a] for g in groups)
            if key != current:
                if held:
                    yield current, {c: np.concatenate([h[c] for h in held]) for c in columns}
                current, held = key, []
            held.append({c: pdf[c].to_numpy()[a:b] for c in columns})
    if held:
        yield current, {c: np.concatenate([h[c] for h in held]) for c in columns}


MOST, LEAST = np.iinfo(np.int64).max, np.iinfo(np.int64).min


def chain_pieces(at: np.ndarray, terminal: np.ndarray, rule: Pointers) -> list[tuple]:
    """A chunk as a function of what comes in: (by_free, upto, leave, free, counted).

    by_free 1: with ``upto`` free rows left; 0: rows count from a time of at most ``upto`` on, and more than
    the piece before. ``leave`` is the time from which rows count afterwards (LEAST: as before).
    """
    n = len(at)
    ends = np.flatnonzero(terminal)
    following = np.append(ends, n)[np.searchsorted(ends, np.arange(n), side="right")]
    reach = rule.reach(at)
    onward = np.minimum(np.searchsorted(at, reach, side="left"), following)
    onward = np.maximum(onward, np.arange(n) + 1).tolist()
    leave, counted = reach.tolist(), [1] * n
    for i in range(n - 1, -1, -1):
        if onward[i] < n:
            leave[i], counted[i] = leave[onward[i]], counted[onward[i]] + 1
    out = []
    for free in range(rule.free + 1):
        if free >= n:
            out.append((1, free, LEAST, free - n, n))
        else:
            out.append((1, free, leave[free], 0, free + counted[free]))
    # No earlier row reaches further than the chunk's first one would.
    last = min(int(np.searchsorted(at, reach[0], side="left")), int(ends[0]) if len(ends) else n)
    pieces = [(0, int(at[j]), leave[j], 0, counted[j]) for j in range(min(last + 1, n))]
    if last == n:
        pieces.append((0, MOST, LEAST, 0, 0))
    else:
        pieces[-1] = (0, MOST, *pieces[-1][2:])
    return out + [p for p, q in zip(pieces, [*pieces[1:], None]) if q is None or p[2:] != q[2:]]


def _pointer_entries(chunks: DataFrame, keys: list[str], order: list[str], rule: Pointers,
                     parts: int) -> DataFrame:
    groups = [*keys, CHUNK]
    columns = ["__at", *([rule.terminal] if rule.terminal else [])]
    piece = StructType([chunks.schema[g] for g in groups])
    for name in ("by_free", "upto", "leave", "free", "counted"):
        piece = piece.add(name, LongType())
    entry = StructType([chunks.schema[g] for g in groups]).add(STATE, ArrayType(LongType()))

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for key, rows in _grouped(batches, groups, columns):
            terminal = (rows[rule.terminal].astype(bool) if rule.terminal
                        else np.zeros(len(rows["__at"]), bool))
            yield pd.DataFrame([(*key, *p) for p in chain_pieces(rows["__at"], terminal, rule)],
                               columns=piece.names)

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        owner, since, free, counted = None, None, 0, 0
        for key, p in _grouped(batches, groups, ["by_free", "upto", "leave", "free", "counted"]):
            if owner is None or key[:-1] != owner:
                owner, since, free, counted = key[:-1], None, rule.free, 0
            yield pd.DataFrame([(*key, rule.enter(since, counted))], columns=entry.names)
            by_free = p["by_free"] == 1
            if since is None:
                i = int(np.flatnonzero(by_free & (p["upto"] == free))[0])
            else:
                by_time = np.flatnonzero(~by_free)
                i = int(by_time[np.searchsorted(p["upto"][by_time], since, side="left")])
            if p["leave"][i] != LEAST:
                since = int(p["leave"][i])
            free, counted = int(p["free"][i]), counted + int(p["counted"][i])

    pieces = written(_in_order(chunks.select(*groups, *order, *columns[1:]), groups, order, parts)
                     .mapInPandas(summarise, piece))
    # A key's pieces pass through one task as a stream.
    ordered = pieces.repartition(parts, *keys).sortWithinPartitions(*groups, "by_free", "upto")
    return written(ordered.mapInPandas(chain, entry))


def _function_entries(chunks: DataFrame, keys: list[str], order: list[str], functions: IntervalChunks,
                      parts: int) -> DataFrame:
    groups = [*keys, CHUNK]
    summed = StructType([chunks.schema[g] for g in groups]).add("summary", BinaryType())
    entry = StructType([chunks.schema[g] for g in groups]).add(STATE, ArrayType(LongType()))

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for key, rows in _grouped(batches, groups, ["__at"]):
            yield pd.DataFrame([(*key, functions.summary(rows))], columns=summed.names)

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        owner, state = None, []
        for key, row in _grouped(batches, groups, ["summary"]):
            if owner is None or key[:-1] != owner:
                owner, state = key[:-1], []
            yield pd.DataFrame([(*key, [int(v) for v in state])], columns=entry.names)
            state = functions.leave(row["summary"][0], state)

    summaries = written(_in_order(chunks.select(*groups, *order), groups, order, parts)
                        .mapInPandas(summarise, summed))
    # A key's summaries pass through one task, one after the other.
    ordered = summaries.repartition(parts, *keys).sortWithinPartitions(*groups)
    return written(ordered.mapInPandas(chain, entry))


def _replayed(batches: Iterator[pd.DataFrame], groups: list[str], step: Step):
    """Run ``step`` over sorted batches; a group may go on in the next batch.

    Yields each batch with the columns to add and the groups that ended before or in it.
    """
    current, state = None, []
    for pdf in batches:
        if not len(pdf):
            continue
        values = {name: pdf[name].to_numpy() for name in pdf.columns}
        places = pdf.groupby(groups, sort=False, dropna=False).ngroup().to_numpy()
        starts = np.concatenate(([0], np.flatnonzero(np.diff(places)) + 1, [len(pdf)]))
        marked, ends = [], []
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            key = tuple(None if pd.isna(values[g][a]) else values[g][a] for g in groups)
            if key != current:
                if current is not None:
                    ends.append((current, state))
                current = key
                state = [int(v) for v in values[STATE][a]] if STATE in values else []
            columns, state = step({n: v[a:b] for n, v in values.items()}, state)
            marked.append(columns)
        yield pdf, {n: np.concatenate([m[n] for m in marked]) for n in marked[0]}, ends
    if current is not None:
        yield pd.DataFrame(), {}, [(current, state)]


def _same(names: list[str], df: DataFrame, *added: str) -> tuple[DataFrame, Column]:
    """``df`` with other names for the columns ``names``, and the condition that a row has equal ones; null
    keys are keys like others."""
    matches = F.lit(True)
    for n in names:
        matches = matches & F.col(n).eqNullSafe(F.col(f"__e_{n}"))
    return df.select(*[F.col(n).alias(f"__e_{n}") for n in names], *added), matches


def _attach(chunks: DataFrame, entries: DataFrame, keys: list[str]) -> DataFrame:
    """Chunk rows with their entry state. Rows are sorted by key, so there are at most two keys per chunk
    that go on in another one, and the entries of the others are left out: the side is small."""
    names = [*keys, CHUNK]
    small, matches = _same(names, entries.filter(F.size(STATE) > 0), STATE)
    return (chunks.join(F.broadcast(small), matches, "left").drop(*[f"__e_{n}" for n in names])
            .withColumn(STATE, F.coalesce(STATE, F.array().cast("array<bigint>"))))


def _entry_states(chunks: DataFrame, keys: list[str], order: list[str], step: Step,
                  parts: int) -> DataFrame:
    per_key = Window.partitionBy(*keys)
    places = (chunks.select(*keys, CHUNK).distinct()
              .withColumn("__parts", F.count(F.lit(1)).over(per_key))
              .filter(F.col("__parts") > 1).drop("__parts"))
    entries = written(places.withColumn(STATE, F.array().cast("array<bigint>")))
    groups = [*keys, CHUNK]
    exit_shape = StructType([chunks.schema[g] for g in groups]).add(
        "__exit", ArrayType(LongType()))

    def leave(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _pdf, _columns, ends in _replayed(batches, groups, step):
            if ends:
                yield pd.DataFrame([(*key, [int(v) for v in state]) for key, state in ends],
                                   columns=exit_shape.names)

    todo, exits = entries, None
    while True:
        side, matches = _same(groups, todo, STATE)
        rows = chunks.join(F.broadcast(side), matches).drop(*[f"__e_{n}" for n in groups])
        fresh = written(_in_order(rows, groups, order, parts).mapInPandas(leave, exit_shape))
        if exits is not None:
            side, matches = _same(groups, fresh)
            fresh = fresh.unionByName(exits.join(side, matches, "left_anti"))
        exits = written(fresh)
        before = F.lag("__exit").over(Window.partitionBy(*keys).orderBy(CHUNK))
        wanted = exits.select(*groups, F.coalesce(
            before, F.array().cast("array<bigint>")).alias("__wanted"))
        side, matches = _same(groups, wanted, "__wanted")
        joined = written(entries.join(side, matches).select(*groups, STATE, "__wanted"))
        todo = (joined.filter(F.col("__wanted") != F.col(STATE))
                .select(*groups, F.col("__wanted").alias(STATE)))
        entries = joined.select(*groups, F.col("__wanted").alias(STATE))
        if todo.isEmpty():
            return entries


# ---------------------------------------------------------------- throttle

def throttle_step(period_us: int) -> Step:
    """State: time of the last emitted row, or nothing."""
    def step(rows: dict[str, np.ndarray], state: list[int]):
        at = rows["__at"]
        terminal = np.flatnonzero(rows["__terminal"].astype(bool))
        emitted = np.zeros(len(at), dtype=bool)
        last = state[0] if state else None
        i, next_terminal = 0, 0
        while i < len(at):
            if last is not None:
                due = i + int(np.searchsorted(at[i:], last + period_us, side="right"))
                while next_terminal < len(terminal) and terminal[next_terminal] < i:
                    next_terminal += 1
                if next_terminal < len(terminal):
                    due = min(due, int(terminal[next_terminal]))
                i = due
                if i >= len(at):
                    break
            emitted[i] = True
            last = int(at[i])
            i += 1
        return {"emitted": emitted}, ([] if last is None else [last])
    return step


def throttle(df: DataFrame, keys: Sequence[str], ts: str, row_id: str, period_us: int,
             terminal: str, limit: int | None = None) -> DataFrame:
    """Rows more than ``period`` after the last emitted row of their key, and terminal rows.

    Returns keys, row id and time of the emitted rows.
    """
    rows = df.select(*keys, row_id, ts, micros(F.col(ts)).alias("__at"),
                     F.col(terminal).cast("boolean").alias("__terminal"))
    rule = Pointers(lambda at: at + (period_us + 1),
                    lambda since, _n: [] if since is None else [since - period_us - 1],
                    terminal="__terminal")
    rows = rows.withColumn("__terminal", F.coalesce("__terminal", F.lit(False)))
    marked = fold(rows, keys, ["__at", row_id], throttle_step(period_us), "emitted boolean", limit, rule)
    return marked.filter("emitted").select(*keys, row_id, ts)


# ---------------------------------------------------------------- exclusion

def endless_exclusion_step(most: int, timeout_us: int) -> Step:
    """Without an interval no failure is forgotten. State: end of the exclusion, failures counted."""
    def step(rows: dict[str, np.ndarray], state: list[int]):
        at = rows["__at"]
        until, n = state or (LEAST, 0)
        counted = np.zeros(len(at), dtype=bool)
        recent = np.full(len(at), n, dtype=np.int64)
        ends = np.full(len(at), -1, dtype=np.int64)
        i, last = int(np.searchsorted(at, until, side="left")), 0
        while i < len(at):
            recent[last:i] = n
            n, last = n + 1, i
            counted[i], recent[i] = True, n
            if n > most:
                until = int(at[i]) + timeout_us
                ends[i] = until
            i += 1
            if n > most:
                i += int(np.searchsorted(at[i:], until, side="left"))
        return {"tracked": counted, "recent": np.where(counted, recent, 0), "until_us": ends}, [int(until), n]
    return step


def exclusion_step(most: int, interval_us: int, timeout_us: int) -> Step:
    """State: end of the exclusion, then the tracked failure times that still matter: those of one
    interval. Without an interval only their number is kept."""
    if interval_us <= 0:
        return endless_exclusion_step(most, timeout_us)
    return interval_step(most, interval_us, timeout_us)


def exclusion_windows(failures: DataFrame, host: str, ts: str, row_id: str, most: int,
                      interval_us: int, timeout_us: int, limit: int | None = None) -> DataFrame:
    """Each failure with ``tracked``, its count and the exclusion it starts (``excluded_until``).

    More than ``most`` failures of a host inside the interval exclude it until ``timeout`` later.
    Failures of an excluded host are not counted; it is free again when the time is reached. Large hosts
    take a fixed number of passes without an interval (0 or less) and with one under twice the timeout;
    with a longer one, as many rounds as it takes until no chunk's entry state changes.
    """
    rows = failures.select(host, row_id, ts, micros(F.col(ts)).alias("__at"))
    rule = None
    if interval_us <= 0 < timeout_us:
        rule = Pointers(lambda at: at + timeout_us, free=most,
                        enter=lambda since, n: [LEAST if since is None else since, n] if n else [])
    functions = None
    if IntervalChunks.fits(interval_us, timeout_us):
        functions = IntervalChunks(most, interval_us, timeout_us)
    marked = fold(rows, [host], ["__at", row_id], exclusion_step(most, interval_us, timeout_us),
                  "tracked boolean, recent bigint, until_us bigint", limit, rule, functions)
    return marked.select(host, row_id, ts, "tracked", "recent", F.when(
        F.col("until_us") >= 0, F.timestamp_micros("until_us")).alias("excluded_until"))
