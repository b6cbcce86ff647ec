"""Order-dependent rules on streams: live intervals, worker expiry, throttling, exclusion.

Rows of a key are buffered until the watermark has passed them and are then replayed in
(time, id) order, so the result does not depend on how events were split into batches. The
rules for throttling and exclusion are the same step functions as in batch. Members named by text or
whole numbers share a fixed number of states, as each call of a state costs far more than a row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (ArrayType, DataType, IntegralType, LongType, StringType, StructField,
                               StructType)

from ..operators.sequential import exclusion_step, throttle_step
from ..operators.windows import counted_instants
from .open_state import run_to_end, stored
from .run import use_rocksdb

STATE = StructType([StructField("values", ArrayType(LongType()))])
#: Open entities of a state: their members, when each is due, and where its numbers in ``values`` end.
ENTITIES = StructType([StructField("member", ArrayType(StringType())), StructField("due", ArrayType(LongType())),
                       StructField("upto", ArrayType(LongType())), StructField("values", ArrayType(LongType()))])
NEVER = 2**63 - 1
PIECE = StructType([StructField("first_at", LongType()), StructField("n", LongType())])
DUE = StructType([StructField("due_ms", LongType())])

SLICE = StructType([StructField("part", LongType())])
TOTAL = StructType([StructField("n", LongType())])
INSTANTS = StructType([StructField("at", ArrayType(LongType())), StructField("n", ArrayType(LongType()))])

#: An interval is cut into about so many slices.
SLICES = 64

#: So many states are shared by all members. A batch rewrites the open entities of each state that it touches. The
#: number must stay the same for a checkpoint.
SHARED_STATES = 4096

#: Rows of a key that wait for the watermark lie in pieces of at most so many rows that follow each other.
PIECE_ROWS = 1000

REGISTER, HEARTBEAT, REMOVE = 0, 1, 2
EXPIRED, REMOVED, UNKNOWN, OPEN = 0, 1, 2, 3


def rows_schema(seq: DataType) -> StructType:
    """A piece's rows, as one array per column."""
    return StructType([StructField("at", ArrayType(LongType())), StructField("seq", ArrayType(seq)),
                       StructField("code", ArrayType(LongType())), StructField("member", ArrayType(StringType()))])


def result_schema(member: DataType, seq: DataType) -> StructType:
    return StructType([StructField("member", member), StructField("a", LongType()),
                       StructField("id", seq), StructField("b", LongType()),
                       StructField("c", LongType()), StructField("d", LongType())])


class Replay(StatefulProcessor):
    """Buffers the rows of a state's members and gives each member's to ``rule`` in order once the watermark allows.

    Rows wait in pieces of bounded size, in order of time, and a timer reads only pieces whose first row the
    watermark has passed. Every call of the state goes to the JVM and back, so a batch's rows are few
    pieces, and a state's open entities one value. A state has one timer at most; one without rows and
    without an open entity keeps nothing. With ``shared`` a state has many members, whose names are in the
    rows as text; otherwise its key is its only member.
    """

    entities = ENTITIES

    def __init__(self, rule, seq: DataType, shared: bool):
        self.rule, self.seq, self.shared = rule, seq, shared

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getMapState("rows", PIECE, rows_schema(self.seq))
        self.state = handle.getValueState("state", self.entities)
        self.due = handle.getValueState("due", DUE)

    def _wake(self, at_us: int | None) -> None:
        """Have the state's only timer at the given time, or at the earlier one it has."""
        old = int(self.due.get()[0]) if self.due.exists() else None
        new = old if at_us is None else -(-at_us // 1000)
        if new is None or (old is not None and old <= new):
            return
        if old is not None:
            self.handle.deleteTimer(old)
        self.handle.registerTimer(new)
        self.due.update((new,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues
                        ) -> Iterator[pd.DataFrame]:
        ids, fresh = "int64" if isinstance(self.seq, LongType) else str, []
        for frame in rows:
            names = frame["name"].tolist() if self.shared else [None] * len(frame)
            fresh += zip(frame["at"].astype("int64").tolist(), frame["seq"].astype(ids).tolist(),
                         frame["code"].astype("int64").tolist(), names, strict=True)
        self._wake(self._put(sorted(fresh, key=_by_time)))
        yield from ()

    def _put(self, rows: list[tuple]) -> int:
        """Store rows, which are in order; the first one's time."""
        for start in range(0, len(rows), PIECE_ROWS):
            piece, n = rows[start:start + PIECE_ROWS], 0
            while self.rows.containsKey((piece[0][0], n)):
                n += 1
            self.rows.updateValue((piece[0][0], n), tuple(list(x) for x in zip(*piece, strict=True)))
        return rows[0][0]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.due.clear()
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        ready, later, waiting = [], [], []
        for piece in sorted((int(k[0]), int(k[1])) for k in self.rows.keys()):
            if piece[0] > passed:
                waiting.append(piece[0])
                break
            for row in zip(*self.rows.getValue(piece), strict=True):
                (ready if row[0] <= passed else later).append(row)
            self.rows.removeKey(piece)
        if later:
            waiting.append(self._put(sorted(later, key=_by_time)))
        ready.sort(key=_by_time)
        out, due = self._apply(ready, passed)
        times = [t for t in (*waiting, due) if t is not None]
        self._wake(min(times) if times else None)
        if out:
            yield _results([(name if self.shared else key[0], *row) for name, row in out], self.seq)

    def _apply(self, ready: list[tuple], passed: int) -> tuple[list[tuple], int | None]:
        """Results (member's name, row) of rows in order, and when to look again at the latest."""
        held: dict[str | None, tuple[list, int]] = {}
        if self.state.exists():
            names, dues, ends, values = self.state.get()
            start = 0
            for name, due, end in zip(names, dues, ends, strict=True):
                held[name] = ([int(v) for v in values[start:int(end)]], int(due))
                start = int(end)
        rows: dict[str | None, list[tuple]] = {name: [] for name, (_, due) in held.items() if due <= passed}
        for row in ready:
            rows.setdefault(row[3], []).append(row[:3])
        out = []
        for name, own in rows.items():
            results, entity, due = self.rule(own, held.get(name, ([], NEVER))[0], passed)
            out += [(name, result) for result in results]
            held[name] = ([int(v) for v in entity], NEVER if due is None else int(due))
        held = {name: entity for name, entity in held.items() if entity[0]}
        if held:
            ends = np.cumsum([len(values) for values, _ in held.values()]).tolist()
            self.state.update((list(held), [due for _, due in held.values()], ends,
                               [v for values, _ in held.values() for v in values]))
        elif self.state.exists():
            self.state.clear()
        first = min((due for _, due in held.values()), default=NEVER)
        return out, None if first == NEVER else first

    def close(self) -> None:
        pass


class Counting(Replay):
    """Counts, for each instant with rows, a key's rows in the interval that ends there.

    Rows that were counted lie by instant in slices of a part of the interval, with a total per slice: a count
    adds up the totals of whole slices and looks into the one that the interval's start cuts. A timer
    drops the slices that no later row can count; a key that is silent for an interval keeps no state.
    """

    entities = STATE

    def __init__(self, interval_us: int, seq: DataType):
        super().__init__(None, seq, shared=False)
        self.interval, self.width = interval_us, max(1, interval_us // SLICES)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.totals = handle.getMapState("totals", SLICE, TOTAL)
        self.instants = handle.getMapState("instants", SLICE, INSTANTS)

    def _apply(self, ready: list[tuple], passed: int) -> tuple[list[tuple], int | None]:
        times = sorted(Counter(row[0] for row in ready).items())
        if self.interval <= 0:
            n, out = int(self.state.get()[0][0]) if self.state.exists() else 0, []
            for at, rows in times:
                n += rows
                out.append((None, (at, n, 0, 0, False)))
            self.state.update(([n],))
            return out, None
        totals = {int(k[0]): int(v[0]) for k, v in self.totals.iterator()}
        fresh: dict[int, list[tuple[int, int]]] = {}
        kept: dict[int, list[tuple[int, int]]] = {}

        def held(part: int) -> list[tuple[int, int]]:
            if part not in kept:
                known = part in totals and self.instants.containsKey((part,))
                kept[part] = list(zip(*self.instants.getValue((part,)), strict=True)) if known else []
            return kept[part] + fresh.get(part, [])

        out = []
        for at, rows in times:
            part, start = at // self.width, at - self.interval
            fresh.setdefault(part, []).append((at, rows))
            totals[part] = totals.get(part, 0) + rows
            cut = start // self.width
            n = sum(rows for p, rows in totals.items() if cut < p <= part)
            n += sum(int(rows) for t, rows in held(cut) if t >= start) if cut in totals else 0
            out.append((None, (at, n, 0, 0, False)))
        for part in fresh:
            self.instants.updateValue((part,), tuple([int(v) for v in x] for x in zip(*held(part), strict=True)))
            self.totals.updateValue((part,), (totals[part],))
        for part in [p for p in totals if (p + 1) * self.width <= passed - self.interval]:
            del totals[part]
            self.instants.removeKey((part,))
            self.totals.removeKey((part,))
        return out, (max(totals) + 1) * self.width + self.interval if totals else None


def _by_time(row: tuple) -> tuple:
    return row[:3]


def _results(out: list[tuple], seq: DataType) -> pd.DataFrame:
    """Rules give (a, b, c, d); b is a row's id in results that name a row, and nothing where there is no end."""
    named = [(member, int(a), b if by_id else None, None if by_id or b is None else int(b), int(c), int(d))
             for member, a, b, c, d, by_id in out]
    frame = pd.DataFrame(named, columns=["member", "a", "id", "b", "c", "d"])
    return frame.astype({"b": "Int64", **({"id": "Int64"} if isinstance(seq, LongType) else {})})


class _Stepped:
    """A batch step function as a stream rule; ``pick`` turns marked rows into results."""

    def __init__(self, step, pick):
        self.step, self.pick = step, pick

    def __call__(self, ready, state, passed):
        if not ready:
            return [], state, None
        rows = {"__at": np.array([r[0] for r in ready], np.int64), "__seq": [r[1] for r in ready],
                "__terminal": np.array([r[2] for r in ready], np.int64)}
        columns, state = self.step(rows, state)
        return self.pick(rows, columns), state, None

    def open(self, state):
        return []


def _emitted(rows, columns):
    return [(at, seq, 0, 0, True) for at, seq, on in
            zip(rows["__at"], rows["__seq"], columns["emitted"], strict=True) if on]


def _excluded(rows, columns):
    return [(at, recent, until, tracked, False) for at, recent, until, tracked in zip(
        rows["__at"], columns["recent"], columns["until_us"], columns["tracked"].astype(int), strict=True)]


class LiveRule:
    """State: start and last refresh while live, else nothing.

    Results are (start, end, reason, last refresh); a heartbeat without a live interval gives
    (time, id, UNKNOWN, 0).
    """

    def __init__(self, timeout_us: int, check_us: int):
        self.timeout_us, self.check_us = timeout_us, check_us

    def _tick(self, last: int) -> int:
        return ((last + self.timeout_us) // self.check_us + 1) * self.check_us

    def __call__(self, ready, state, passed):
        out = []
        for at, seq, code in ready:
            if state and self._tick(state[1]) <= at:
                out.append((state[0], self._tick(state[1]), EXPIRED, state[1], False))
                state = []
            if code == REGISTER:
                state = [state[0] if state else at, at]
            elif code == HEARTBEAT:
                if state:
                    state = [state[0], at]
                else:
                    out.append((at, seq, UNKNOWN, 0, True))
            elif state:
                out.append((state[0], at, REMOVED, state[1], False))
                state = []
        if state and self._tick(state[1]) <= passed:
            out.append((state[0], self._tick(state[1]), EXPIRED, state[1], False))
            state = []
        return out, state, self._tick(state[1]) if state else None

    def open(self, state):
        return [(state[0], None, OPEN, state[1], False)] if state else []


class WorkerRule:
    """State: registration time and last heartbeat (0 for none yet), else nothing."""

    def __init__(self, period_us: int):
        self.period_us = period_us

    def _tick(self, state) -> int:
        registered, beat = state
        if beat:
            return ((beat + self.period_us) // self.period_us + 1) * self.period_us
        return (registered // self.period_us + 1) * self.period_us

    def __call__(self, ready, state, passed):
        out = []
        for at, _seq, code in ready:
            if state and self._tick(state) <= at:
                out.append((state[0], self._tick(state), EXPIRED, state[1], False))
                state = []
            if code == REGISTER and not state:
                state = [at, 0]
            elif code == HEARTBEAT and state:
                state = [state[0], at]
        if state and self._tick(state) <= passed:
            out.append((state[0], self._tick(state), EXPIRED, state[1], False))
            state = []
        return out, state, self._tick(state) if state else None

    def open(self, state):
        return [(state[0], None, OPEN, state[1], False)] if state else []


class FirstRule:
    """State: the time of the first row, once there was one. Results are (time, id of the first row)."""

    def __call__(self, ready, state, passed):
        if state or not ready:
            return [], state, None
        at, seq, _code = ready[0]
        return [(at, seq, 0, 0, True)], [at], None

    def open(self, state):
        return []


@dataclass
class StreamRule:
    """A rule over the rows of a stream: which column is what, and how its results are shaped."""

    member: str
    ts: str
    seq: str
    code: Column
    rule: object
    shape: Callable[[DataFrame], DataFrame]

    def shared(self, member: DataType) -> bool:
        """Whether members share states: text names them exactly. Others have a state each."""
        return isinstance(member, IntegralType) or member == StringType()

    def processor(self, seq: DataType, member: DataType) -> Replay:
        return Replay(self.rule, seq, self.shared(member))

    def results(self, stream: DataFrame) -> DataFrame:
        """The stream must carry a watermark on the time. Members keep their type; ids that are no whole
        numbers are ordered as text."""
        use_rocksdb(stream.sparkSession)
        kind, member = stream.schema[self.seq].dataType, stream.schema[self.member].dataType
        kind = LongType() if isinstance(kind, IntegralType) else StringType()
        name = F.col(self.member)
        unit = F.pmod(F.xxhash64(name), F.lit(SHARED_STATES)) if self.shared(member) else name
        rows = stream.select(
            unit.alias("unit"), (name.cast("string") if self.shared(member) else F.lit(None).cast("string")).alias("name"),
            F.unix_micros(F.col(self.ts)).alias("at"), F.col(self.seq).cast(kind).alias("seq"),
            self.code.cast("bigint").alias("code"), F.col(self.ts))
        out = rows.groupBy("unit").transformWithStateInPandas(
            statefulProcessor=self.processor(kind, member),
            outputStructType=result_schema(StringType() if self.shared(member) else member, kind), outputMode="append",
            timeMode="eventTime")
        return self.shape(out.withColumn("member", F.col("member").cast(member)))

    def rest(self, spark, checkpoint: str, until_us: int, member: DataType) -> DataFrame:
        """What the results lack after a run with this checkpoint: those of rows that the watermark has not
        passed, of check ticks up to ``until_us``, and what is open then.

        Members are dealt to as many tasks as a shuffle has, however few bytes they are; a member's waiting rows,
        which one state held together, come to one task.
        """
        held, state = stored(spark, checkpoint, "rows"), stored(spark, checkpoint, "state")
        seq = held.schema["user_map_value"].dataType["seq"].dataType.elementType
        shared = self.shared(member)
        own = F.col("name").cast(member) if shared else F.col("unit")
        waiting = held.select(F.col("key.unit").alias("unit"), F.explode(F.arrays_zip(*[
            F.col(f"user_map_value.{n}").alias(n) for n in ("at", "seq", "code", "member")])).alias("x"))
        waiting = waiting.select("unit", F.col("x.member").alias("name"), "x.at", "x.seq", "x.code")
        upto = F.col("value.upto")
        entities = state.select(F.col("key.unit").alias("unit"), F.posexplode("value.member").alias("n", "name"),
                                upto.alias("upto"), F.col("value.values").alias("values"))
        start = F.coalesce(F.get("upto", F.col("n") - 1), F.lit(0))
        entities = entities.select(own.alias("member"), F.slice(
            "values", (start + 1).cast("int"), (F.get("upto", F.col("n")) - start).cast("int")).alias("entity"))
        rows = waiting.select(own.alias("member"), "at", "seq", "code").unionByName(entities, allowMissingColumns=True)
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.repartition(tasks, "member").sortWithinPartitions("member")
        out = result_schema(member, seq)
        return self.shape(rows.mapInArrow(_finisher(self.rule, until_us, out.names), out))

    def whole(self, stream: DataFrame, until_us: int) -> DataFrame:
        """Run everything now available; all results, those still open with them."""
        spark = stream.sparkSession
        return run_to_end(self.results(stream), lambda checkpoint: self.rest(
            spark, checkpoint, until_us, stream.schema[self.member].dataType))


def _finisher(rule, until_us: int, names: list[str]):
    """A function over batches in which a member's rows and open entity follow each other."""
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        member, ready, entity, out, kinds = None, None, [], [], []

        def ended() -> None:
            results, last, _ = rule(sorted(ready, key=_by_time), entity, until_us)
            for a, b, c, d, by_id in results + rule.open(last):
                out.append((member, int(a), b if by_id else None, None if by_id or b is None else int(b), int(c), int(d)))

        def given() -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            number = pa.int64()
            kinds = [batch.schema.field("member").type, number, batch.schema.field("seq").type, number, number, number]
            columns = [batch.column(n).to_pylist() for n in ("member", "at", "seq", "code", "entity")]
            for of, at, seq, code, values in zip(*columns, strict=True):
                # A number that is none equals nothing, itself included, but is one member.
                if ready is None or not (of == member or (of != of and member != member)):
                    if ready is not None:
                        ended()
                    member, ready, entity = of, [], []
                if values is not None:
                    entity = [int(v) for v in values]
                else:
                    ready.append((at, seq, code))
            if out:
                yield given()
                out.clear()
        if ready is not None:
            ended()
            yield given()
    return finish


@dataclass
class CountRule(StreamRule):
    """Counts in an interval, ``rule`` microseconds long."""

    def shared(self, member: DataType) -> bool:
        return False

    def processor(self, seq: DataType, member: DataType) -> Replay:
        return Counting(self.rule, seq)

    def rest(self, spark, checkpoint: str, until_us: int, member: DataType) -> DataFrame:
        waiting = stored(spark, checkpoint, "rows").select(
            F.col("key.unit").alias("member"), F.explode("user_map_value.at").alias("__at"))
        waiting = waiting.groupBy("member", "__at").agg(F.count(F.lit(1)).alias("__n"))
        if self.rule > 0:
            kept = stored(spark, checkpoint, "instants").select(F.col("key.unit").alias("member"), F.explode(
                F.arrays_zip("user_map_value.at", "user_map_value.n")).alias("x"))
            kept = kept.select("member", F.col("x.at").alias("__at"), F.col("x.n").alias("__n"))
        else:
            kept = stored(spark, checkpoint, "state").select(
                F.col("key.unit").alias("member"), F.lit(-2**62).alias("__at"), F.get("value.values", 0).alias("__n"))
        # Only what waits is new; rows of an instant that was counted before it cannot come any more.
        both = waiting.withColumn("__new", F.lit(1)).unionByName(kept.withColumn("__new", F.lit(0)))
        instants = both.groupBy("member", "__at").agg(F.sum("__n").alias("__n"), F.max("__new").alias("__new"))
        counted = counted_instants(instants.drop("__new"), ["member"], self.rule, "b")
        fresh = instants.filter("__new = 1").select(F.col("member").alias("__m"), F.col("__at").alias("a"))
        found = counted.join(fresh, F.col("member").eqNullSafe(F.col("__m")) & (F.col("__at") == F.col("a")))
        return self.shape(found.select("member", "a", F.lit(None).cast("bigint").alias("id"), "b",
                                       F.lit(0).cast("bigint").alias("c"), F.lit(0).cast("bigint").alias("d")))


def failures_in_interval(failures: DataFrame, key: str, ts: str, seq: str, interval_us: int,
                         name: str = "recent_failures", until_us: int | None = None) -> DataFrame:
    """Per failure time of a key: failures in ``[time - interval, time]``, exactly, as
    ``operators.windows.failures_in_interval`` has them; with ``until_us`` the stream is run to its last row."""
    def shape(out: DataFrame) -> DataFrame:
        return out.select(F.col("member").alias(key), F.timestamp_micros("a").alias(ts), F.col("b").alias(name))

    rule = CountRule(key, ts, seq, F.lit(0), interval_us, shape)
    return rule.results(failures) if until_us is None else rule.whole(failures, until_us)


def _kind_code(kind: str) -> Column:
    return (F.when(F.col(kind) == "register", REGISTER).when(F.col(kind) == "heartbeat", HEARTBEAT)
            .when(F.col(kind) == "remove", REMOVE))


def _known(stream: DataFrame, kind: str, *kinds: str) -> DataFrame:
    return stream.filter(F.col(kind).isin(*kinds))


def live_rule(member: str, ts: str, seq: str, kind: str, timeout_us: int, check_us: int) -> StreamRule:
    """(member, change, id, start, end, end_reason, last_seen): change is ``interval``, or ``request`` for a
    heartbeat of a member that is not live, with its id and, as ``start``, its time. Rows of other kinds
    must have been left out."""
    def shape(out: DataFrame) -> DataFrame:
        request, code = F.col("c") == UNKNOWN, F.col("c")
        reason = F.when(code == EXPIRED, "expired").when(code == REMOVED, "removed").when(code == OPEN, "open")
        return out.select(
            F.col("member").alias(member), F.when(request, "request").otherwise("interval").alias("change"),
            F.col("id").alias(seq), F.timestamp_micros("a").alias("start"), F.timestamp_micros("b").alias("end"),
            reason.alias("end_reason"), F.when(~request, F.timestamp_micros("d")).alias("last_seen"))

    return StreamRule(member, ts, seq, _kind_code(kind), LiveRule(timeout_us, check_us), shape)


def _intervals(changes: DataFrame, seq: str) -> DataFrame:
    return changes.filter("change = 'interval'").drop("change", seq)


def _requests(changes: DataFrame, member: str, ts: str, seq: str) -> DataFrame:
    return changes.filter("change = 'request'").select(member, seq, F.col("start").alias(ts))


def live_changes(stream: DataFrame, member: str, ts: str, seq: str, kind: str, timeout_us: int,
                 check_us: int, until_us: int | None = None) -> DataFrame:
    """Ended live intervals and requests to register again, from one state per member (``live_rule``).

    With ``until_us`` the stream is run over everything now available, and intervals open then are added.
    """
    known, rule = _known(stream, kind, "register", "heartbeat", "remove"), live_rule(member, ts, seq, kind, timeout_us, check_us)
    return rule.results(known) if until_us is None else rule.whole(known, until_us)


def live_intervals(stream: DataFrame, member: str, ts: str, seq: str, kind: str, timeout_us: int,
                   check_us: int, until_us: int | None = None) -> DataFrame:
    """Ended live intervals (member, start, end, end_reason, last_seen) of a stream; with ``until_us`` as in
    ``live_changes``, the open ones too."""
    return _intervals(live_changes(stream, member, ts, seq, kind, timeout_us, check_us, until_us), seq)


def reregister_requests(stream: DataFrame, member: str, ts: str, seq: str, kind: str,
                        timeout_us: int, check_us: int, until_us: int | None = None) -> DataFrame:
    """Heartbeats (member, id, time) of members that are not live at that moment."""
    return _requests(live_changes(stream, member, ts, seq, kind, timeout_us, check_us, until_us), member, ts, seq)


def expire_workers(stream: DataFrame, member: str, ts: str, seq: str, kind: str, period_us: int,
                   until_us: int | None = None) -> DataFrame:
    """Expired workers (member, registered, expired) under the master's rule; with ``until_us`` the stream is
    run, and live workers are added without an end."""
    def shape(out: DataFrame) -> DataFrame:
        return out.select(F.col("member").alias(member), F.timestamp_micros("a").alias("registered"),
                          F.timestamp_micros("b").alias("expired"))

    known = _known(stream, kind, "register", "heartbeat")
    rule = StreamRule(member, ts, seq, _kind_code(kind), WorkerRule(period_us), shape)
    return rule.results(known) if until_us is None else rule.whole(known, until_us)


def first_registrations(registrations: DataFrame, member: str, ts: str, seq: str,
                        until_us: int | None = None) -> DataFrame:
    """The first registration (member, id, time) of each member in order of time and id, whatever the order in which
    rows come up to the watermark; later ones are duplicates, for good. ``windows.register_dedup`` forgets ids
    after the watermark's delay and takes any of the first. With ``until_us`` the stream is run to its last row."""
    def shape(out: DataFrame) -> DataFrame:
        return out.select(F.col("member").alias(member), F.col("id").alias(seq), F.timestamp_micros("a").alias(ts))

    rule = StreamRule(member, ts, seq, F.lit(0), FirstRule(), shape)
    return rule.results(registrations) if until_us is None else rule.whole(registrations, until_us)


def throttle(stream: DataFrame, key: str, ts: str, seq: str, period_us: int, terminal: str,
             until_us: int | None = None) -> DataFrame:
    """Emitted rows (key, id, time); with ``until_us`` the stream is run to its last row."""
    def shape(out: DataFrame) -> DataFrame:
        return out.select(F.col("member").alias(key), F.col("id").alias(seq), F.timestamp_micros("a").alias(ts))

    rule = StreamRule(key, ts, seq, F.col(terminal).cast("int"), _Stepped(throttle_step(period_us), _emitted), shape)
    return rule.results(stream) if until_us is None else rule.whole(stream, until_us)


def exclusion_windows(failures: DataFrame, host: str, ts: str, seq: str, most: int,
                      interval_us: int, timeout_us: int, until_us: int | None = None) -> DataFrame:
    """Failures (host, time, count, tracked) and the exclusions they start; with ``until_us`` the stream is run
    to its last row."""
    def shape(out: DataFrame) -> DataFrame:
        return out.select(F.col("member").alias(host), F.timestamp_micros("a").alias(ts),
                          F.col("b").alias("recent"), (F.col("d") == 1).alias("tracked"),
                          F.when(F.col("c") >= 0, F.timestamp_micros("c")).alias("excluded_until"))

    rule = StreamRule(host, ts, seq, F.lit(0), _Stepped(exclusion_step(most, interval_us, timeout_us), _excluded), shape)
    return rule.results(failures) if until_us is None else rule.whole(failures, until_us)
