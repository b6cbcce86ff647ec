"""Stream sinks: one query per queue, isolated handlers, keyed upserts, late rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType

from ..operators.keyed import count_type, latest_by_key

# Queue names.
QUEUES = ("shared", "appStatus", "executorManagement", "eventLog")


def fan_out(stream: DataFrame, sinks: Mapping[str, str], checkpoint: str, **trigger
            ) -> dict[str, StreamingQuery]:
    """One parquet query per named queue, each with its own progress.

    A slow or failed queue does not hold up the others; each starts from the earliest event and
    goes on after a restart from its own checkpoint.
    """
    trigger = trigger or {"availableNow": True}
    return {name: (stream.writeStream.queryName(f"queue_{name}").format("parquet")
                   .option("path", path).option("checkpointLocation", f"{checkpoint}/{name}")
                   .trigger(**trigger).start())
            for name, path in sinks.items()}


def isolated(handlers: Mapping[str, Callable[[DataFrame, int], None]],
             report: Callable[[str, int, Exception], None]
             ) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that gives each batch to every handler.

    A handler that fails is reported and the others still get the batch. The batch is kept in
    memory or on disk of the executors meanwhile, so it is read once.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, handler in handlers.items():
                try:
                    handler(batch, batch_id)
                except (PySparkException, Py4JJavaError, ValueError, TypeError, KeyError,
                        ArithmeticError, RuntimeError) as error:
                    report(name, batch_id, error)
        finally:
            batch.unpersist()
    return handle


class FailureLog:
    """A report for ``isolated`` that keeps what failed as a table (handler, error), a row per failed batch; a
    batch that fails again replaces its row."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._add("", -1, "")  # an empty first version, so that the table can always be read

    def _add(self, name: str, batch_id: int, error: str) -> None:
        rows = self.spark.createDataFrame([(name, error)] if name else [], "handler string, error string")
        rows.coalesce(1).write.mode("overwrite").parquet(batch_folder(f"{self.path}/{name or 'none'}", batch_id))

    def __call__(self, name: str, batch_id: int, error: Exception) -> None:
        self._add(name, batch_id, str(error))

    def read(self) -> DataFrame:
        return self.spark.read.schema("handler string, error string").option(
            "recursiveFileLookup", "true").parquet(self.path)


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


class UpsertTable:
    """A keyed status table kept current by a stream, as a log of changes.

    Each micro-batch appends the newest row per key of its own rows in a folder of its own; a batch
    that is run again overwrites only that. The table is the newest row per key of the last
    compacted base and the batches after it. ``compact`` is a normal job that writes a new base;
    folders that it has replaced are never read again and can be removed by any clean-up.
    """

    def __init__(self, spark: SparkSession, path: str, schema, keys: Sequence[str],
                 seq: Sequence[str], op_col: str | None = None, delete: str = "delete"):
        self.spark, self.path, self.schema = spark, path, schema
        self.keys, self.seq = list(keys), list(seq)
        self.op_col, self.delete = op_col, delete
        # Empty first versions, so that every folder can always be read.
        nothing = spark.createDataFrame([], schema)
        nothing.write.mode("ignore").parquet(batch_folder(self._changes, -1))
        nothing.write.mode("ignore").parquet(batch_folder(self._base, -1))
        self._note(-1, "ignore")

    @property
    def _changes(self) -> str:
        return f"{self.path}/changes"

    @property
    def _base(self) -> str:
        return f"{self.path}/base"

    @property
    def _compacted(self) -> str:
        return f"{self.path}/compacted"

    def _note(self, batch_id: int, mode: str) -> None:
        (self.spark.range(1).select(F.lit(batch_id).cast("bigint").alias("upto")).write.mode(mode)
         .parquet(batch_folder(self._compacted, batch_id)))

    def _rows(self, folder: str) -> DataFrame:
        return (self.spark.read.option("basePath", folder)
                .schema(StructType(list(self.schema.fields)).add("batch_id", LongType()))
                .parquet(folder))

    def _upto(self) -> int:
        """The batch up to which the newest base holds everything; one row per compaction is read."""
        return (self.spark.read.schema("upto bigint").parquet(self._compacted)
                .agg(F.max("upto")).first()[0])

    def _current(self, last: int | None = None) -> DataFrame:
        """The newest row per key, delete markers included. Both folders are pruned by batch."""
        upto = self._upto()
        batch = F.col("batch_id")
        base = self._rows(self._base).filter(batch == upto)
        changes = self._rows(self._changes).filter(batch > upto)
        if last is not None:
            changes = changes.filter(batch <= last)
        return latest_by_key(base.unionByName(changes).drop("batch_id"), self.keys, self.seq)

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` handler; touches nothing but the batch's own rows."""
        (latest_by_key(batch.select(*self.schema.names), self.keys, self.seq)
         .write.mode("overwrite").parquet(batch_folder(self._changes, batch_id)))

    def compact(self, last: int) -> None:
        """Write a base of all batches up to ``last``, which must be complete. Readers see either the old
        base with its changes or the new one."""
        if last > self._upto():
            self._current(last).write.mode("overwrite").parquet(batch_folder(self._base, last))
            self._note(last, "overwrite")

    def read(self) -> DataFrame:
        """The current table without deleted keys."""
        rows = self._current()
        return rows.filter(F.col(self.op_col) != self.delete) if self.op_col else rows


class ThresholdCounts:
    """Counts rows per type over a stream and calls ``action(type, count)`` for each type of a batch whose
    count is above the threshold.

    Each batch stores all totals after it, those of the batch before and its own counts, so it reads one
    row per type, however many batches there were; a repeated batch starts from the same totals.
    """

    def __init__(self, spark: SparkSession, path: str, type_col: str, threshold: int,
                 action: Callable[[str, int], None]):
        self.spark, self.path, self.type_col = spark, path, type_col
        self.threshold, self.action = threshold, action

    def _before(self, batch_id: int, counts: DataFrame) -> DataFrame:
        """(type, n) after the newest batch before this one."""
        shape = counts.schema
        try:
            return self.spark.read.schema(shape).parquet(batch_folder(self.path, batch_id - 1))
        except AnalysisException:
            pass  # no such folder: the first batch here, or ids with a gap
        try:
            stored = (self.spark.read.option("basePath", self.path)
                      .schema(StructType(list(shape.fields)).add("batch_id", LongType())).parquet(self.path))
        except AnalysisException:
            return counts.limit(0)
        last = stored.filter(F.col("batch_id") < batch_id).agg(F.max("batch_id")).first()[0]
        return stored.filter(F.col("batch_id") == F.lit(last)).drop("batch_id")

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        counts = count_type(batch, self.type_col)
        both = counts.withColumn("fresh", F.lit(1)).unionByName(
            self._before(batch_id, counts).withColumn("fresh", F.lit(0)))
        totals = both.groupBy(self.type_col).agg(F.sum("n").alias("n"), F.max("fresh").alias("fresh"))
        totals.write.mode("overwrite").parquet(batch_folder(self.path, batch_id))
        here = self.spark.read.schema(totals.schema).parquet(batch_folder(self.path, batch_id))
        for row in here.filter((F.col("fresh") == 1) & (F.col("n") > self.threshold)).toLocalIterator():
            self.action(row[self.type_col], row["n"])


def on_threshold(type_col: str, threshold: int, action: Callable[[str, int], None],
                 table: Callable[[], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Call ``action(type, count)`` for types whose stored rows exceed the threshold.

    Only the types of the batch are looked at; the counts come from the stored table.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        seen = batch.select(type_col).distinct()
        counts = count_type(table().join(seen, type_col, "left_semi"), type_col)
        for row in counts.filter(F.col("n") > threshold).toLocalIterator():
            action(row[type_col], row["n"])
    return handle


class LateRows:
    """Keeps rows that are older than the newest event time seen before, less a delay.

    Spark drops such rows behind a watermark; this side query stores them. The newest time of
    each batch is stored under its batch id, so a repeated batch gives the same rows.
    """

    def __init__(self, spark: SparkSession, path: str, ts: str, delay_us: int):
        self.spark, self.path, self.ts, self.delay_us = spark, path, ts, delay_us
        self.last: tuple[int, int | None] = (-1, None)

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        at = F.unix_micros(F.col(self.ts))
        before = self._newest_before(batch_id)
        batch = batch.persist()
        try:
            newest = batch.agg(F.max(at)).first()[0]
            newest = max((x for x in (before, newest) if x is not None), default=None)
            # An empty batch stores what it was given.
            (self.spark.range(1).select(F.lit(newest).cast("bigint").alias("newest"))
             .write.mode("overwrite").parquet(batch_folder(f"{self.path}/newest", batch_id)))
            late = F.lit(False) if before is None else at <= before - self.delay_us
            (batch.filter(late).write.mode("overwrite")
             .parquet(batch_folder(f"{self.path}/late", batch_id)))
            self.last = (batch_id, newest)
        finally:
            batch.unpersist()

    def _newest_before(self, batch_id: int) -> int | None:
        """The newest time of all earlier batches; None before the first row."""
        if batch_id == 0:
            return None
        if self.last[0] == batch_id - 1:
            return self.last[1]
        return (self.spark.read.schema("newest bigint, batch_id bigint").parquet(f"{self.path}/newest")
                .filter(F.col("batch_id") == batch_id - 1).agg(F.max("newest")).first()[0])

    def read(self, schema) -> DataFrame:
        return (self.spark.read.option("basePath", f"{self.path}/late").schema(schema)
                .parquet(f"{self.path}/late").drop("batch_id"))
