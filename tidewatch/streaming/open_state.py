"""What is still open when a stream has read all its input: entities read from the stored state.

A stream gives an interval, session, bar or window once it has ended. When a run is over, those that have not
are in the checkpoint, where the state data source finds them. The functions here turn that state into
rows like the stream's own, so that a result and its rest together cover the whole input.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .run import new_checkpoint, run_batches, run_to_table


def stored(spark: SparkSession, checkpoint: str, variable: str | None = None) -> DataFrame:
    """The newest state of a checkpoint's (only) stateful operator, or one of its variables."""
    reader = spark.read.format("statestore")
    if variable:
        reader = reader.option("stateVarName", variable)
    return reader.load(checkpoint)


def run_to_end(stream: DataFrame, rest: Callable[[str], DataFrame]) -> DataFrame:
    """Run everything now available; its results and those of ``rest`` (checkpoint), by name."""
    checkpoint = new_checkpoint(stream.sparkSession)
    done = run_to_table(stream, checkpoint=checkpoint)
    return done.unionByName(rest(checkpoint))


def aggregates(spark: SparkSession, checkpoint: str, buffers: Sequence[str]) -> DataFrame:
    """Keys of a streaming aggregation (columns of ``key``) and its buffers, named in their order."""
    state = stored(spark, checkpoint)
    fields = state.schema["value"].dataType.fields
    # Buffers of equal functions share a name, so they are renamed by place.
    named = StructType([StructField(n, f.dataType) for n, f in zip(buffers, fields, strict=True)])
    return state.select("key", F.col("value").cast(named).alias("value")).select("key.*", "value.*")


def open_bars(spark: SparkSession, checkpoint: str, security: str = "security") -> DataFrame:
    """The bars of ``liveness.quote_bars`` whose end the watermark has not passed."""
    state = aggregates(spark, checkpoint, ["high", "low", "open", "opened", "close", "closed", "quotes"])
    return state.select(security, F.col("window.start").alias("bar_start"), "high", "low", "open", "close", "quotes")


def open_windows(spark: SparkSession, checkpoint: str, keys: Sequence[str]) -> DataFrame:
    """(keys, window_start, window_end, failures) of ``liveness.sliding_failures``'s windows still open."""
    state = aggregates(spark, checkpoint, ["failures"])
    return state.select(*keys, F.col("window.start").alias("window_start"),
                        F.col("window.end").alias("window_end"), "failures")


def open_reports(spark: SparkSession, checkpoint: str, keys: Sequence[str], capacity: int) -> DataFrame:
    """The reports of ``liveness.overflow_report`` still open."""
    state = aggregates(spark, checkpoint, ["received"])
    return state.select(*keys, F.col("window.start").alias("report_start"), "received",
                        F.greatest(F.col("received") - capacity, F.lit(0)).alias("dropped"))


def open_sessions(spark: SparkSession, checkpoint: str, member: str) -> DataFrame:
    """The sessions of ``windows.sessions`` that a later row could still prolong."""
    value = stored(spark, checkpoint).select("value.*")
    of, _window, start, last, n = value.columns
    return value.select(F.col(of).alias(member), F.col(start).alias("start"), F.col(last).alias("last_seen"),
                        F.col(n).alias("beats"))


def snapshot(stream: DataFrame, keys: Sequence[str], buffers: Sequence[str], checkpoint: str | None = None
             ) -> DataFrame:
    """Run a streaming aggregation over everything now available and read every group from its state, ended or
    not, once.

    ``stream`` is the grouped and aggregated stream, with ``buffers`` naming its aggregates: one value
    each (``min``, ``max``, ``sum``, ``count``), without a watermark, so that no group is dropped.
    """
    checkpoint = checkpoint or new_checkpoint(stream.sparkSession)
    # Changed groups are not written anywhere: the state holds them all.
    run_batches(stream, lambda batch, _id: batch.write.format("noop").mode("overwrite").save(), checkpoint, "update")
    return aggregates(stream.sparkSession, checkpoint, buffers).select(*keys, *buffers)
