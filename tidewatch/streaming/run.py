"""Starting streams and collecting their result in files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_folder

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State processors keep their state in RocksDB, on disk and checkpointed to shared storage."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def event_stream(spark: SparkSession, path: str, schema, ts: str = "ts",
                 files_per_trigger: int | None = None, pattern: str | None = None) -> DataFrame:
    """A parquet folder as a stream, with ``ts`` as a time a watermark accepts.

    ``pattern`` restricts it to matching file names.

    ``files_per_trigger`` bounds the intake of a batch: Spark slows down where a bounded queue
    would drop events.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path).withColumn(ts, F.col(ts).cast("timestamp"))


def new_checkpoint(spark: SparkSession) -> str:
    return f"{scratch_folder(spark)}/stream-{uuid.uuid4().hex}/state"


def run_to_table(stream: DataFrame, mode: str = "append", path: str | None = None,
                 checkpoint: str | None = None) -> DataFrame:
    """Run everything now available into a parquet folder and read that back.

    With the same ``path`` and ``checkpoint`` a later call continues where this one stopped.
    """
    spark = stream.sparkSession
    base = f"{scratch_folder(spark)}/stream-{uuid.uuid4().hex}"
    path = path or f"{base}/out"
    query = (stream.writeStream.outputMode(mode).format("parquet")
             .option("path", path).option("checkpointLocation", checkpoint or f"{base}/state")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def run_batches(stream: DataFrame, handle, checkpoint: str | None = None, mode: str = "append") -> None:
    """Run everything now available through ``handle(batch, batch_id)``."""
    where = checkpoint or new_checkpoint(stream.sparkSession)
    (stream.writeStream.outputMode(mode).foreachBatch(handle).option("checkpointLocation", where)
     .trigger(availableNow=True).start().awaitTermination())
