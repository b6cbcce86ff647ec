"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows one task may hold when the order of a key's rows matters. A key with more rows is
#: spread over several tasks (``operators.ordered``).
ROWS_PER_TASK = 2_000_000
ROWS_PER_TASK_CONF = "spark.tidewatch.rowsPerTask"

#: Largest side, in rows, that the library broadcasts on its own account.
BROADCAST_ROWS = 500_000

#: Most chunks such a table is cut into: their carry tables, of a row per chunk, are broadcast. Only a table
#: of over a million million rows has larger chunks, which then spill to disk.
MAX_CHUNKS = BROADCAST_ROWS

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Joins split a hot key's rows over several tasks, also below an aggregation on that key.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Stream sessions of a key are merged before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

_OWN_FOLDERS: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library relies on (time zone, adaptive skew joins)."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def rows_per_task(spark: SparkSession) -> int:
    return int(spark.conf.get(ROWS_PER_TASK_CONF, str(ROWS_PER_TASK)))


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own, which goes when the process ends; on
    a cluster every executor must see the folder, so an unset value is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN_FOLDERS:
            _OWN_FOLDERS[app] = tempfile.mkdtemp(prefix="tidewatch-")
            atexit.register(shutil.rmtree, _OWN_FOLDERS[app], ignore_errors=True)
        folder = _OWN_FOLDERS[app]
    return folder


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back.

    Several later branches then read the same stored rows, and a lost executor costs a re-read
    of a file, not a new range sampling with other bounds.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/tidewatch/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``limit`` rows, found without counting beyond the limit."""
    return df.limit(limit + 1).count() <= limit
