"""What several document operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import tune

#: ASCII letters, for lower-casing that leaves every other character alone.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: A word of the operators that split at ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """The settings that the document operators run under."""
    tune(spark)
    # Texts can be long: a Python worker gets few of them at a time, and few bytes.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def pick(docs: DataFrame, id_col: str, text_col: str, null_text: str | None = "") -> DataFrame:
    """(doc_id, text) under fixed names; other columns, whatever their names, are left behind.

    A null text becomes ``null_text`` (None: it stays null).
    """
    text = docs[text_col].cast("string")
    if null_text is not None:
        text = F.coalesce(text, F.lit(null_text))
    return docs.select(docs[id_col].alias("doc_id"), text.alias("text"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def settled(df: DataFrame) -> DataFrame:
    """``df`` with its columns computed for good.

    A filter above would otherwise be pushed below the projections, with their expressions copied into
    it, also into lambdas, where they would run once per element. Generated columns stop that.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores added as it takes not to be a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def remainder(id_: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % divisor


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary file ``name`` lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def per_worker(key: tuple, make: Callable):
    """``make()``, made once in each Python worker process and kept for its later tasks.

    Functions travel to workers by value, so their own globals last one task only. Keys come from
    a query's few parameters (file names), never from data.
    """
    home = sys.modules.setdefault("tidewatch_worker_state", types.ModuleType("tidewatch_worker_state"))
    kept = home.__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def tiktoken_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> rank, from a .tiktoken file."""
    import base64

    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
