"""Typed JSON event logs: parse by the ``Event`` property, route by type, keep bad rows apart."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DISCRIMINATOR = "Event"
CORRUPT = "_corrupt_record"


def store_by_type(lines: DataFrame, path: str, body: str = "value",
                  discriminator: str = DISCRIMINATOR, type_col: str = "event_type") -> DataFrame:
    """Write the lines once, partitioned by event type, and read them back.

    ``parse_events`` with the same ``type_col`` then reads only the partition of each type, where
    it would otherwise pass over the whole log once per type.
    """
    (lines.withColumn(type_col, F.get_json_object(body, f"$.{discriminator}"))
     .write.partitionBy(type_col).parquet(path))
    return lines.sparkSession.read.parquet(path)


def parsed_events(lines: DataFrame, schemas: Mapping[str, StructType | str], body: str = "value",
                  discriminator: str = DISCRIMINATOR, type_col: str | None = None) -> DataFrame:
    """JSON lines parsed in one pass, each by the schema of its type.

    Columns: those of ``lines`` other than ``body``, ``event`` (the type), one struct per type (null in
    rows of other types), and for quarantined lines ``reason`` and the ``line`` itself.
    """
    kept = [c for c in lines.columns if c not in (body, type_col)]
    kind = F.col(type_col) if type_col else F.get_json_object(body, f"$.{discriminator}")
    tagged = lines.select(*kept, F.col(body).alias("__line"), kind.alias("event"))
    bodies, good = {}, F.lit(False)
    for name, schema in schemas.items():
        shape = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        checked = StructType(list(shape.fields)).add(CORRUPT, "string")
        bodies[name] = F.when(F.col("event") == name, F.from_json("__line", checked, {
            "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    parsed = tagged.withColumns(bodies)
    for name in schemas:
        good = good | (F.col(name).isNotNull() & F.col(f"`{name}`.{CORRUPT}").isNull())
    reason = (F.when(F.col("event").isNull(), "no event type")
              .when(~F.col("event").isin(*schemas), "unknown event type")
              .when(~F.coalesce(good, F.lit(False)), "does not fit its type"))
    parsed = parsed.withColumn("reason", reason)
    fits = F.col("reason").isNull()
    return parsed.select(*kept, "event", *[
        F.when(fits, F.col(f"`{n}`").dropFields(CORRUPT)).alias(n) for n in schemas],
        "reason", F.when(~fits, F.col("__line")).alias("line"))


def parse_events(lines: DataFrame, schemas: Mapping[str, StructType | str],
                 body: str = "value", discriminator: str = DISCRIMINATOR,
                 type_col: str | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """``parsed_events`` as one typed frame per event type and a quarantine frame.

    The quarantine frame holds lines without a known type and lines that do not fit the schema
    of their type, with a ``reason``. Each typed frame keeps the columns of ``lines``
    other than ``body``. Each frame that is used reads the lines; to read them once, use
    ``parsed_events`` or store them by type first.
    """
    kept = [c for c in lines.columns if c not in (body, type_col)]
    parsed = parsed_events(lines, schemas, body, discriminator, type_col)
    typed = {}
    for name, schema in schemas.items():
        shape = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        rows = parsed.filter((F.col("event") == name) & F.col("reason").isNull())
        typed[name] = rows.select(*kept, *[F.col(f"`{name}`.`{f.name}`") for f in shape.fields])
    return typed, parsed.filter(F.col("reason").isNotNull()).select(*kept, "line", "reason")


def read_event_log(spark: SparkSession, path: str, schemas: Mapping[str, StructType | str],
                   discriminator: str = DISCRIMINATOR
                   ) -> tuple[dict[str, DataFrame], DataFrame]:
    """``parse_events`` over the text lines below ``path``."""
    return parse_events(spark.read.text(path), schemas, discriminator=discriminator)


def read_parsed_events(spark: SparkSession, path: str, schemas: Mapping[str, StructType | str],
                       discriminator: str = DISCRIMINATOR) -> DataFrame:
    """``parsed_events`` over the text lines below ``path``: one pass, quarantine included."""
    return parsed_events(spark.read.text(path), schemas, discriminator=discriminator)


def route_columns(df: DataFrame, type_col: str, handlers: Mapping[str, Mapping[str, Column]],
                  keep: list[str], other: Mapping[str, Column] | None = None) -> DataFrame:
    """One pass over all types: ``route``, the kept columns, and each handler's columns.

    A handler maps column names to expressions; a column that a type's handler lacks is null.
    Types without a handler have the route ``other``.
    """
    kind = F.col(type_col)
    other = other or {}
    columns = list(dict.fromkeys(c for h in [*handlers.values(), other] for c in h))
    known = F.coalesce(kind.isin(*handlers), F.lit(False))
    out = []
    for column in columns:
        value = F.when(~known, other.get(column, F.lit(None)))
        for name, handler in handlers.items():
            value = value.when(kind == name, handler.get(column, F.lit(None)))
        out.append(value.alias(column))
    return df.select(F.when(known, kind).otherwise("other").alias("route"), *keep, *out)


def route(df: DataFrame, type_col: str,
          handlers: Mapping[str, Callable[[DataFrame], DataFrame]],
          other: Callable[[DataFrame], DataFrame] = lambda d: d) -> dict[str, DataFrame]:
    """Apply one handler per event type; types without a handler go to ``other``."""
    routed = {name: handle(df.filter(F.col(type_col) == name))
              for name, handle in handlers.items()}
    unknown = F.col(type_col).isNull() | ~F.col(type_col).isin(*handlers)
    routed["other"] = other(df.filter(unknown))
    return routed


def fan_out(df: DataFrame, queues: list[str]) -> DataFrame:
    """Every row once per queue name (batch form; streams use ``streaming.sinks.fan_out``)."""
    names = F.array(*[F.lit(q) for q in queues])
    return df.withColumn("queue", F.explode(names))


def replay_then_tail(buffered: DataFrame, live: DataFrame, order: list[str]) -> DataFrame:
    """Buffered events first, then live ones, each in order; ``phase`` is 0 or 1."""
    return (buffered.withColumn("phase", F.lit(0))
            .unionByName(live.withColumn("phase", F.lit(1)))
            .orderBy("phase", *order))
