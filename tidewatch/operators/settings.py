"""Settings tables (scope, key, value): selection, overlay, references, defaults, types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import host_of, split_list, trim_all
from ..session import written
from .ordered import Ordered

# Key prefixes with a meaning of their own.
ENVIRONMENT_PREFIX = "spark.executorEnv."
HADOOP_PREFIX = "spark.hadoop."
LOG_URL_PREFIX = "SPARK_LOG_URL_"
STARTUP_PREFIXES = ("akka.", "spark.akka", "spark.auth", "spark.ssl")

# Renamed and dropped keys (old key, new key, since).
DEPRECATED_KEYS = (
    ("spark.files.userClassPathFirst", "spark.executor.userClassPathFirst", "1.3"),
    ("spark.yarn.user.classpath.first", None, "1.3"),
)

# Pattern of a reference, with optional provider prefix.
REFERENCE = r"\$\{(?:(\w+?):)?(\S+?)\}"

# Time units in microseconds, byte units in bytes.
TIME_UNITS = {"us": 1, "ms": 1_000, "s": 1_000_000, "m": 60_000_000, "min": 60_000_000,
              "h": 3_600_000_000, "d": 86_400_000_000}
#: The largest 64-bit number.
LARGEST = (1 << 63) - 1
BYTE_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30,
              "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40, "p": 1 << 50, "pb": 1 << 50}


def prefix_settings(df: DataFrame, prefix: str, lower: bool = False, key: str = "key"
                    ) -> DataFrame:
    """Settings whose key has the prefix, with it removed (and optionally lower-cased)."""
    rest = F.substring(F.col(key), F.lit(len(prefix) + 1), F.length(key))
    return df.filter(F.startswith(F.col(key), F.lit(prefix))).withColumn(
        key, F.lower(rest) if lower else rest)


def is_port_key(key: Column) -> Column:
    """``spark.*.port`` or ``spark.port.*``."""
    return ((F.startswith(key, F.lit("spark.")) & F.endswith(key, F.lit(".port")))
            | F.startswith(key, F.lit("spark.port.")))


def is_startup_key(key: Column) -> Column:
    """Keys a process needs before it can fetch the others."""
    hit = is_port_key(key)
    for prefix in STARTUP_PREFIXES:
        hit = hit | F.startswith(key, F.lit(prefix))
    return hit


def settings_class(key: Column) -> Column:
    return (F.when(is_port_key(key), "port").when(is_startup_key(key), "startup")
            .otherwise("other"))


def overlay_settings(local: DataFrame, remote: DataFrame, scope: Sequence[str],
                     key: str = "key", value: str = "value") -> DataFrame:
    """Merge fetched settings into local ones.

    Startup keys keep a local value; every other key takes the remote one.
    """
    names = [*scope, key]
    merged = (local.select(*names, F.col(value).alias("__local"))
              .join(remote.select(*names, F.col(value).alias("__remote")), names, "full_outer"))
    mine, theirs = F.col("__local"), F.col("__remote")
    return merged.select(*names, F.when(is_startup_key(F.col(key)), F.coalesce(mine, theirs))
                         .otherwise(F.coalesce(theirs, mine)).alias(value))


def config_dir_merge(files: DataFrame, scope: Sequence[str], name: str = "file_name",
                     priority: str = "priority", conf_dir: int = 0) -> DataFrame:
    """One file per name, from the source with the lowest priority number.

    Of the first source (``conf_dir``) only ``*.xml`` files take part.
    """
    usable = files.filter((F.col(priority) != conf_dir)
                          | F.endswith(F.col(name), F.lit(".xml")))
    first = Window.partitionBy(*scope, name).orderBy(priority)
    return (usable.withColumn("__rn", F.row_number().over(first))
            .filter(F.col("__rn") == 1).drop("__rn"))


def exclusion_union(*sets: DataFrame) -> DataFrame:
    result = sets[0]
    for other in sets[1:]:
        result = result.unionByName(other)
    return result.distinct()


def exclusion_diff(current: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Additions and removals that turn ``current`` into ``wanted``, sorted."""
    added = wanted.distinct().join(current, list(keys), "left_anti").withColumn(
        "change", F.lit("add"))
    removed = current.distinct().join(wanted, list(keys), "left_anti").withColumn(
        "change", F.lit("remove"))
    return added.unionByName(removed).orderBy("change", *keys)


def deprecated_table(spark) -> DataFrame:
    rows = [F.struct(F.lit(old).alias("old_key"), F.lit(new).cast("string").alias("new_key"),
                     F.lit(since).alias("since")) for old, new, since in DEPRECATED_KEYS]
    return spark.range(1).select(F.inline(F.array(*rows)))


def translate_keys(df: DataFrame, deprecated: DataFrame, key: str = "key"
                   ) -> tuple[DataFrame, DataFrame]:
    """Settings under their current keys, and one warning per deprecated key in use."""
    known = deprecated.withColumnRenamed("old_key", key)
    joined = df.join(known, key, "left")
    renamed = (joined.withColumn(key, F.coalesce("new_key", key))
               .drop(*[c for c in known.columns if c != key]))
    warnings = joined.filter(F.col("since").isNotNull()).select(
        F.col(key), "new_key", "since").distinct()
    return renamed, warnings


# ---------------------------------------------------------------- references

def resolve_references(settings: DataFrame, scope: str = "scope", key: str = "key",
                       value: str = "value", providers: Mapping[str, DataFrame] | None = None,
                       definitions: DataFrame | None = None) -> DataFrame:
    """Replace ``${name}`` and ``${prefix:name}`` by the referenced values, recursively.

    Plain names see the ``spark.*`` keys of their scope; each entry of ``providers`` (for
    example ``env`` and ``system``) is a (scope, key, value) table for one prefix. A plain name
    without a setting takes its fallback's value or its default from ``definitions`` (key, default,
    fallback). References to nothing stay as text. Keys that lead into a cycle keep their text
    and get an ``error``. Keys must be unique per scope.

    A round replaces each reference by what its target holds by then, references included, so the
    depth of all chains halves: the number of rounds is the logarithm of the longest chain.
    """
    nodes = settings.select(F.col(scope).alias("scope"), F.concat(F.lit(":"), F.col(key)).alias("name"),
                            F.col(key).alias("key"), F.col(value).alias("value"))
    own = written(nodes.withColumn("parts", _parts(F.col("value"))))
    targets = own.filter(F.startswith(F.col("key"), F.lit("spark."))).drop("key")
    for prefix, table in (providers or {}).items():
        targets = targets.unionByName(table.select(
            F.col(scope).alias("scope"), F.concat(F.lit(f"{prefix}:"), F.col(key)).alias("name"),
            F.col(value).alias("value")).withColumn("parts", _parts(F.col("value"))))
    if definitions is not None:
        targets = _with_defaults(own, targets, definitions)
    edges = _references(targets).join(targets.select("scope", F.col("name").alias("to")), ["scope", "to"])
    endless = written(_endless(edges, ["scope"], "name", "to"))
    known = targets.select("scope", "name", "parts").join(endless, ["scope", "name"], "left_anti")
    start = own.filter(~F.startswith(F.col("key"), F.lit("spark.")))
    # Settings that nothing can refer to are resolved once all others are. Only what is open is stored anew.
    texts, open_texts = known.filter(~_has_references()), written(known.filter(_has_references()))
    while not open_texts.isEmpty():
        fresh = written(_substituted(open_texts, texts.unionByName(open_texts)))
        texts, open_texts = texts.unionByName(fresh.filter(~_has_references())), fresh.filter(_has_references())
    lost = _references(start).join(endless.withColumnRenamed("name", "to"), ["scope", "to"]).select(
        "scope", "name").distinct().unionByName(endless)
    hidden = start.filter(_has_references())
    done = texts.unionByName(_substituted(hidden, texts)).unionByName(
        start.filter(~_has_references()).select("scope", "name", "parts"))
    plain = done.select("scope", "name", F.array_join(F.col("parts.text"), "").alias("text"))
    result = (own.join(plain, ["scope", "name"], "left")
              .join(lost.withColumn("lost", F.lit(True)), ["scope", "name"], "left"))
    return result.select(
        F.col("scope").alias(scope), F.col("key").alias(key),
        F.when(F.col("lost"), F.col("value")).otherwise(F.coalesce("text", "value")).alias(value),
        F.when(F.col("lost"), F.concat(F.lit("Circular reference in "), F.col("value"))).alias("error"))


def _parts(value: Column) -> Column:
    """The value as an array of (text, to): plain text, or a reference to the name ``to``."""
    pieces = F.split(value, REFERENCE, -1)

    def pair(ref: Column, i: Column) -> Column:
        name = F.concat(F.regexp_extract(ref, REFERENCE, 1), F.lit(":"), F.regexp_extract(ref, REFERENCE, 2))
        return F.array(_part(F.get(pieces, i), F.lit(None).cast("string")), _part(ref, name))

    refs = F.regexp_extract_all(value, F.lit(REFERENCE), F.lit(0))
    return F.concat(F.flatten(F.transform(refs, pair)),
                    F.array(_part(F.element_at(pieces, -1), F.lit(None).cast("string"))))


def _part(text: Column, to: Column) -> Column:
    return F.struct(text.alias("text"), to.alias("to"))


def _has_references() -> Column:
    return F.exists("parts", lambda p: p["to"].isNotNull())


def _references(nodes: DataFrame) -> DataFrame:
    """(scope, name, to) for each reference of ``nodes``."""
    return (nodes.select("scope", "name", F.explode("parts").alias("part"))
            .select("scope", "name", F.col("part.to").alias("to")).filter("to IS NOT NULL"))


def _substituted(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """``nodes`` with the parts of ``texts`` in place of references; one to nothing becomes text.

    Only references are joined: plain text has no key, and would all come to one task. Texts that come to
    stand side by side become one part, so a value has no more than two parts for each of its references, and one.
    """
    found = texts.select("scope", F.col("name").alias("to"), F.col("parts").alias("held"))
    rows = (nodes.select("scope", "name", F.posexplode("parts").alias("pos", "part"))
            .withColumn("to", F.col("part.to")))
    own = F.array(_part(F.col("part.text"), F.lit(None).cast("string")))
    replaced = rows.filter("to IS NOT NULL").join(found, ["scope", "to"], "left").select(
        "scope", "name", "pos", F.coalesce("held", own).alias("held"))
    kept = rows.filter("to IS NULL").select("scope", "name", "pos", own.alias("held"))
    # The parts of one value are collected: bounded by the length of that value.
    return (replaced.unionByName(kept).groupBy("scope", "name").agg(
        F.sort_array(F.collect_list(F.struct("pos", "held"))).alias("all"))
            .select("scope", "name", F.flatten(F.col("all.held")).alias("parts"))
            .withColumn("parts", _joined(F.col("parts"))))


def _joined(parts: Column) -> Column:
    """``parts`` with one text, which may be empty, before, between and after the references."""
    refs = F.filter(F.sequence(F.lit(0), F.size(parts)), lambda i: F.get(parts, i)["to"].isNotNull())

    def up_to(stop: Column, n: Column) -> Column:
        start = F.coalesce(F.get(refs, n - 1) + 1, F.lit(0))
        text = F.array_join(F.slice(parts, start + 1, stop - start)["text"], "")
        return F.concat(F.array(_part(text, F.lit(None).cast("string"))), F.slice(parts, stop + 1, 1))

    return F.flatten(F.transform(F.concat(refs, F.array(F.size(parts))), up_to))


def _endless(edges: DataFrame, scope: list[str], at: str, to: str) -> DataFrame:
    """(*scope, at) of the nodes from which a walk along ``edges`` never ends.

    A round drops the edges to nodes that no edge leaves, and leads edges to a node that one edge leaves on
    to where that one goes. So chains halve, layers with many edges go one by one, and there are never more
    edges than at first. What is left once nothing ends has only walks without an end.
    """
    edges = written(edges.select(*scope, at, to).distinct())
    before = edges.count()
    while True:
        goes = edges.groupBy(*scope, F.col(at).alias(to)).agg(F.min(to).alias("__low"), F.max(to).alias("__high"))
        left = edges.join(goes, [*scope, to])
        edges = written(left.select(*scope, at, F.when(F.col("__low") == F.col("__high"), F.col("__low"))
                                    .otherwise(F.col(to)).alias(to)))
        after = edges.count()
        if after == before:
            return edges.select(*scope, at).distinct()
        before = after


def _with_defaults(own: DataFrame, targets: DataFrame, definitions: DataFrame) -> DataFrame:
    """``targets`` and a node for each name that is referred to, not set, and defined with a default or
    with a fallback that has a value; defaults may refer to further such names."""
    paths = fallback_paths(definitions)
    at = paths.places.select("key", "path", "depth")
    fresh = own.select("scope", "name", "parts").unionByName(targets.select("scope", "name", "parts"))
    while True:
        missing = (_references(fresh).select("scope", F.col("to").alias("name")).distinct()
                   .join(targets.select("scope", "name"), ["scope", "name"], "left_anti")
                   .filter(F.startswith(F.col("name"), F.lit(":")))
                   .select("scope", F.substring("name", 2, F.length("name")).alias("key")))
        held = targets.filter(F.startswith(F.col("name"), F.lit(":"))).select(
            "scope", F.substring("name", 2, F.length("name")).alias("key"), F.col("value").alias("found"))
        known = missing.join(paths.places.filter(~F.col("circular")).select("key"), "key")
        found = first_along(known, held.join(at, "key").select("scope", "path", "depth", "found"), paths, "scope")
        value = F.coalesce("found", "default")
        fresh = written(found.filter(value.isNotNull()).select(
            "scope", F.concat(F.lit(":"), F.col("key")).alias("name"), value.alias("value"), _parts(value).alias("parts")))
        if fresh.isEmpty():
            return targets
        targets = written(targets.unionByName(fresh))


# ---------------------------------------------------------------- defaults

@dataclass
class Paths:
    """The fallbacks of keys as paths. ``places`` (key, path, depth, up, default, circular): a key's path, named by its
    last key, how many steps before that key it stands, the key the last one falls back to on another path, and
    the default at the end of its fallbacks. ``joined``: whether any path has such a key."""

    places: DataFrame
    joined: bool


def _by_shuffle(keys: DataFrame) -> DataFrame:
    """``keys`` for a join that does not broadcast them. There are as many as settings are defined, and their
    files are small enough for a broadcast long after the rows in them have become too many for the driver."""
    return keys.hint("merge")


def fallback_paths(definitions: DataFrame) -> Paths:
    """A key without a default falls back to its defined fallback. Of the keys that share a fallback the one that
    most keys lead to goes on in its path, so from any key there are at most a logarithm of paths to the end.
    All is found by walks of 1, 2, 4, ... fallbacks: rows in number of the keys, the logarithm of the
    longest chain often. Keys whose fallbacks run in a circle, or into one, are paths of their own.
    """
    keys = definitions.select("key", "default")
    links = (definitions.filter(F.col("fallback").isNotNull() & F.col("default").isNull()).select("key", "fallback")
             .join(_by_shuffle(definitions.select(F.col("key").alias("fallback"))), "fallback"))
    walks = _walks(links)
    circular = F.col("steps") == _full(walks)
    ends = walks[-1].filter(~circular)
    joined = not ends.groupBy("fallback").count().filter("count > 1").isEmpty()
    end = keys.filter(F.col("default").isNotNull()).select(F.col("key").alias("to"), F.col("default").alias("last"))
    places = (keys.join(_by_shuffle(walks[-1].join(_by_shuffle(end), "to", "left")), "key", "left")
              .select("key", F.when(~circular, F.col("to")).otherwise(F.col("key")).alias("path"),
                      F.when(~circular, F.col("steps")).otherwise(0).alias("depth"), F.lit(None).cast("string").alias("up"),
                      F.coalesce("default", "last").alias("default"), F.coalesce(circular, F.lit(False)).alias("circular")))
    if joined:
        size = keys.select("key", F.lit(1).cast("bigint").alias("size"))
        for i, walk in enumerate(walks[:-1]):
            jump = walk.filter(F.col("steps") == 1 << i).select("key", "to")
            more = size.join(_by_shuffle(jump), "key").groupBy(F.col("to").alias("key")).agg(F.sum("size").alias("more"))
            size = written(size.join(_by_shuffle(more), "key", "left").select(
                "key", (F.col("size") + F.coalesce("more", F.lit(0))).alias("size")))
        heavy = written(ends.join(_by_shuffle(size), "key").groupBy("fallback").agg(
            F.max(F.struct("size", "key")).alias("best")).select(F.col("best.key").alias("key"), "fallback"))
        along = _walks(heavy)[-1].select("key", F.col("to").alias("path"), F.col("steps").alias("depth"))
        above = ends.join(_by_shuffle(heavy), "key", "left_anti").select(F.col("key").alias("path"), F.col("fallback").alias("up"))
        places = (places.drop("path", "depth", "up").join(_by_shuffle(along), "key", "left")
                  .select("key", F.coalesce("path", "key").alias("path"),
                          F.coalesce("depth", F.lit(0).cast("bigint")).alias("depth"), "default", "circular")
                  .join(_by_shuffle(above), "path", "left"))
    return Paths(written(places), joined)


def _walks(links: DataFrame) -> list[DataFrame]:
    """(key, fallback, to, steps) for each of ``links`` (key, fallback): the place after 1, 2, 4, ... steps, or the
    end if that is nearer. In the last table, walks of ``_full`` steps are those without an end: were there one
    that ends, a place on it had between half as many steps left and all, and those would have become fewer.
    """
    walks = [written(links.select("key", "fallback", F.col("fallback").alias("to"), F.lit(1).cast("bigint").alias("steps")))]
    before, left = -1, walks[0].count()
    while left not in (0, before):
        ahead = walks[-1].select(F.col("key").alias("to"), F.col("to").alias("next"), F.col("steps").alias("more"))
        walks.append(written(walks[-1].join(_by_shuffle(ahead), "to", "left").select(
            "key", "fallback", F.coalesce("next", "to").alias("to"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"))))
        before, left = left, walks[-1].filter(F.col("steps") == _full(walks)).count()
    return walks


def _full(walks: list[DataFrame]) -> int:
    return 1 << len(walks) - 1


def first_along(asked: DataFrame, held: DataFrame, paths: Paths, scope: str) -> DataFrame:
    """(scope, key, found, default, circular) of ``asked`` (scope, key): the first of the ``held`` (scope, path, depth,
    found) along the fallbacks of the key, the least one of a place, null if there is none.

    A path's places and held values are put in order of depth, where a value is the last one at or before a
    place; what finds none goes on to the path above.
    """
    held = written(held)
    pending = written(asked.select(scope, "key").distinct().join(_by_shuffle(paths.places), "key"))
    kind, done = held.schema["found"].dataType, None
    while True:
        rows = held.unionByName(pending.withColumn("found", F.lit(None).cast(kind)), allowMissingColumns=True)
        steps = Ordered(rows, [scope, "path"], ["depth", "found desc", "key"]).last_known("near", F.col("found")).df
        looked = steps.filter(F.col("key").isNotNull()).select(scope, "key", "up", F.col("near").alias("found"), "default", "circular")
        if not paths.joined:
            return looked.drop("up")
        looked = written(looked)
        open_ = F.col("found").isNull() & F.col("up").isNotNull()
        last = looked.filter(~open_).drop("up")
        done = last if done is None else done.unionByName(last)
        onward = paths.places.select(F.col("key").alias("__up"), "path", "depth", F.col("up").alias("__next"))
        pending = written(looked.filter(open_).select(scope, "key", F.col("up").alias("__up"), "default", "circular")
                          .join(_by_shuffle(onward), "__up").withColumnRenamed("__next", "up").drop("__up"))
        if pending.isEmpty():
            return done


def effective_settings(requested: DataFrame, definitions: DataFrame, settings: DataFrame,
                       scope: str = "scope") -> DataFrame:
    """Effective value per requested (scope, key), the key it came from (``source``), and ``error`` if
    there is no value because the fallbacks run in a circle.

    ``definitions`` has key, alternatives (array), default and fallback (another key). A key's own
    name comes first, then its alternatives, then the same for its fallback, at last the default. A key whose
    fallbacks run in a circle has its own names only.
    """
    paths = fallback_paths(definitions)
    names = (definitions.select("key", "alternatives").join(_by_shuffle(paths.places.select("key", "path", "depth")), "key")
             .select("path", "depth", F.posexplode(F.array_prepend(F.coalesce(
                 "alternatives", F.array().cast("array<string>")), F.col("key"))).alias("place", "candidate")))
    set_ = settings.filter(F.col("value").isNotNull()).select(scope, F.col("key").alias("candidate"), "value")
    held = set_.join(_by_shuffle(names), "candidate").select(
        scope, "path", "depth", F.struct("place", "candidate", "value").alias("found"))
    found = first_along(requested, held, paths, scope)
    value = F.coalesce("found.value", "default")
    return found.select(
        scope, "key", value.alias("value"),
        F.when(F.col("found").isNotNull(), F.col("found.candidate"))
        .when(F.col("default").isNotNull(), "default").alias("source"),
        F.when(value.isNull() & F.col("circular"), "circular fallback").alias("error"))


# ---------------------------------------------------------------- types

def _number_and_unit(text: Column) -> tuple[Column, Column]:
    clean = F.lower(trim_all(text))
    pattern = r"^(-?[0-9]+)([a-z]*)$"
    return (F.regexp_extract(clean, pattern, 1).try_cast("bigint"), F.regexp_extract(clean, pattern, 2))


def _factor(unit: Column, units: Mapping[str, int], default_unit: str) -> Column:
    """The size of the unit; null if there is no such unit."""
    factor = F.when(unit == "", F.lit(units[default_unit]))
    for name, size in units.items():
        factor = factor.when(unit == name, F.lit(size))
    return factor.cast("bigint")


def time_ms(text: Column, default_unit: str = "ms") -> Column:
    """``30s`` to milliseconds, null if it is no time.

    Smaller units are cut towards zero; times beyond a 64-bit number become the largest one.
    """
    number, unit = _number_and_unit(text)
    size = _factor(unit, TIME_UNITS, default_unit)
    per_ms = F.lit(TIME_UNITS["ms"]).cast("bigint")
    larger = F.coalesce(F.try_multiply(number, F.call_function("div", size, per_ms)),
                        F.when(number > 0, F.lit(LARGEST)).otherwise(F.lit(-LARGEST - 1)))
    return (F.when(number.isNull() | size.isNull(), F.lit(None).cast("bigint"))
            .when(size >= per_ms, larger)
            .otherwise(F.call_function("div", number, F.call_function("div", per_ms, size))))


def byte_size(text: Column, default_unit: str = "b") -> Column:
    """``4k`` to bytes (1024-based, a leading minus is kept), null if it is no size."""
    number, unit = _number_and_unit(text)
    return F.try_multiply(number, _factor(unit, BYTE_UNITS, default_unit))


def typed_settings(settings: DataFrame, type_col: str = "type", key: str = "key",
                   value: str = "value") -> DataFrame:
    """Parsed values: ``number`` (int, long, time in ms, bytes), ``real``, ``flag``, ``items``.

    A value that does not fit its type gets an ``error`` of the form
    ``key should be <type>, but was <value>``.
    """
    kind, raw = F.col(type_col), F.col(value)
    text = trim_all(raw)
    number = (F.when(kind == "int", text.try_cast("int").cast("bigint"))
              .when(kind == "long", text.try_cast("bigint"))
              .when(kind == "time", time_ms(raw)).when(kind == "bytes", byte_size(raw)))
    whole = F.when(text.rlike(r"^[+-]?[0-9]+$"), number)
    number = F.when(kind.isin("int", "long"), whole).otherwise(number)
    real = F.when(kind == "double", text.try_cast("double"))
    flag = F.when((kind == "boolean") & F.lower(text).isin("true", "false"),
                  F.lower(text) == "true")
    items = F.when(kind == "sequence", split_list(raw))
    fits = (F.coalesce(number.cast("string"), real.cast("string"), flag.cast("string"))
            .isNotNull() | kind.isin("sequence", "string", "regex"))
    return (settings.withColumn("number", number).withColumn("real", real)
            .withColumn("flag", flag).withColumn("items", items)
            .withColumn("error", F.when(~fits, F.concat(
                F.col(key), F.lit(" should be "), kind, F.lit(", but was "), raw))))


# ---------------------------------------------------------------- validation

def checked(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``df`` with ``errors``: the messages of all rules that a row breaks, in one pass.

    ``rules`` maps a message to the condition a row must meet; a null condition is broken.
    """
    messages = F.filter(F.array(*[
        F.when(~F.coalesce(condition, F.lit(False)), F.lit(message))
        for message, condition in rules.items()]), lambda m: m.isNotNull())
    return df.withColumn("errors", messages)


def validate(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of ``checked``; each frame that is used reads ``df``."""
    rows = checked(df, rules)
    return rows.filter(F.size("errors") == 0).drop("errors"), rows.filter(F.size("errors") > 0)


def allowed(column: Column, values: Sequence) -> Column:
    return column.isin(*values)


def is_host(column: Column) -> Column:
    """A bare host name, without a colon."""
    return ~F.contains(column, F.lit(":"))


def is_host_port(column: Column) -> Column:
    return F.contains(column, F.lit(":"))


def host_part(column: Column) -> Column:
    return host_of(column)
