"""Lookups, tiered one-to-one matching, as-of lookups, path and graph relations."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.arrays import count_up
from ..session import rows_per_task, written
from .ordered import Ordered, largest_group

# Fixed value: mark of a skipped stage.
SKIPPED = " (skipped)"


def enrich_lookup(events: DataFrame, entities: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Events with their entity's columns; events of unknown entities are dropped."""
    return events.join(entities, list(keys))


def unknown_heartbeats(beats: DataFrame, registered: DataFrame, keys: Sequence[str]) -> DataFrame:
    return beats.join(registered.select(*keys).distinct(), list(keys), "left_anti")


def marked_known(wanted: DataFrame, known: DataFrame, keys: Sequence[str], name: str = "known") -> DataFrame:
    """``wanted`` with a flag whether ``known`` has its keys, in one pass over both."""
    ids = known.select(*keys).distinct().withColumn(name, F.lit(True))
    return wanted.join(ids, list(keys), "left").withColumn(name, F.coalesce(name, F.lit(False)))


def known_unknown_split(wanted: DataFrame, known: DataFrame, keys: Sequence[str]
                        ) -> tuple[DataFrame, DataFrame]:
    ids = known.select(*keys).distinct()
    return (wanted.join(ids, list(keys), "left_semi"), wanted.join(ids, list(keys), "left_anti"))


def alive_filter(members: DataFrame, pending_removal: DataFrame, pending_loss: DataFrame,
                 keys: Sequence[str]) -> DataFrame:
    """Members neither pending removal nor awaiting a loss reason."""
    gone = pending_removal.select(*keys).unionByName(pending_loss.select(*keys)).distinct()
    return members.join(gone, list(keys), "left_anti")


def tiered_match(grants: DataFrame, requests: DataFrame, tiers: Sequence[tuple[str, Sequence[str]]],
                 grant_id: str, request_id: str, grant_order: Sequence[str],
                 request_order: Sequence[str], scope: Sequence[str] = ()) -> DataFrame:
    """One-to-one match of grants to requests, tier by tier; (grant, request, tier).

    A tier is (name, key columns), for example ``("host", ["host_id"])``, ``("rack", ["rack_id"])``
    and ``("any", [])``. A request that accepts several keys has a row for each of them; its order columns
    are the same on all. Within a tier each grant, in order, takes the first request in order that
    accepts its key and is not taken yet. What is left goes to the next tier; grants left at the
    end come back with the tier ``released``.

    Where a tier's requests have one key each, the n-th grant of a key takes the n-th request of the
    same key, so the join key is unique and no key is hot. Otherwise ``several_keys`` decides.
    """
    grant_columns = list(dict.fromkeys([*scope, grant_id, *grant_order,
                                        *[k for _, keys in tiers for k in keys]]))
    request_columns = list(dict.fromkeys([*scope, request_id, *request_order,
                                          *[k for _, keys in tiers for k in keys]]))
    open_grants = written(grants.select(*grant_columns))
    open_requests = written(requests.select(*request_columns))
    matched = []
    for position, (name, keys) in enumerate(tiers):
        by = [*scope, *keys]
        present = F.lit(True)
        for k in keys:
            present = present & F.col(k).isNotNull()
        wanted = open_requests.filter(present).select(*dict.fromkeys([*by, request_id, *request_order])).distinct()
        single = wanted.groupBy(*scope, request_id).count().filter("count > 1").isEmpty()
        if single:
            g = (Ordered(open_grants.filter(present), by, grant_order).row_number("__rn").df
                 .select(*by, "__rn", grant_id))
            r = (Ordered(wanted, by, request_order).row_number("__rn").df
                 .select(*by, "__rn", request_id))
            pairs = g.join(r, [*by, "__rn"]).select(*scope, grant_id, request_id)
        else:
            pairs = several_keys(open_grants.filter(present), wanted, by, grant_id, request_id,
                                 grant_order, request_order, scope)
        pairs = written(pairs.withColumn("tier", F.lit(name)))
        matched.append(pairs)
        open_grants = written(open_grants.join(pairs, [*scope, grant_id], "left_anti"))
        if position < len(tiers) - 1:
            open_requests = written(open_requests.join(pairs, [*scope, request_id], "left_anti"))
    result = open_grants.select(
        *scope, grant_id, F.lit(None).cast(requests.schema[request_id].dataType)
        .alias(request_id), F.lit("released").alias("tier"))
    for pairs in matched:
        result = result.unionByName(pairs)
    return result


def several_keys(grants: DataFrame, wanted: DataFrame, by: Sequence[str], grant_id: str, request_id: str,
                 grant_order: Sequence[str], request_order: Sequence[str], scope: Sequence[str] = ()
                 ) -> DataFrame:
    """(scope, grant, request): each grant, in order, takes the first open request that lists its key.

    All requests would rather have an earlier grant, so this is the one stable matching, and proposals
    may be made in any order. The grants of a key want the same requests in the same order; so the
    i-th of them gets none before the i-th on the key's list, and none before what the grant before it
    gets. Every grant proposes to the place on the list it has come to, every request keeps its best
    proposal, and a refused grant moves on past the places whose requests have grants better than
    any refused one of its key; it pushes those behind it along. It ends when nothing is refused: after
    one round where requests do not compete, otherwise after as many as the longest chain of
    refusals. Keys of any size are numbered, searched and pushed through ``Ordered``. A scope whose rows suit
    one task is walked through there instead.
    """
    scope, by = list(scope), list(by)
    go, ro, i, place = "__grant", "__request", "__i", "__place"
    numbered = Ordered(grants, scope, grant_order).row_number(go).df
    request = Ordered(wanted.select(*dict.fromkeys([*scope, request_id, *request_order])).distinct(), scope,
                      request_order).row_number(ro).df.select(*scope, ro, request_id)
    named = wanted.select(*by, request_id).join(request, [*scope, request_id])
    limit = rows_per_task(grants.sparkSession)
    if max(largest_group(grants, scope)[1], largest_group(wanted, scope)[1]) <= limit:
        return _walked(numbered.select(*by, go, grant_id), named.select(*by, ro, request_id), scope,
                       by[len(scope):], go, ro, grant_id, request_id)
    grant = written(Ordered(numbered, by, [go]).row_number(i).df.select(*by, go, i, grant_id))
    lists = written(Ordered(named, by, [ro]).row_number(place).df.select(*by, place, ro, request_id))
    at = grant.select(*by, go, i, F.col(i).alias(place))
    best = None
    while True:
        made = written(at.join(lists.select(*by, place, ro), [*by, place]))
        offers = made.groupBy(*scope, ro).agg(F.min(go).alias("__best"))
        if best is not None:
            offers = offers.unionByName(best).groupBy(*scope, ro).agg(F.min("__best").alias("__best"))
        best = written(offers)
        judged = made.join(best, [*scope, ro])
        refused = written(judged.filter(F.col(go) > F.col("__best")).select(*by, go, i, place))
        if refused.isEmpty():
            return (judged.filter(F.col(go) == F.col("__best")).join(grant.select(*scope, go, grant_id), [*scope, go])
                    .join(lists.select(*scope, ro, request_id).distinct(), [*scope, ro])
                    .select(*scope, grant_id, request_id))
        # Places that are lost to every refused grant of the key are passed over at once.
        first = refused.groupBy(*by).agg(F.min(go).alias("__first"))
        taken = (lists.join(best, [*scope, ro], "left").join(first, by)
                 .withColumn("__free", F.when(F.col("__best").isNull() | (F.col("__best") >= F.col("__first")),
                                              F.col(place))))
        onward = Ordered(taken, by, [place]).next_known("__onward", F.col("__free")).df
        onward = onward.select(*by, (F.col(place) - 1).alias(place), F.coalesce("__onward", F.lit(2**62)).alias("__onward"))
        moved = refused.join(onward, [*by, place], "left").select(
            *by, go, F.coalesce("__onward", F.lit(2**62)).alias("__to"))
        steps = at.join(moved, [*by, go], "left").withColumn(
            "__lead", F.coalesce("__to", F.col(place)) - F.col(i))
        pushed = Ordered(steps, by, [i]).running("__far", F.max, F.col("__lead")).df
        at = written(pushed.select(*by, go, i, (F.col("__far") + F.col(i)).alias(place)))


def _walked(grants: DataFrame, lists: DataFrame, scope: list[str], keys: list[str], go: str, ro: str,
            grant_id: str, request_id: str) -> DataFrame:
    """``several_keys`` scope by scope, grant after grant."""
    names = [*scope, grant_id, request_id]
    shape = StructType([*[grants.schema[c] for c in [*scope, grant_id]], lists.schema[request_id]])

    def walk(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        theirs = theirs.sort_values(ro)
        waiting = {key: iter(rows) for key, rows in theirs.groupby(keys)[ro].agg(list).items()}
        ids = dict(zip(theirs[ro], theirs[request_id]))
        taken: set = set()
        pairs = []
        mine = mine.sort_values(go)
        for key, grant in zip(mine[keys].itertuples(index=False, name=None), mine[grant_id]):
            found = next((r for r in waiting.get(key[0] if len(key) == 1 else key, ()) if r not in taken), None)
            if found is not None:
                taken.add(found)
                pairs.append((grant, ids[found]))
        out = pd.DataFrame(pairs, columns=[grant_id, request_id])
        for c in scope:
            out[c] = mine[c].iloc[0] if len(mine) else None
        return out[names]

    one = F.lit(0).alias("__scope")
    whole = ["__scope", *scope]
    return (grants.select("*", one).groupBy(*whole).cogroup(lists.select("*", one).groupBy(*whole))
            .applyInPandas(walk, shape))


def last_seen_asof(ticks: DataFrame, beats: DataFrame, member: str, tick: str, ts: str
                   ) -> DataFrame:
    """For each (member, tick) the last beat at or before the tick, null before the first."""
    both = (beats.select(member, F.col(ts).alias("__at"), F.lit(0).alias("__tick"))
            .unionByName(ticks.select(member, F.col(tick).alias("__at"),
                                      F.lit(1).alias("__tick"))))
    seen = Ordered(both, [member], ["__at", "__tick"]).last_known(
        "last_seen", F.when(F.col("__tick") == 0, F.col("__at"))).df
    return (seen.filter(F.col("__tick") == 1)
            .select(member, F.col("__at").alias(tick), "last_seen"))


def check_ticks(df: DataFrame, member: str, ts: str, check_us: int, tick: str = "tick"
                ) -> DataFrame:
    """Check times (multiples of the interval) from each member's first to its last row."""
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    span = df.groupBy(member).agg(F.min(at).alias("a"), F.max(at).alias("b"))
    first = F.ceil(F.col("a") / check_us).cast("bigint")
    last = F.floor(F.col("b") / check_us).cast("bigint")
    return (count_up(span, first, last, "__n")
            .select(member, F.timestamp_micros(F.col("__n") * check_us).alias(tick)))


def zip_parallel_arrays(df: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """Parallel arrays to one row per position; arrays of unequal length give nulls."""
    kept = [c for c in df.columns if c not in arrays]
    return (df.select(*kept, F.posexplode(F.arrays_zip(*arrays)).alias("position", "__item"))
            .select(*kept, "position", *[F.col(f"__item.{a}").alias(a) for a in arrays]))


def to_parallel_arrays(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                       position: str = "position", block_size: int = 10_000) -> DataFrame:
    """Inverse of ``zip_parallel_arrays``: parallel arrays per key and ``block``.

    A key with more than ``block_size`` positions gives several rows, numbered by ``block``, so
    no array grows with the size of a key.
    """
    items = F.array_sort(F.collect_list(F.struct(position, *columns)))
    block = F.floor(F.col(position) / block_size).cast("bigint")
    grouped = df.groupBy(*keys, block.alias("block")).agg(items.alias("__items"))
    return grouped.select(*keys, "block", *[F.col(f"__items.{c}").alias(c) for c in columns])


def path_visibility(files: DataFrame, permissions: DataFrame, path: str = "path",
                    others: str = "others") -> DataFrame:
    """``PUBLIC`` if others may read the file and execute every directory above it.

    ``others`` is the octal digit for others (4 read, 1 execute). A path without an entry has no
    permission. Directories, each once, and files are put in path order: what lies below a directory
    follows it without a gap, up to a bound that is its path with the next character after the
    slash. A directory is closed to others if the highest bound of the closed ones before it lies beyond it,
    so one running maximum settles all levels, and no directory's files or children meet in a join.
    """
    parent = F.regexp_replace(F.col(path), r"/[^/]*$", "")
    parts = F.filter(F.split(parent, "/"), lambda p: p != "")
    named = files.withColumn("__parts", parts)
    # All directories from the root down to the file's own, as /, /a/, /a/b/.
    above = F.transform(F.sequence(F.lit(0), F.size("__parts")), lambda n: F.when(n == 0, "/").otherwise(
        F.concat(F.lit("/"), F.array_join(F.slice(F.col("__parts"), F.lit(1), n), "/"), F.lit("/"))))
    rights = permissions.select(F.col(path).alias("__path"), F.col(others).alias("__others"))
    may_enter = F.coalesce(F.col("__others").bitwiseAND(1) == 1, F.lit(False))
    folders = (named.select("__parts").distinct().select(F.explode(above).alias("__key")).distinct()
               .withColumn("__name", F.when(F.col("__key") == "/", "/").otherwise(F.rtrim(F.col("__key"), F.lit("/"))))
               .join(rights, F.col("__name") == F.col("__path"), "left")
               .select("__key", F.when(~may_enter, F.concat(F.rtrim(F.col("__key"), F.lit("/")), F.lit("0")))
                       .alias("__bound")))
    may_read = F.coalesce(F.col("__others").bitwiseAND(4) == 4, F.lit(False))
    own = (named.join(rights, F.col(path) == F.col("__path"), "left")
           .select(F.element_at(above, -1).alias("__key"), F.lit(None).cast("string").alias("__bound"),
                   F.struct(*files.columns).alias("__file"), may_read.alias("__read")))
    kind = own.schema["__file"].dataType
    rows = own.unionByName(folders.withColumns({"__file": F.lit(None).cast(kind), "__read": F.lit(None).cast("boolean")}))
    rows = rows.withColumn("__leaf", F.col("__file").isNotNull())
    steps = Ordered(rows, [], ["__key", "__leaf"]).running("__closed", F.max, F.col("__bound")).df
    shut = F.coalesce(F.col("__closed") > F.col("__key"), F.lit(False))
    return steps.filter("__leaf").select("__file.*", F.when(F.col("__read") & ~shut, "PUBLIC")
                                         .otherwise("PRIVATE").alias("visibility"))


def cross_stage_edges(edges: DataFrame, nodes: DataFrame, node: str = "node",
                      stage: str = "stage_id", src: str = "src", dst: str = "dst") -> DataFrame:
    """Distinct edges between nodes of different stages, with both stages.

    Repeated edges are merged before the joins, so a link that occurs often is looked up once.
    """
    one = nodes.select(F.col(node).alias(src), F.col(stage).alias("src_stage"))
    two = nodes.select(F.col(node).alias(dst), F.col(stage).alias("dst_stage"))
    return (edges.select(src, dst).distinct().join(one, src).join(two, dst)
            .filter(F.col("src_stage") != F.col("dst_stage")))


def mark_skipped(stages: DataFrame, name: str = "name", skipped: str = "skipped") -> DataFrame:
    """Add `` (skipped)`` to the names of skipped stages, once."""
    add = F.col(skipped) & ~F.contains(F.col(name), F.lit(SKIPPED))
    return stages.withColumn(name, F.when(add, F.concat(F.col(name), F.lit(SKIPPED)))
                             .otherwise(F.col(name)))


def mark_nodes(nodes: DataFrame, stages: DataFrame, cached: DataFrame, node: str = "node",
               stage: str = "stage_id", skipped: str = "skipped") -> DataFrame:
    """Nodes with the flags ``cached`` (their data is kept) and ``skipped`` (of their stage)."""
    kept = cached.select(node).distinct().withColumn("__cached", F.lit(True))
    return (nodes.join(kept, node, "left").join(stages.select(stage, skipped), stage, "left")
            .withColumn("cached", F.coalesce("__cached", F.lit(False))).drop("__cached")
            .withColumn(skipped, F.coalesce(skipped, F.lit(False))))


def cascade_delete(stages: DataFrame, removed: DataFrame, children: dict[str, DataFrame],
                   graphs: DataFrame, stage: str = "stage_id", attempt: str = "attempt_id"
                   ) -> dict[str, DataFrame]:
    """Remove stage attempts with all their child rows.

    The operation graph belongs to the stage and goes when no other attempt remains.
    """
    keys = [stage, attempt]
    gone = removed.select(*keys).distinct()
    left = stages.join(gone, keys, "left_anti")
    result = {"stages": left}
    for name, child in children.items():
        result[name] = child.join(gone, keys, "left_anti")
    dropped = gone.select(stage).distinct().join(left.select(stage).distinct(), stage,
                                                 "left_anti")
    result["graphs"] = graphs.join(dropped, stage, "left_anti")
    return result
