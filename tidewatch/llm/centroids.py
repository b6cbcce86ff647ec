"""Lloyd's clustering in integers, as JVM expressions alone.

Vectors are scaled to integers and stored once. A round compares every vector with literal centroid
arrays: ``zip_with`` and ``aggregate`` give the squared distances, ``array_min`` over (distance,
number) chooses the cluster, and one sum per component, combined in each task before the shuffle,
gives the new centroids. Only a row per cluster reaches the driver. A round depends on the
one before it through these few numbers alone, so a lost executor costs a part of one round.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .vectors import integer_vectors

CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
DIMENSION = 64
SALT = "3:"

Centroids = list[list[int]]


@dataclass
class Clustering:
    """``vectors`` (vec_id, q) as stored, the centroids after all rounds, and per centroid the summed
    distances of the vectors that are nearest to it."""

    vectors: DataFrame
    centroids: Centroids
    inertias: list[int]


def first_centroids(vectors: DataFrame, clusters: int, salt: str) -> Centroids:
    """The vectors with the smallest sha256 of salt and id; equal ids in order of their components.
    A null id counts as empty text."""
    key = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = vectors.orderBy(key, "q").limit(clusters).select("q")
    return [list(r["q"]) for r in first.collect()]


def nearest(q: Column, centroids: Centroids) -> Column:
    """struct(distance, cluster) of the nearest centroid; of equally near ones the smallest number."""
    literal = F.expr("array(" + ", ".join(f"array({', '.join(f'{x}L' for x in c)})" for c in centroids) + ")")

    def distance(centroid: Column) -> Column:
        squares = F.zip_with(q, centroid, lambda a, b: (a - b) * (a - b))
        return F.aggregate(squares, F.lit(0).cast("bigint"), lambda total, x: total + x)

    return F.array_min(F.transform(literal, lambda centroid, n: F.struct(
        distance(centroid).alias("distance"), n.alias("cluster"))))


def assigned(vectors: DataFrame, centroids: Centroids) -> DataFrame:
    """``vectors`` with ``cluster`` and ``distance``."""
    found = vectors.withColumn("near", nearest(F.col("q"), centroids))
    # A generated column is computed once, whatever stands above.
    found = found.withColumn("near", F.explode(F.array("near")))
    return found.select("*", F.col("near.cluster").alias("cluster"),
                        F.col("near.distance").alias("distance")).drop("near")


def moved(vectors: DataFrame, centroids: Centroids) -> Centroids:
    """The centroids after one round; one without vectors stays where it is."""
    width = len(centroids[0])
    sums = [F.expr(f"sum(q[{i}])").alias(f"s{i}") for i in range(width)]
    totals = assigned(vectors, centroids).groupBy("cluster").agg(F.count("*").alias("n"), *sums)
    out = [list(c) for c in centroids]
    for row in totals.collect():  # a row per centroid at most
        out[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(width)]
    return out


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
            clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE,
            dimension: int = DIMENSION, salt: str = SALT) -> Clustering:
    """Centroids of all rows whose vector has ``dimension`` components, none null or non-finite.

    Other rows are left out. Rows with equal or null ids are vectors of their own. With fewer vectors than
    ``clusters`` there are as many centroids as vectors, without any there are none. Scaled components
    saturate at 2^27, so distances are exact.
    """
    right = vectors.filter(F.size(vectors[vector_col]) == dimension)
    kept = written(integer_vectors(right, id_col, vector_col, scale))
    centroids = first_centroids(kept, clusters, salt)
    if not centroids:
        return Clustering(kept, [], [])
    for _ in range(rounds):
        centroids = moved(kept, centroids)
    inertias = [0] * len(centroids)
    for row in assigned(kept, centroids).groupBy("cluster").agg(
            F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect():
        inertias[row["cluster"]] = int(row["inertia"])
    return Clustering(kept, centroids, inertias)


def members(found: Clustering) -> DataFrame:
    """One row per kept row: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    # Without centroids there are no rows; the literals below still need a value.
    centroids, inertias = found.centroids or [[0]], found.inertias or [0]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def of_cluster(values: list, kind: str) -> Column:
        return F.array(*[F.lit(v).cast(kind) for v in values])[F.col("cluster")]

    return assigned(found.vectors, centroids).select(
        "vec_id", "cluster", "distance",
        of_cluster(inertias, "bigint").alias("cluster_inertia"),
        F.lit(reduce(int.__add__, inertias)).cast("bigint").alias("inertia"),
        of_cluster(digests, "string").alias("centroid_sha256"))
