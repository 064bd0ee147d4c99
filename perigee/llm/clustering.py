"""Centroid clustering of integer vectors by built-in expressions, without Python workers.

Components are turned into integers floor(scale * x), so every sum is exact and results don't
depend on how rows are dealt to tasks. The centroids, k of them, stand in the
plan as a literal array: ``zip_with`` and ``aggregate`` give a vector's squared distance to each,
``array_min`` over (distance, number) structs chooses the cluster, ties going to the smaller
number. A round's new centroids come from one column sum per component and cluster, added up
within each task before the shuffle, so a cluster that holds most vectors costs no more than
others; only those sums reach the driver.

Vectors are read, and cut to integers, once in every round and never shuffled. The last assignment
is stored (id, cluster, distance), so that inertias are summed without measuring again.

Defined results. Vectors that are null, of another length, or hold a null or non-finite component
take no part. Null id: the vector is clustered, but is no first centroid. Repeated rows each
count and come out each; as first centroids, equal ids go in the order of their components.
Fewer vectors than centroids: fewer centroids. An empty table: no rows. Extra columns are ignored. A component whose integer is beyond
``LARGEST`` raises an error, as squared distances would not fit a long.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import stored

#: Largest magnitude of a component: 64 squared differences of twice as much stay below 2**63.
LARGEST = 1 << 27


def integer_vectors(rows: DataFrame, size: int, scale: int) -> DataFrame:
    """vec_id and v, an array of ``size`` longs, of the rows whose vector is whole and finite."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    kept = rows.where((F.size("embedding") == size) & finite)
    too_large = F.raise_error(F.lit(f"a component is beyond {LARGEST} as an integer"))
    whole = F.transform(x, lambda c: F.when(F.abs(c * scale) < LARGEST, F.floor(c * scale)).otherwise(too_large.cast("long")))
    return kept.select(F.col("vec_id").cast("long"), whole.alias("v"))


def first_centroids(vectors: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The vectors of the k smallest sha256 of ``salt``vec_id, in that order."""
    named = vectors.where("vec_id is not null").withColumn("h", F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256))
    return [list(r["v"]) for r in named.orderBy("h", "v").limit(k).select("v").collect()]


def nearest(v: Column, centroids: list[list[int]]) -> Column:
    """(distance, cluster) of the centroid nearest to a vector: |v|^2 + (|c|^2 - 2 v.c), in whole numbers."""
    add = lambda total, x: total + x
    zero = F.lit(0).cast("long")
    rows = ("named_struct('c', array({}), 'square', {}L)".format(", ".join(f"{x}L" for x in c), sum(x * x for x in c)) for c in centroids)
    table = F.expr("array(" + ", ".join(rows) + ")")
    dot = lambda c: F.aggregate(F.zip_with(v, c, lambda x, y: x * y), zero, add)
    best = F.array_min(F.transform(table, lambda c, i: F.struct((c["square"] - 2 * dot(c["c"])).alias("beyond"), i.alias("cluster"))))
    length = F.aggregate(v, zero, lambda total, x: total + x * x)
    return F.struct((best["beyond"] + length).alias("distance"), best["cluster"].alias("cluster"))


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Every centroid replaced by the floor of its vectors' mean; those without vectors stay."""
    size = len(centroids[0])
    assigned = vectors.select("v", nearest(F.col("v"), centroids)["cluster"].alias("cluster"))
    columns = assigned.select("cluster", *[F.col("v")[i].alias(f"c{i}") for i in range(size)])
    sums = columns.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"c{i}").alias(f"c{i}") for i in range(size)])
    out = list(centroids)
    for row in sums.collect():  # one row for each centroid
        out[row["cluster"]] = [row[f"c{i}"] // row["n"] for i in range(size)]
    return out


def clustered(rows: DataFrame, k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, salt: str = "2:") -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 of every vector that takes part."""
    vectors = integer_vectors(rows, size, scale)
    centroids = first_centroids(vectors, k, salt)
    if not centroids:
        centroids = [[0] * size]  # every vector left has no id, or there is none
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    best = nearest(F.col("v"), centroids)
    assigned = vectors.select("vec_id", best.alias("best")).select("vec_id", F.col("best.cluster").alias("cluster"), F.col("best.distance").alias("distance"))
    assigned = stored(assigned, "clustered")
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = assigned.agg(F.sum("distance").alias("inertia"))
    of_cluster = sums.withColumn("inertia", total.scalar()).withColumn("centroid_sha256", F.element_at(F.array(*map(F.lit, names)), F.col("cluster") + 1))
    # at most k rows
    return assigned.join(F.broadcast(of_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
