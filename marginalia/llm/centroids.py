"""Centroid clustering of integer vectors in JVM expressions.

Components become whole numbers, so sums and distances are exact and the order in which tasks
add them up changes nothing. A round is one job without Python: ``zip_with`` and ``aggregate``
give the squared distance to each literal centroid, ``array_min`` over structs of (distance,
number) chooses the cluster, the smaller number among equals, and one plain column sum for each
component updates the centroids. A cluster may hold any share of the rows: sums are combined in
the tasks, and one row per centroid is shuffled and comes to the driver.

Vectors of another width, null ones, and those with null or non-finite components are left out.
Repeated ids and rows each count; null ids are clustered, and come last as seeds. With fewer
vectors than centroids there are as many centroids as vectors, an empty table gives an empty
result. Components whose distances could leave 64 bits raise a ValueError. Extra columns are not
carried.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

WIDEST = 2**62  # bound of a squared distance


def integer_vectors(df: DataFrame, width: int, scale: int = 1024, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, v``: floor(scale * x) of every component of the usable vectors, as longs."""
    held = F.col(embedding)
    finite = F.forall(held, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    kept = df.filter((F.size(held) == width) & finite)
    return kept.select(F.col(vec_id).alias("vec_id"), F.transform(held, lambda x: F.floor(x.cast("double") * F.lit(scale))).cast("array<long>").alias("v"))


def seeds(vectors: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The k vectors of smallest sha256 of ``salt`` and id, in that order; equal ids by their components."""
    digest = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(digest.alias("digest"), "v").orderBy(F.asc_nulls_last("digest"), "v").limit(k).collect()
    return [list(r.v) for r in rows]


def nearest(v: str, centroids: list[list[int]]) -> Column:
    """Struct of the smallest squared distance of column ``v`` and the number of its centroid."""

    def choice(i: int, centroid: list[int]) -> str:
        literal = ", ".join(f"{int(c)}L" for c in centroid)
        distance = f"aggregate(zip_with({v}, array({literal}), (x, c) -> (x - c) * (x - c)), 0L, (total, d) -> total + d)"
        return f"struct({distance} AS distance, {i} AS cluster)"

    # One text instead of a call to the JVM for each literal.
    return F.expr(f"array_min(array({', '.join(choice(i, c) for i, c in enumerate(centroids))}))")


def update(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Each centroid replaced by floor(sum / count) of its vectors' components; empty ones stay."""
    width = range(len(centroids[0]))
    placed = vectors.select("v", nearest("v", centroids).alias("near"))
    columns = placed.selectExpr("near.cluster AS cluster", *(f"v[{i}] AS c{i}" for i in width))
    sums = columns.groupBy("cluster").agg(F.count("*").alias("n"), *(F.expr(f"sum(c{i})").alias(f"c{i}") for i in width))
    out = list(centroids)
    for r in sums.collect():
        out[r.cluster] = [r[f"c{i}"] // r.n for i in width]
    return out


def cluster(df: DataFrame, width: int, k: int, rounds: int, salt: str, scale: int = 1024, vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, cluster, distance`` of every usable vector, and the centroids."""
    vectors = written(integer_vectors(df, width, scale, vec_id, embedding), "vectors")
    low, high = vectors.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    if low is None:
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    if (high - low) ** 2 * width > WIDEST:
        raise ValueError("components are too far apart for distances of 64 bits")
    centroids = seeds(vectors, k, salt)
    for _ in range(rounds):
        moved = update(vectors, centroids)
        if moved == centroids:
            break  # every later round would give the same
        centroids = moved
    placed = vectors.select("vec_id", nearest("v", centroids).alias("near"))
    return placed.select("vec_id", F.col("near.cluster").alias("cluster"), F.col("near.distance").alias("distance")), centroids


def describe(placed: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``placed`` with ``cluster_inertia`` and ``inertia`` (sums of distances) and ``centroid_sha256``, a digest of the cluster's centroid."""
    placed = written(placed, "placed")
    own = {r.cluster: int(r.s) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids] or [""]
    at = F.col("cluster") + 1
    sums = F.array(*(F.lit(own.get(i, 0)).cast("long") for i in range(len(digests))))
    return placed.select(
        "*", F.element_at(sums, at).alias("cluster_inertia"), F.lit(sum(own.values())).cast("long").alias("inertia"),
        F.element_at(F.array(*map(F.lit, digests)), at).alias("centroid_sha256"),
    )
