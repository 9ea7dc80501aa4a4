"""Centroid clustering in whole numbers, by expressions of the JVM alone.

Components become whole numbers, so sums, means and distances are exact and do not depend on the
order of rows or tasks.  A vector's squared distance to a centroid is `aggregate` over `zip_with` of
its array and the centroid's, which stands in the plan as a literal; `array_min` over structs of
(distance, number) chooses the cluster, the smaller number among equals.  A round's new centroids are
column sums by cluster, summed in each task before anything is shuffled: what travels is a row per
cluster and task, and the driver receives a row per cluster.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, written

DIMENSIONS, SCALE, CLUSTERS, ROUNDS, SEED = 64, 64, 16, 3, 1
#: Whole numbers end here, so that a squared distance in 64 dimensions is a long.
LARGEST = 2**27

Centroids = list[list[int]]


def whole_numbers(vector: Column, dimensions: int = DIMENSIONS, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component; null unless all components are there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    number = lambda x: F.floor(
        F.least(F.greatest(x.cast("double") * scale, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))
    )
    return F.when((F.size(vector) == dimensions) & finite, F.transform(vector, number))


def _literal(numbers: list[int]) -> str:
    return f"array({', '.join(f'{n}L' for n in numbers)})"


def nearest(centroids: Centroids) -> Column:
    """struct(distance, cluster) of the nearest centroid to the array `q`."""
    found = [
        f"struct(aggregate(zip_with(q, {_literal(c)}, (a, b) -> (a - b) * (a - b)), 0L, (s, x) -> s + x)"
        f" AS distance, {number} AS cluster)"
        for number, c in enumerate(centroids)
    ]
    return F.expr(f"array_min(array({', '.join(found)}))")


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> Centroids:
    """The vectors with the smallest hashes of seed and id; equal hashes by components."""
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    chosen = vectors.select(named.alias("name"), "q").orderBy(F.col("name").asc_nulls_last(), "q").limit(clusters)
    return [r.q for r in chosen.collect()]


def moved(vectors: DataFrame, centroids: Centroids, dimensions: int) -> Centroids:
    """Each centroid at the floor of its vectors' mean; one without vectors stays."""
    sums = [F.sum(F.col("q")[k]).alias(f"s{k}") for k in range(dimensions)]
    rows = (
        vectors.select("q", nearest(centroids)["cluster"].alias("cluster"))
        .groupBy("cluster")
        .agg(F.count("*").alias("n"), *sums)
        .collect()
    )
    new = list(centroids)
    for cluster, n, *total in rows:
        new[cluster] = [t // n for t in total]
    return new


def cluster(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
) -> DataFrame:
    """A row per kept vector: id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors that are missing, of another length, or with a missing or not finite component are left
    out.  With fewer vectors than clusters every vector starts one; an empty table gives no rows.
    Repeated rows and ids are vectors of their own and may start a cluster each; a missing id is
    carried along and starts a cluster only when the others do not suffice.  Components beyond
    2**27 / scale in size count as that bound, which keeps distances within a long.  Other columns
    are not read, whatever their names.
    """
    q = whole_numbers(quoted(vector_col), dimensions, scale)
    vectors = written(df.select(quoted(id_col).alias("id"), q.alias("q")).where("q IS NOT NULL"), "vectors")
    centroids = first_centroids(vectors, clusters, seed)
    if not centroids:
        centroids = [[0] * dimensions]
    for _ in range(rounds):
        centroids = moved(vectors, centroids, dimensions)

    near = nearest(centroids)
    assigned = written(
        vectors.select("id", near.alias("near")).select("id", "near.cluster", "near.distance"), "assigned"
    )
    inertia = dict(assigned.groupBy("cluster").agg(F.sum("distance")).collect())
    digest = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    of_cluster = F.array(*[F.lit(inertia.get(k, 0)).cast("long") for k in range(len(centroids))])
    return assigned.select(
        F.col("id").alias(id_col),
        "cluster",
        "distance",
        of_cluster[F.col("cluster")].alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        F.array(*map(F.lit, digest))[F.col("cluster")].alias("centroid_sha256"),
    )
