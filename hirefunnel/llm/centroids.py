"""Centroid clustering (k-means in integers) from built-in expressions alone.

Vectors become arrays of integers once and are stored. A round is one aggregation over them:
zip_with and aggregate give the squared distance to each centroid, a literal array in the plan;
array_min over (distance, number) picks the cluster, the smaller number on a tie; a sum per
component and a count, added up by cluster within each task before anything is shuffled, make the
next centroids. Only k rows of sums reach the driver per round, whatever the size of the table
and however large one cluster is.

Which vectors take part: those with exactly `dimensions` components, none of them null, NaN or
infinite. The others (also null arrays) have no row in the result. Extra columns are not looked
at. Without any such vector the result is empty; with fewer than `k`, each is a centroid. Equal
vectors fall into one cluster. Rows that share a vec_id count one by one; a null vec_id is kept,
and hashed as an empty text. A component beyond `LARGEST` in size counts as `LARGEST` with its
sign, so that a distance is a 64-bit number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirefunnel.llm.common import only, stored

# Fixed values of the operator's definition: components, clusters, rounds, units per 1.0.
DIMENSIONS = 64
K = 16
ROUNDS = 3
SCALE = 64
# 64 squared differences of up to 2**28 each stay below 2**63.
LARGEST = 2**27


def whole_numbers(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id, the components as integers floor(scale * x) in `v`, and the sum of their squares in
    `square`, for usable vectors only."""

    def usable(x: Column) -> Column:
        # Comparisons put NaN above infinity, so both bounds leave it out; null stays null.
        return F.coalesce((x > float("-inf")) & (x < float("inf")), F.lit(False))

    x = F.col("embedding").cast("array<double>")
    # Bounded before it becomes an integer: a large double has no 64-bit integer.
    bound = float(LARGEST) / scale
    x = F.transform(x, lambda c: F.greatest(F.lit(-bound), F.least(F.lit(bound), c)))
    whole = F.transform(x, lambda c: F.floor(c * float(scale)))
    chosen = only(vectors, "vec_id", "embedding").where(
        (F.size("embedding") == dimensions)
        & F.forall(F.col("embedding").cast("array<double>"), usable)
    )
    square = F.expr("aggregate(v, 0L, (s, x) -> s + x * x) AS square")
    return chosen.select("vec_id", whole.cast("array<bigint>").alias("v")).select("*", square)


def first_centroids(vectors: DataFrame, k: int = K) -> list[list[int]]:
    """The k vectors whose hashed ids are smallest, in that order; equal hashes by vector."""
    name = F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    order = F.sha2(name.cast("binary"), 256)
    return [list(r.v) for r in vectors.orderBy(order, "v").limit(k).select("v").collect()]


def lane_bits(largest: int, centroids: list[list[int]]) -> int:
    """Bits that hold every dot product of a vector and a centroid, with its sign and one to spare.

    `largest` is the largest squared length of a vector: no dot product exceeds the product of
    the two lengths, and no partial sum of one does either.
    """
    longest = max(sum(c * c for c in centroid) for centroid in centroids)
    return math.isqrt(largest * longest).bit_length() + 2


def nearest(centroids: list[list[int]], largest: int) -> Column:
    """(distance, cluster) of the centroid nearest to the vector `v`, whose square is `square`.

    As |v - c|^2 = |v|^2 - 2 v.c + |c|^2, one product and one sum per component are left to
    zip_with and aggregate. Where dot products are short, several centroids share the lanes of
    one 64-bit literal, and so one walk over the vector serves them all; the sum is taken apart
    at the end. The result is the same with one lane and with many.
    """
    bits = lane_bits(largest, centroids)
    lanes = max(1, 62 // bits)
    half, mask = 1 << (bits - 1), (1 << bits) - 1

    def distances(start: int) -> str:
        group = centroids[start : start + lanes]
        packed = [sum(c << (bits * j) for j, c in enumerate(cs)) for cs in zip(*group, strict=True)]
        products = f"zip_with(v, array({', '.join(f'{p}L' for p in packed)}), (x, c) -> x * c)"
        # Half a lane is added to each, so that no lane borrows from the next.
        lift = sum(half << (bits * j) for j in range(len(group)))
        found = []
        for j, centroid in enumerate(group):
            dot = f"((shiftright(s + {lift}L, {bits * j}) & {mask}L) - {half}L)"
            if lanes == 1:
                dot = "s"
            distance = f"square + {sum(c * c for c in centroid)}L - 2L * {dot}"
            found.append(f"named_struct('distance', {distance}, 'cluster', {start + j})")
        return f"aggregate({products}, 0L, (s, p) -> s + p, s -> array({', '.join(found)}))"

    # As one text: the thousand literals reach the JVM in one call.
    groups = ", ".join(distances(n) for n in range(0, len(centroids), lanes))
    return F.expr(f"array_min(concat({groups}))")


def moved(vectors: DataFrame, centroids: list[list[int]], largest: int) -> list[list[int]]:
    """One round: centroids become the floored means of their vectors; empty ones stay."""
    assigned = vectors.select(nearest(centroids, largest)["cluster"].alias("cluster"), "v")
    width = len(centroids[0])
    sums = assigned.groupBy("cluster").agg(
        F.count("*").alias("n"), *[F.expr(f"sum(v[{i}]) AS s{i}") for i in range(width)]
    )
    found = {r.cluster: r.asDict() for r in sums.collect()}
    return [
        [found[n][f"s{i}"] // found[n]["n"] for i in range(width)] if n in found else old
        for n, old in enumerate(centroids)
    ]


def clustered(
    vectors: DataFrame,
    k: int = K,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
) -> tuple[DataFrame, list[list[int]]]:
    """Rows (vec_id, cluster, distance) and the final centroids."""
    usable = stored(whole_numbers(vectors, dimensions, scale), "centroids-vectors")
    centroids = first_centroids(usable, k)
    if not centroids:
        return usable.selectExpr("vec_id", "0 AS cluster", "0L AS distance"), []
    largest = usable.agg(F.max("square")).first()[0]
    for _ in range(rounds):
        centroids = moved(usable, centroids, largest)
    best = usable.select("vec_id", nearest(centroids, largest).alias("best"))
    rows = best.select("vec_id", "best.cluster", "best.distance")
    return stored(rows, "centroids-assigned"), centroids


def clusters(vectors: DataFrame, **options: int) -> DataFrame:
    """The rows of `clustered` with the inertia of their cluster and of all, and the centroid's hash."""
    rows, centroids = clustered(vectors, **options)
    if not centroids:
        kinds = {"cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string"}
        return rows.select("*", *[F.lit(None).cast(t).alias(c) for c, t in kinds.items()])
    # One row per cluster comes back, at most k.
    sums = rows.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()
    inertia = {r.cluster: r.inertia for r in sums}
    total = sum(inertia.values())

    def by_cluster(values: list[Column]) -> Column:
        return F.array(*values)[F.col("cluster")]

    hashes = [F.sha2(F.lit(",".join(map(str, c))).cast("binary"), 256) for c in centroids]
    return rows.select(
        "vec_id",
        "cluster",
        "distance",
        by_cluster([F.lit(inertia.get(n, 0)).cast("bigint") for n in range(len(centroids))]).alias(
            "cluster_inertia"
        ),
        F.lit(total).cast("bigint").alias("inertia"),
        by_cluster(hashes).alias("centroid_sha256"),
    )
