"""Exact k-means in integers, with nearest centroids found by the threshold algorithm.

Vectors are scaled to integers, so distances, sums and means are exact and don't depend on how
rows are dealt. The centroids (a fixed number of them) are sent to all tasks; a round is one pass
over the vectors that gives a count and sums for each centroid, combined before the exchange.

The nearest centroid of a vector: each dimension has its centroids in sorted order. A walk starts
at the vector's own value and goes outward in all dimensions, always to the next closer of the two
neighbours. A centroid met for the first time gets its exact distance. No centroid that was not met
yet can be closer than the sum of squares of what the walk has reached in each dimension, its
*frontier*, so the walk ends when that sum strictly exceeds the best exact distance (a tie could
still have a smaller number), or when all are met. Dimensions are walked in the order of the
centroids' spread, ``STRIDE`` at a time, for a batch of vectors at once.

Defined results: vectors that are null, have another number of components, or any that is null,
not finite or, scaled, beyond ``LARGEST`` (its distances would not fit a long) are left out, so a
null or empty table gives no rows. Repeated rows count each; a null vec_id hashes as an empty
string. With fewer vectors than centroids, each vector is one; equal centroids give all their
vectors to the smaller number. Other columns are kept, whatever their names; new columns replace
old ones of the same name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from stayline.llm.words import ship_package
from stayline.session import durable

DIMENSIONS, CENTROIDS, ROUNDS = 64, 40, 5
SCALE = 256
LARGEST = 1 << 27
STRIDE = 8  # dimensions between two looks at the threshold
PIECE = 2048  # vectors that are walked together


def scaled(vector: Column, dimensions: int) -> Column:
    """Components as integers; null for a vector that doesn't count."""
    x = F.transform(vector, lambda v: F.floor(v.cast("double") * SCALE))
    whole = (F.size(vector) == dimensions) & F.forall(
        vector, lambda v: v.isNotNull() & (F.abs(v.cast("double")) * SCALE < LARGEST)
    )
    return F.when(whole, x)


@dataclass
class Walk:
    """Sorted centroid lists of each dimension."""

    centroids: np.ndarray  # (number, dimension), integers

    def __post_init__(self) -> None:
        spread = np.ptp(self.centroids, axis=0) if len(self.centroids) else np.zeros(0)
        self.dimensions = np.argsort(-spread, kind="stable")
        self.order = np.argsort(self.centroids, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.centroids, self.order, axis=0)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each row and its squared distance."""
        n, k = len(x), len(self.centroids)
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, k)
        met = np.zeros((n, k), bool)
        above = np.empty_like(x)  # the next place to the right, in each dimension
        for d in range(x.shape[1]):
            above[:, d] = np.searchsorted(self.sorted[:, d], x[:, d])
        below = above - 1
        frontier = np.zeros_like(x)
        live = np.arange(n)
        for _ in range(k):  # a step outward in every dimension
            for s in range(0, len(self.dimensions), STRIDE):
                own = self.dimensions[s : s + STRIDE]
                self._step(x, live, own, below, above, frontier, met, best, number)
                reached = (frontier[live] ** 2).sum(axis=1)
                live = live[(reached <= best[live]) & ~met[live].all(axis=1)]
                if not len(live):
                    return number, best
        return number, best

    def _step(self, x, live, own, below, above, frontier, met, best, number) -> None:
        far = np.iinfo(np.int64).max
        k = len(self.centroids)
        at = np.ix_(live, own)
        value, lo, hi = x[at], below[at], above[at]
        left = np.where(lo >= 0, value - self.sorted[np.maximum(lo, 0), own], far)
        right = np.where(hi < k, self.sorted[np.minimum(hi, k - 1), own] - value, far)
        go_left = left <= right
        place = np.where(go_left, lo, hi)
        below[at], above[at] = lo - go_left, hi + ~go_left
        frontier[at] = np.minimum(left, right)
        seen = self.order[place, own]
        rows = np.repeat(live, len(own))
        fresh = np.zeros(met.shape, bool)
        fresh[rows, seen.ravel()] = True
        fresh &= ~met
        met |= fresh
        row, centroid = np.nonzero(fresh)
        if not len(row):
            return
        # Sorted by row: the best of each row's new centroids, the smallest number of equal ones.
        distance = ((x[row] - self.centroids[centroid]) ** 2).sum(axis=1)
        order = np.lexsort((centroid, distance, row))
        row, centroid, distance = row[order], centroid[order], distance[order]
        first = np.append(True, row[1:] != row[:-1])
        row, centroid, distance = row[first], centroid[first], distance[first]
        better = (distance < best[row]) | ((distance == best[row]) & (centroid < number[row]))
        best[row[better]], number[row[better]] = distance[better], centroid[better]


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), dimensions)


def _assigned(batch: pa.RecordBatch, walk: Walk) -> Iterator[tuple[int, np.ndarray, tuple]]:
    """(first row, vectors, what is nearest) of each piece of a batch."""
    dimensions = walk.centroids.shape[1]
    for a in range(0, len(batch), PIECE):
        x = _matrix(batch.column("x").slice(a, PIECE), dimensions)
        yield a, x, walk.nearest(x)


def _means(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Exact floors of the means of each centroid's vectors; empty centroids stay."""
    shared = vectors.sparkSession.sparkContext.broadcast(Walk(centroids))
    k, dimensions = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, total = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
            for _, x, (number, _) in _assigned(batch, shared.value):
                order = np.argsort(number, kind="stable")
                held, first = np.unique(number[order], return_index=True)
                total[held] += np.add.reduceat(x[order], first, axis=0)
                n += np.bincount(number, minlength=k)
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(used.astype(np.int32)),
                    pa.array(n[used]),
                    pa.array(total[used].tolist(), pa.list_(pa.int64())),
                ],
                ["cluster", "n", "total"],
            )

    ship_package(vectors.sparkSession)
    parts = vectors.select("x").mapInArrow(sums, "cluster int, n long, total array<long>")
    exact = "decimal(38,0)"  # sums over any number of vectors
    added = [F.sum(F.col("total")[d].cast(exact)).alias(f"t{d}") for d in range(dimensions)]
    out = centroids.copy()
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *added).collect():
        out[row.cluster] = [int(row[f"t{d}"]) // row.n for d in range(dimensions)]
    return out


def first_centroids(vectors: DataFrame, number: int, seed: int = 2) -> np.ndarray:
    """The vectors whose ids have the smallest hashes."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = vectors.select(F.sha2(name, 256).alias("hash"), "x").orderBy("hash", "x").limit(number)
    return np.array([r.x for r in rows.orderBy("hash", "x").collect()], np.int64)


FIELDS = (
    "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
)


def cluster(
    df: DataFrame,
    keep: list[str] | None = None,
    column: str = "embedding",
    dimensions: int = DIMENSIONS,
    number: int = CENTROIDS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``df`` with the cluster of each vector, its distance, the sums of distances and centroid.

    ``keep`` names the columns to go on with, all of them if not given.
    """
    kept = list(df.columns if keep is None else keep)
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    vectors = df.select(
        row, F.col("vec_id").alias("id"), scaled(F.col(f"`{column}`"), dimensions).alias("x")
    )
    vectors = durable(vectors.where("x is not null"))
    new = StructType.fromDDL(FIELDS)
    left = [F.col(f"row.`{c}`") for c in kept if c not in new.names]
    centroids = first_centroids(vectors, number)
    if not len(centroids):
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in new.fields]
        return vectors.select(*left, *nothing)
    for _ in range(rounds):
        centroids = _means(vectors, centroids)
    shared = df.sparkSession.sparkContext.broadcast(Walk(centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [f for _, _, f in _assigned(batch, shared.value)]
            cluster, distance = (np.concatenate(c) for c in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                ["row", "cluster", "distance"],
            )

    schema = StructType([vectors.schema["row"], new["cluster"], new["distance"]])
    assigned = durable(vectors.select("row", "x").mapInArrow(assign, schema))
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = assigned.groupBy("cluster").agg(total.alias("s")).collect()  # a row for each centroid
    inertia = sum(int(r.s) for r in sums)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(r.cluster, int(r.s), inertia, digest[r.cluster]) for r in sums]
    names = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    of_cluster = df.sparkSession.createDataFrame(rows, names)
    return assigned.join(F.broadcast(of_cluster), "cluster").select(*left, *new.names)


def oracle(
    dimensions: int = DIMENSIONS, number: int = CENTROIDS, rounds: int = ROUNDS, seed: int = 2
) -> str:
    """The same in SQL, every distance written out."""
    steps = [
        f"""kept AS (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda v: CAST(floor({SCALE} * CAST(v AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda v: v IS NULL)) = 0
    AND len(list_filter(embedding, lambda v: NOT isfinite(CAST(v AS DOUBLE)))) = 0)""",
        f"""c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY h, x) - 1 AS INTEGER) AS cluster, x FROM (
    SELECT sha256('{seed}:' || vec_id::VARCHAR) AS h, x FROM kept ORDER BY h, x LIMIT {number}))""",
    ]
    for k in range(rounds + 1):
        steps.append(
            f"""d{k} AS (
  SELECT kept.r, c{k}.cluster, CAST(list_sum(list_transform(
    list_zip(kept.x, c{k}.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
  FROM kept CROSS JOIN c{k}),
a{k} AS (
  SELECT r, min_by(cluster, distance * {number} + cluster) AS cluster, min(distance) AS distance
  FROM d{k} GROUP BY r)"""
        )
        if k < rounds:
            steps.append(
                f"""m{k} AS (
  SELECT cluster, d, sum(v) AS total, count(*) AS n FROM (
    SELECT cluster, unnest(x) AS v, unnest(range({dimensions})) AS d
    FROM kept JOIN a{k} USING (r)) GROUP BY cluster, d),
c{k + 1} AS (
  SELECT c{k}.cluster, coalesce(fresh.x, c{k}.x) AS x FROM c{k} LEFT JOIN (
    SELECT cluster, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY d) AS x
    FROM m{k} GROUP BY cluster) fresh USING (cluster))"""
            )
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""
SELECT kept.vec_id, a{rounds}.cluster, a{rounds}.distance,
  CAST(sum(a{rounds}.distance) OVER (PARTITION BY a{rounds}.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(a{rounds}.distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c{rounds}.x, ',')) AS centroid_sha256
FROM kept JOIN a{rounds} USING (r) JOIN c{rounds} USING (cluster)"""
    )
