"""Clustering of integer vectors around centroids by a tournament of bisectors.

For two centroids the points that are nearer to the second lie beyond a plane: with the integer
normal 2 (c_j - c_i) and the integer threshold |c_j|^2 - |c_i|^2, the sign of normal . x - threshold
tells which one wins, and zero lets the smaller number win. Normals and thresholds of all pairs are
made once a round; k - 1 such tests leave one centroid for a vector, and only its distance is
computed. All of it is exact: numbers that 64 bits hold are tested as such, others as integers of
any length.

Each round reads the vectors anew and sends, from each task, sums and counts by cluster: at most
(number of clusters) x (components + 1) rows, whatever the sizes of the clusters. The driver holds
the centroids and those sums alone.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.llm.workers import map_rows, stored

CLUSTERS, ROUNDS, COMPONENTS, SCALE = 8, 10, 64, 1024
#: Put before an id when the first centroids are drawn by the digest of both.
SEED = "3"

#: Sums leave a task in parts of so many bits, so that adding up parts cannot pass 64.
PART_BITS = 40
COUNTS = -1

ASSIGNED = "vec_id long, cluster int, distance long"
SUMS = "cluster int, component int, part int, total long"


def usable(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, embedding) of the vectors of that many components, all of them finite numbers."""
    kept = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return kept.where((F.size("embedding") == components) & F.coalesce(finite, F.lit(False)))


def integer(x: float, scale: int) -> int:
    """floor(scale * x), for a scale that is a power of two; exact where that product passes a double."""
    return math.floor(scale * x) if abs(x) < 2.0**64 else scale * int(x)


def points_of(column: pa.Array, components: int, scale: int) -> np.ndarray:
    """Vectors as integers: of 64 bits if the tests on them stay below that, else of any length."""
    floats = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, components)
    if not len(floats) or np.abs(floats).max() * scale < largest(components):
        return np.floor(scale * floats).astype(np.int64)
    return np.array([[integer(x, scale) for x in row] for row in floats.tolist()], object)


def largest(components: int) -> int:
    """Size of numbers up to which a test of two such vectors stays within 64 bits."""
    return math.isqrt(2**62 // (8 * components)) - 1


class Tournament:
    """Which of some centroids is nearest."""

    def __init__(self, centroids: list[list[int]]):
        small = all(abs(x) < largest(len(row)) for row in centroids for x in row)
        self.centroids = np.array(centroids, np.int64 if small else object)
        squares = (self.centroids * self.centroids).sum(1)
        self.normals = 2 * (self.centroids[None, :, :] - self.centroids[:, None, :])
        self.thresholds = squares[None, :] - squares[:, None]

    def winners(self, points: np.ndarray) -> np.ndarray:
        """Numbers of the nearest centroids, of equally near ones the smallest."""
        winner = np.zeros(len(points), np.int64)
        for rival in range(1, len(self.centroids)):
            side = (points * self.normals[winner, rival]).sum(1) - self.thresholds[winner, rival]
            winner = np.where(side > 0, rival, winner)
        return winner

    def distances(self, points: np.ndarray, winner: np.ndarray) -> np.ndarray:
        """Squared distances from the centroids of these numbers."""
        off = points - self.centroids[winner]
        return (off * off).sum(1)


def parts(total: int) -> Iterator[tuple[int, int]]:
    """An integer as (place, value) in base 2^40; the last value carries the sign."""
    place = 0
    while not -(1 << PART_BITS) <= total < 1 << PART_BITS:
        yield place, total & ((1 << PART_BITS) - 1)
        total >>= PART_BITS
        place += 1
    yield place, total


def sums(kept: DataFrame, centroids: list[list[int]], scale: int) -> list[list[int]]:
    """Of each cluster the sums of its vectors' components, then their number."""
    components = len(centroids[0])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tournament = Tournament(centroids)
        found = np.zeros((len(centroids), components + 1), object)
        for batch in batches:
            points = points_of(batch.column(1), components, scale)
            winner = tournament.winners(points)
            for cluster in np.unique(winner):
                own = points[winner == cluster]
                found[cluster, :components] += own.sum(0).astype(object)
                found[cluster, components] += len(own)
        rows = [
            (cluster, COUNTS if column == components else column, place, value)
            for cluster, column in zip(*np.nonzero(found), strict=True)
            for place, value in parts(int(found[cluster, column]))
        ]
        yield dict(zip(("cluster", "component", "part", "total"), map(list, zip(*rows, strict=True)), strict=True)) if rows else {
            name: [] for name in ("cluster", "component", "part", "total")
        }

    added = map_rows(kept, task, SUMS).groupBy("cluster", "component", "part").agg(F.sum("total").alias("total"))
    totals = [[0] * (components + 1) for _ in centroids]
    for row in added.collect():  # clusters x (components + 1) x few parts
        totals[row.cluster][row.component] += row.total << PART_BITS * row.part
    return totals


def first_centroids(kept: DataFrame, clusters: int, scale: int, seed: str) -> list[list[int]]:
    """The vectors of the least digests of seed and id; without id last, equal ids by components."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(digest.asc_nulls_last(), "embedding").limit(clusters).collect()
    return [[integer(x, scale) for x in row.embedding] for row in rows]


def fit(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
    scale: int = SCALE,
    seed: str = SEED,
) -> list[list[int]]:
    """Centroids after some rounds: fewer than ``clusters`` if there are fewer usable vectors."""
    kept = usable(vectors, components)
    centroids = first_centroids(kept, clusters, scale, seed)
    for _ in range(rounds if centroids else 0):
        totals = sums(kept, centroids, scale)
        centroids = [
            [total // row[-1] for total in row[:-1]] if row[-1] else old for row, old in zip(totals, centroids, strict=True)
        ]
    return centroids


def assign(vectors: DataFrame, centroids: list[list[int]], components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, cluster, distance) of every usable vector; null for a distance beyond 64 bits."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tournament = Tournament(centroids)
        for batch in batches:
            points = points_of(batch.column(1), components, scale)
            winner = tournament.winners(points)
            distances = [d if d < 2**63 else None for d in tournament.distances(points, winner).tolist()]
            yield {"vec_id": batch.column(0), "cluster": winner.astype(np.int32), "distance": distances}

    return map_rows(usable(vectors, components).where(F.lit(bool(centroids))), task, ASSIGNED)


def cluster(vectors: DataFrame, centroids: list[list[int]], components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector.

    Vectors that are null, of another length, or with a component that is null or not finite have no
    row; an empty table has none either. Repeated rows count and are returned each; a null vec_id
    stays null. A distance or sum that passes 64 bits is null. Other columns are ignored, whatever
    their names.
    """
    spark = vectors.sparkSession
    assigned = stored(assign(vectors, centroids, components, scale), "assigned")
    whole = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))
    by_cluster = assigned.groupBy("cluster").agg(whole.alias("own")).collect()  # one row a cluster
    own = {row.cluster: row.own for row in by_cluster}
    known = [int(value) for value in own.values() if value is not None]
    inertia = sum(known) if len(known) == len(own) else None
    fits = lambda value: int(value) if value is not None and value < 2**63 else None
    rows = [
        (number, fits(own.get(number)), fits(inertia), hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())
        for number, row in enumerate(centroids)
    ]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    found = assigned.join(F.broadcast(facts), "cluster")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def as_sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, components: int = COMPONENTS, scale: int = SCALE, seed: str = SEED) -> str:
    """The same in SQL, over a table ``embeddings``: every distance of every round."""

    def assigned(number: int) -> str:
        return f"""a{number} AS MATERIALIZED (
            SELECT id, c, d FROM (
              SELECT v.id, k.c, sum((v.x - k.x) * (v.x - k.x)) AS d
              FROM v JOIN k{number} AS k ON v.i = k.i GROUP BY v.id, k.c)
            QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, c) = 1)"""

    def moved(number: int) -> str:
        return f"""k{number} AS MATERIALIZED (
            SELECT k.c, k.i, CASE WHEN n IS NULL THEN k.x ELSE (s - ((s % n) + n) % n) // n END AS x
            FROM k{number - 1} AS k LEFT JOIN (
              SELECT a.c, v.i, sum(v.x) AS s, count(*) AS n
              FROM v JOIN a{number - 1} AS a ON v.id = a.id GROUP BY a.c, v.i) AS t ON k.c = t.c AND k.i = t.i)"""

    steps = [assigned(0)]
    for number in range(1, rounds + 1):
        steps += [moved(number), assigned(number)]
    return f"""
    WITH kept AS MATERIALIZED (
      SELECT row_number() OVER () AS id, vec_id, sha256('{seed}:' || vec_id) AS digest,
             list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS HUGEINT)) AS xs
      FROM embeddings
      WHERE len(embedding) = {components}
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {components}),
    v AS MATERIALIZED (SELECT id, unnest(xs) AS x, unnest(range({components})) AS i FROM kept),
    k0 AS MATERIALIZED (
      SELECT c, unnest(xs) AS x, unnest(range({components})) AS i FROM (
        SELECT xs, row_number() OVER (ORDER BY digest, xs) - 1 AS c FROM kept ORDER BY digest, xs LIMIT {clusters})),
    {", ".join(steps)},
    digests AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM k{rounds} GROUP BY c)
    SELECT kept.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
           CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
           CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
    FROM a{rounds} AS a JOIN kept ON a.id = kept.id JOIN digests ON digests.c = a.c
    """
