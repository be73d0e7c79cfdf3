"""Centroid clustering of integer vectors: a tournament of bisectors picks the nearest centroid.

For two centroids a and b, a before b, a vector x is nearer to b where

    2 (b - a) . x  >  |b|^2 - |a|^2

Normal 2 (b - a) and threshold |b|^2 - |a|^2 are integers and are worked out once per pair. A
vector's nearest centroid is what is left after k - 1 such tests, each of which
knocks one centroid out; equality favours the smaller number. Only the winner's distance is computed.
"""

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnmill.checkpoints import store

COMPONENTS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = "3"
# Most numbers in the table of normals: 64 MB in each worker.
MAX_NORMALS = 8_000_000

ASSIGNED = T.StructType(
    [
        T.StructField("cluster", T.IntegerType()),
        T.StructField("distance", T.LongType()),
        T.StructField("cluster_inertia", T.LongType()),
        T.StructField("inertia", T.LongType()),
        T.StructField("centroid_sha256", T.StringType()),
    ]
)
SUMS = "cluster int, place int, total long"
# Distances are added up in two halves, so that no sum of a task leaves 64 bits.
HALF = 31


class Bisectors:
    """Normals and thresholds of all pairs of centroids, and the tournament over them."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        norms = (centroids * centroids).sum(axis=1)
        # normals[a, b] and thresholds[a, b] belong to a before b.
        self.normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
        self.thresholds = norms[None, :] - norms[:, None]

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        best = np.zeros(len(vectors), np.int64)
        for challenger in range(1, len(self.centroids)):
            # The best so far has the smaller number, so it stays when the test gives zero.
            side = np.einsum("ij,ij->i", vectors, self.normals[best, challenger])
            best[side > self.thresholds[best, challenger]] = challenger
        return best

    def distances(self, vectors: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        apart = vectors - self.centroids[cluster]
        return (apart * apart).sum(axis=1)


def largest_component(components: int) -> int:
    """Vectors with components up to this size have all dot products and squared distances in 64 bits."""
    return int((2**62 / (4 * components)) ** 0.5)


def integer_vectors(column: pa.Array, components: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are whole vectors, and these as integers floor(scale * x)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    whole = np.diff(offsets) == components
    whole &= np.asarray(column.is_valid())
    values = column.values.cast(pa.float64())
    numbers = values.fill_null(np.nan).to_numpy(zero_copy_only=False)
    at = offsets[:-1][whole]
    rows = numbers[at[:, None] + np.arange(components)] if len(at) else np.zeros((0, components))
    with np.errstate(invalid="ignore", over="ignore"):
        rows = np.floor(rows * float(scale))
        # Neither a null nor an infinite component passes the comparison.
        usable = (np.abs(rows) <= largest_component(components)).all(axis=1)
    whole[np.flatnonzero(whole)[~usable]] = False
    return whole, rows[usable].astype(np.int64)


def _scan_vectors(components: int, scale: int) -> Callable:
    def scan(batches):
        for batch in batches:
            kept, vectors = integer_vectors(batch.column(1), components, scale)
            if kept.any():
                offsets = np.arange(len(vectors) + 1, dtype=np.int32) * components
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(vectors.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).filter(pa.array(kept)), lists], ["vec_id", "vector"]
                )

    return scan


def _rows(column: pa.Array, components: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, components)


def _scan_sums(centroids: np.ndarray, inertia: bool) -> Callable:
    """SUMS rows: per task and cluster, its vectors' number (place -1) and either the sums of their
    distances' high and low halves (places 0 and 1) or the sums of their components."""
    size, components = centroids.shape

    def scan(batches):
        bisectors = Bisectors(centroids)
        counts = np.zeros(size, np.int64)
        totals = np.zeros((size, 2 if inertia else components), np.int64)
        for batch in batches:
            vectors = _rows(batch.column(0), components)
            cluster = bisectors.nearest(vectors)
            counts += np.bincount(cluster, minlength=size)
            if inertia:
                distances = bisectors.distances(vectors, cluster)
                vectors = np.stack([distances >> HALF, distances & (2**HALF - 1)], axis=1)
            np.add.at(totals, cluster, vectors)
        places = np.concatenate([[-1], np.arange(totals.shape[1])]).astype(np.int32)
        table = np.hstack([counts[:, None], totals])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(size, dtype=np.int32), len(places))),
                pa.array(np.tile(places, size)),
                pa.array(table.ravel()),
            ],
            ["cluster", "place", "total"],
        )

    return scan


def _totals(vectors: DataFrame, centroids: np.ndarray, inertia: bool = False) -> tuple[list[int], list[list[int]]]:
    """Vectors in each cluster, and the sums; as many numbers as the centroids have come to the driver."""
    summed = (
        vectors.select("vector")
        .mapInArrow(_scan_sums(centroids, inertia), SUMS)
        .groupBy("cluster", "place")
        .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        .collect()
    )
    counts = [0] * len(centroids)
    totals = [[0] * (2 if inertia else centroids.shape[1]) for _ in centroids]
    for cluster, place, total in summed:
        if place < 0:
            counts[cluster] = int(total)
        else:
            totals[cluster][place] = int(total)
    return counts, totals


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def _in_long(value: int) -> int | None:
    return value if value < 2**63 else None


def _scan_assigned(centroids: np.ndarray, inertias: list[int]) -> Callable:
    def scan(batches):
        bisectors = Bisectors(centroids)
        digests = np.array([centroid_digest(c) for c in centroids], dtype=object)
        by_cluster = np.array([_in_long(i) for i in inertias], dtype=object)
        overall = _in_long(sum(inertias))
        for batch in batches:
            vectors = _rows(batch.column(1), centroids.shape[1])
            cluster = bisectors.nearest(vectors)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(cluster.astype(np.int32)),
                    pa.array(bisectors.distances(vectors, cluster)),
                    pa.array(by_cluster[cluster], pa.int64()),
                    pa.array([overall] * len(cluster), pa.int64()),
                    pa.array(digests[cluster], pa.string()),
                ],
                ["vec_id", *ASSIGNED.names],
            )

    return scan


def first_centroids(vectors: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """The vectors whose sha256 of `seed:vec_id` are least, in that order."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = vectors.orderBy(digest.asc_nulls_last(), "vector").limit(clusters).select("vector").collect()
    return np.array([row.vector for row in chosen], dtype=np.int64)


def cluster_vectors(
    embeddings: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
    scale: int = SCALE,
    seed: str = SEED,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per usable vector.

    `embeddings` has vec_id and `embedding`, a list of numbers. Usable are lists of exactly
    `components` finite numbers; a component x counts as floor(scale * x). Left out are null lists,
    lists of another length, lists with a null, NaN or infinite component, and those with a component whose
    squared distance would not fit 64 bits (over 1.3e8 in size at 64 components, after scaling).
    The first centroids are the vectors with the least sha256 of `seed:vec_id`, vectors without an
    id last, equal hashes by components; with fewer vectors there are fewer centroids, with none no
    rows. Each round assigns every vector to the nearest centroid, ties to the smaller number, and moves every
    centroid that has vectors to the floor of their mean. Rows that repeat an id or a vector each count. An inertia beyond 64 bits is null.
    Other columns are ignored.

    The rounds run when this is called, one job each over the integer vectors, which are written
    to the checkpoint folder; a round sends `clusters` x `components` sums to the driver and nothing
    else, whatever the number of vectors. Rounds after one that moves nothing change nothing and are not run.
    """
    if clusters < 1 or clusters * clusters * components > MAX_NORMALS:
        raise ValueError(f"clusters must be at least 1, and clusters^2 * components at most {MAX_NORMALS}")
    rows = embeddings.select("vec_id", "embedding")
    id_type = rows.schema["vec_id"].dataType
    vectors = store(
        rows.mapInArrow(
            _scan_vectors(components, scale), f"vec_id {id_type.simpleString()}, vector array<bigint>"
        )
    )
    centroids = first_centroids(vectors, clusters, seed)
    schema = T.StructType([T.StructField("vec_id", id_type), *ASSIGNED.fields])
    if not len(centroids):
        return embeddings.sparkSession.createDataFrame([], schema)
    for _ in range(rounds):
        counts, totals = _totals(vectors, centroids)
        moved = np.array(
            [
                [total // count for total in sums] if count else list(own)
                for count, sums, own in zip(counts, totals, centroids.tolist(), strict=True)
            ],
            dtype=np.int64,
        )
        if (moved == centroids).all():
            break
        centroids = moved
    _, halves = _totals(vectors, centroids, inertia=True)
    inertias = [(high << HALF) + low for high, low in halves]
    return vectors.mapInArrow(_scan_assigned(centroids, inertias), schema)
