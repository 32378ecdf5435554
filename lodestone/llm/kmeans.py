"""Centroid clustering by exact Lloyd rounds with heap-ordered bounds.

Vectors of integers are laid out in blocks, a row each. A block keeps, for
each cluster, a heap of its vectors. A vector's key is the gap between its
distance to the second nearest centroid (lower bound) and to its own (upper
bound), plus the drift that its cluster has accumulated when the key is made:
the own centroid's move and the largest move of another, summed over rounds.
While the key is above the cluster's accumulated drift, no other centroid can
be as near. So in a round a block pops the vectors whose gap has expired,
rescans exactly those against all centroids and pushes them to the heap of the
cluster they belong to; a block where nothing expires passes as it is. Spark
sums what the vectors that moved take from and bring to the clusters; only
those sums (a row a cluster) reach the driver.

Distances that decide are exact integers; bounds are doubles, held apart by a
margin, so rounding can only cause a rescan. Each round's blocks are written
to the shared folder and the last round's go, so a lost executor costs a
block's task and no round is done twice.

Defined results: vectors that are null, have another number of components, or
a null or non-finite one, are left out, and so are those with a component of
``LARGEST`` or more in size, whose squared distances don't fit 64 bits; with
fewer vectors than centroids each is one; rows that repeat a vec_id are
vectors of their own, the smaller vector first where they become centroids; a
null vec_id comes last there; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import materialize

DIMS, CLUSTERS, ROUNDS, SEED, SCALE = 64, 8, 10, 3, 1024
#: Bound of a component (after scaling) whose squared distances fit 64 bits.
LARGEST = 1 << 27
#: Vectors of a block.
BLOCK = 4096
#: Share of a bound, and the least, by which it must hold.
MARGIN = 1e-9

STATE = "ids binary, known binary, vectors binary, cluster binary, keys binary, members binary, sizes binary, moved array<long>"
_FIELDS = [f.split()[0] for f in STATE.split(", ")]


def integer_vectors(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """vec_id, v (array of long) of the vectors that are whole."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    odd = lambda e: e.isNull() | F.isnan(e) | ~(F.abs(F.floor(e * scale).cast("double")) < LARGEST) | (F.abs(e) == float("inf"))
    sound = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(F.col("x").isNotNull() & (F.size("x") == dims) & ~F.exists("x", odd))
    return sound.select("vec_id", F.transform("x", lambda e: F.floor(e * scale).cast("long")).alias("v"))


def first_centroids(rows: DataFrame, clusters: int, dims: int, seed: int) -> np.ndarray:
    """The vectors of the smallest hashes; Spark cuts each task's rows to that number before they move."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select(draw.alias("draw"), "v").orderBy(F.col("draw").asc_nulls_last(), "v").limit(clusters).collect()
    return np.array([r["v"] for r in first], np.int64).reshape(-1, dims)


def squared_distances(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact integers (vector, centroid)."""
    v = v.astype(np.int64)
    if not len(v) or max(int(np.abs(v).max()), int(np.abs(centroids).max())) >= 1 << 22:
        return np.stack([((v - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    a, c = v.astype(np.float64), centroids.astype(np.float64)  # every number below 2**53: exact
    return ((a * a).sum(axis=1)[:, None] - 2 * (a @ c.T) + (c * c).sum(axis=1)).astype(np.int64)


def drifts(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How much a round narrows the gaps of each cluster: its own move and the largest of another."""
    move = np.sqrt(((new - old).astype(np.float64) ** 2).sum(axis=1)) * (1 + MARGIN)
    return np.array([m + max([0.0, *np.delete(move, j)]) for j, m in enumerate(move)])


class Block:
    """Vectors, their clusters, and for each cluster a heap of (key, vector)."""

    def __init__(self, ids: np.ndarray, known: np.ndarray, vectors: np.ndarray, cluster: np.ndarray, heaps: list[list[tuple[float, int]]]):
        self.ids, self.known, self.vectors, self.cluster, self.heaps = ids, known, vectors, cluster, heaps

    @staticmethod
    def read(row: dict[str, bytes], dims: int) -> Block:
        size = len(row["vectors"]) // max(1, len(row["known"]) * dims)
        keys, members, sizes = np.frombuffer(row["keys"]).tolist(), np.frombuffer(row["members"], "<i4").tolist(), np.frombuffer(row["sizes"], "<i4")
        stops = np.cumsum(sizes)
        heaps = [list(zip(keys[b - n : b], members[b - n : b], strict=True)) for n, b in zip(sizes.tolist(), stops.tolist(), strict=True)]
        vectors = np.frombuffer(row["vectors"], f"<i{size}").reshape(-1, dims)
        return Block(np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["known"], bool), vectors, np.frombuffer(row["cluster"], np.uint8).copy(), heaps)

    def expired(self, drift: np.ndarray) -> list[int]:
        """Vectors whose gap the drift has used up, popped."""
        out = []
        for heap, d in zip(self.heaps, drift.tolist(), strict=True):
            while heap and heap[0][0] <= d:
                out.append(heapq.heappop(heap)[1])
        return out

    def rescan(self, who: list[int], centroids: np.ndarray, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact clusters of the popped vectors, pushed with new keys; what that changes in the clusters' sums and sizes."""
        k, dims = centroids.shape
        sums, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        at = np.array(who, np.int64)
        d = squared_distances(self.vectors[at], centroids)
        new = d.argmin(axis=1)  # the first of equals
        near = np.sqrt(np.partition(np.maximum(d, 0).astype(np.float64), min(1, k - 1), axis=1)[:, :2])
        gap = near[:, 1] * (1 - MARGIN) - near[:, 0] * (1 + MARGIN) if k > 1 else np.full(len(at), np.inf)
        keys = gap - MARGIN + drift[new] * (1 - MARGIN)
        for i, c, key in zip(who, new.tolist(), keys.tolist(), strict=True):
            heapq.heappush(self.heaps[c], (key, i))
        old = self.cluster[at]
        moved = np.flatnonzero(old != new)
        rows = self.vectors[at[moved]].astype(np.int64)
        came = old[moved] < k  # at first no vector belongs to a cluster
        np.add.at(sums, new[moved], rows)
        np.subtract.at(sums, old[moved][came], rows[came])
        n += np.bincount(new[moved], minlength=k) - np.bincount(old[moved][came], minlength=k)
        self.cluster[at] = new
        return sums, n

    def written(self, sums: np.ndarray, n: np.ndarray) -> list:
        keys = [key for h in self.heaps for key, _ in h]
        members = [i for h in self.heaps for _, i in h]
        sizes = np.array([len(h) for h in self.heaps], "<i4")
        return [self.ids.tobytes(), self.known.tobytes(), self.vectors.tobytes(), self.cluster.tobytes(), np.array(keys).tobytes(), np.array(members, "<i4").tobytes(), sizes.tobytes(), [*sums.ravel().tolist(), *n.tolist()]]


def _batch(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.binary()] * 7 + [pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], _FIELDS)


def _laid_out(centroids: np.ndarray):
    """Blocks of vectors, assigned for the first time: every vector is rescanned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = centroids.shape
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                v = np.asarray(part.column(1).flatten(), np.int64).reshape(part.num_rows, dims)
                most = int(np.abs(v).max()) if len(v) else 0
                v = v.astype("<i2" if most < 1 << 15 else "<i4")
                ids = part.column(0)
                block = Block(np.asarray(ids.fill_null(0), np.int64), np.asarray(ids.is_valid()), v, np.full(len(v), 255, np.uint8), [[] for _ in range(k)])
                yield _batch([block.written(*block.rescan(list(range(len(v))), centroids, np.zeros(k)))])

    return run


def _round(centroids: np.ndarray, drift: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                block = Block.read({n: batch.column(i)[r].as_py() for i, n in enumerate(_FIELDS[:7])}, centroids.shape[1])
                yield _batch([block.written(*block.rescan(block.expired(drift), centroids, drift))])

    return run


def _ended(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                block = Block.read({n: batch.column(i)[r].as_py() for i, n in enumerate(_FIELDS[:7])}, centroids.shape[1])
                c = block.cluster.astype(np.int64)
                d = squared_distances(block.vectors, centroids)[np.arange(len(c)), c]
                yield pa.RecordBatch.from_arrays([pa.array(block.ids, mask=~block.known), pa.array(c, pa.int32()), pa.array(d, pa.int64())], ["vec_id", "cluster", "distance"])

    return run


def _changes(state: DataFrame, k: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Summed changes of all blocks, exactly: ``k * (dims + 1)`` rows."""
    each = state.select(F.posexplode("moved").alias("at", "x")).groupBy("at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    out = np.zeros(k * (dims + 1), object)
    for at, x in each.collect():
        out[at] = int(x)
    return out[: k * dims].reshape(k, dims), out[k * dims :]


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every whole vector (vec_id, embedding), and the final centroids."""
    if not 0 < clusters < 255:
        raise ValueError("clusters must be between 1 and 254")
    rows = integer_vectors(vectors, dims, scale)
    centroids = first_centroids(rows, clusters, dims, seed)
    if not len(centroids):
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).where("false"), centroids
    state = materialize(rows.mapInArrow(_laid_out(centroids), STATE), "kmeans-blocks")
    drift = np.zeros(len(centroids))
    sums, n = np.zeros(centroids.shape, object), np.zeros(len(centroids), object)
    for _ in range(rounds):
        more, more_n = _changes(state, *centroids.shape)
        sums, n = sums + more, n + more_n
        new = np.array([[s // c for s in row] if c else old for row, c, old in zip(sums.tolist(), n.tolist(), centroids.tolist(), strict=True)], np.int64)
        if np.array_equal(new, centroids):
            break  # and so would every further round
        drift = drift + drifts(centroids, new)
        centroids = new
        state = materialize(state.mapInArrow(_round(centroids, drift), STATE), "kmeans-blocks", state)
    found = materialize(state.mapInArrow(_ended(centroids), "vec_id long, cluster int, distance long"), "kmeans-found", state)
    return found, centroids


def report(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``found`` with cluster_inertia, inertia and centroid_sha256: a row a cluster, broadcast."""
    spark = found.sparkSession
    names = [(j, ",".join(map(str, c))) for j, c in enumerate(centroids.tolist())]
    told = spark.createDataFrame(names, "cluster int, components string").select("cluster", F.sha2("components", 256).alias("centroid_sha256"))
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = sums.agg(F.sum("cluster_inertia").alias("inertia"))
    return found.join(F.broadcast(sums.join(told, "cluster").crossJoin(whole)), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(*cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))
