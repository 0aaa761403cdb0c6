"""Centroid clustering: rounds of assignment by Orchard's search and exact means of whole numbers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderweir.session import stored

#: A component x becomes floor(SCALE * x).
SCALE = 1_024
#: Whole numbers beyond this are set to it, so that every squared distance of 64 components fits a long.
MOST = 1 << 27
#: Rows that one step of the search holds.
ROWS = 4_096

PARTIAL = "cluster int, n long, sums array<long>"


def kept_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 64) -> DataFrame:
    """(vec_id, v): rows of exactly so many finite components, as whole numbers floor(1024 * x)."""
    wide = F.transform(vector_col, lambda x: x.cast("double"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    whole = lambda x: F.greatest(F.lit(-float(MOST)), F.least(F.lit(float(MOST)), x * SCALE))
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), wide.alias("v"))
        .where((F.size("v") == components) & F.forall("v", finite))
        .select("vec_id", F.transform("v", lambda x: F.floor(whole(x)).cast("int")).alias("v"))
    )


def first_centroids(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors of smallest hash of seed and id; equal hashes in the order of their components."""
    named = kept.where("vec_id is not null")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = named.select(order.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64) if rows else np.empty((0, 0), np.int64)


class Orchard:
    """Nearest centroid of many vectors at once, ties to the smaller number.

    Every centroid lists all others by distance. A vector walks along the list of the best centroid
    so far; a closer one, or an equally close one of smaller number, makes it jump to that one's list. No distance is computed
    twice, and the walk ends where a list's next entry is strictly further than twice the vector's own distance:
    by the triangle inequality everything beyond is further away than the best.
    """

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids.astype(np.int64)
        k = len(centroids)
        apart = np.stack([((self.centroids - c) ** 2).sum(axis=1) for c in self.centroids])
        self.lists = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.lists, axis=1)
        #: Walks start from the best of a few centroids.
        self.starts = range(0, k, max(1, round(k**0.5)))
        self.measured = 0

    def _measure(self, v: np.ndarray, rows: np.ndarray, centroid: np.ndarray) -> np.ndarray:
        self.measured += len(rows)
        apart = v[rows] - self.centroids[centroid]
        return np.einsum("ij,ij->i", apart, apart)

    def __call__(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """v: whole numbers, a row per vector; gives (centroid, squared distance)."""
        n, k = len(v), len(self.centroids)
        everyone = np.arange(n)
        seen = np.zeros((n, k), bool)
        best, far = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
        for c in self.starts:
            seen[:, c] = True
            d = self._measure(v, everyone, np.full(n, c))
            closer = d < far
            best[closer], far[closer] = c, d[closer]
        spot = np.zeros(n, np.int64)
        walking = everyone
        while len(walking):
            walking = walking[spot[walking] < k]
            # Goes on unless apart > 2 * distance; of the squares a fourth is compared, which cannot overflow.
            quarter = (self.apart[best[walking], spot[walking]] + 3) // 4
            walking = walking[quarter <= far[walking]]
            other = self.lists[best[walking], spot[walking]]
            spot[walking] += 1
            new = ~seen[walking, other]
            rows, other = walking[new], other[new]
            seen[rows, other] = True
            d = self._measure(v, rows, other)
            closer = (d < far[rows]) | ((d == far[rows]) & (other < best[rows]))
            rows = rows[closer]
            best[rows], far[rows], spot[rows] = other[closer], d[closer], 0
        return best, far


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, whole numbers) of up to ROWS vectors."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            v = part.column(1)
            flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield part.column(0), flat.reshape(part.num_rows, -1)


def _sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per task: size and component sums of each centroid's vectors."""
    search = Orchard(centroids)
    counts = np.zeros(len(centroids), np.int64)
    sums = np.zeros(centroids.shape, np.int64)
    for _, v in _pieces(batches):
        best, _ = search(v)
        order = np.argsort(best, kind="stable")
        found, starts = np.unique(best[order], return_index=True)
        counts += np.bincount(best, minlength=len(centroids))
        sums[found] += np.add.reduceat(v[order], starts, axis=0)
    own = np.flatnonzero(counts)
    columns = [pa.array(own, pa.int32()), pa.array(counts[own]), pa.array(list(sums[own]), pa.list_(pa.int64()))]
    yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", "sums"])


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    search = Orchard(centroids)
    for ids, v in _pieces(batches):
        best, far = search(v)
        yield pa.RecordBatch.from_arrays([ids, pa.array(best, pa.int32()), pa.array(far)], names=["vec_id", "cluster", "distance"])


def means(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: floor(sum / count) of each one's vectors; one without vectors stays.

    Tasks send one row per centroid; sums are exact decimals, and the driver sees one row per centroid and component.
    """
    parts = kept.mapInArrow(partial(_sums, centroids=centroids), PARTIAL)
    parts = parts.select("cluster", "n", F.posexplode("sums").alias("i", "x"))
    exact = lambda name: F.sum(F.col(name).cast("decimal(38,0)")).alias(name)
    after = centroids.copy()
    for row in parts.groupBy("cluster", "i").agg(exact("n"), exact("x")).collect():
        after[row["cluster"], row["i"]] = int(row["x"]) // int(row["n"])
    return after


def cluster(
    vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, components: int = 64,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every kept vector, stored, and the final centroids.

    Each round assigns all vectors and moves the centroids; the vectors are written once as whole numbers and
    every round is one pass over them with a shuffle of k rows a task. Only centroids go through the driver.

    * null, shorter, longer vectors and those with a null or non-finite component take no part; a null id does,
      but never starts a centroid; components beyond +-2^27 / 1024 count as that.
    * repeated rows: each counts, and each may start a centroid; ties go to the smaller centroid number.
    * fewer than k vectors: as many centroids. No row with an id: empty result, no centroids. Other columns are not read.
    """
    kept = stored(kept_vectors(vectors, id_col, vector_col, components), "centroid-vectors")
    centroids = first_centroids(kept, k, seed)
    if not len(centroids):
        nobody = kept.where("false").select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return nobody, centroids
    for _ in range(rounds):
        centroids = means(kept, centroids)
    found = kept.mapInArrow(partial(_assigned, centroids=centroids), "vec_id long, cluster int, distance long")
    return stored(found, "centroid-clusters"), centroids


def described(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds to each vector its cluster's and the whole inertia, and its centroid's checksum.

    Sums that do not fit a long are null. One row per centroid is sent to all tasks.
    """
    spark = found.sparkSession
    texts = [",".join(str(x) for x in row) for row in centroids.tolist()]
    sums = [(i, hashlib.sha256(text.encode()).hexdigest()) for i, text in enumerate(texts)]
    named = spark.createDataFrame(sums, "cluster int, centroid_sha256 string")
    per = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("_own"))
    whole = per.agg(F.sum("_own").alias("_all"))
    small = stored(per.join(named, "cluster").join(whole), "centroid-sums")  # one row per centroid
    return found.join(F.broadcast(small), "cluster").select(
        "vec_id",
        "cluster",
        "distance",
        F.col("_own").try_cast("long").alias("cluster_inertia"),
        F.col("_all").try_cast("long").alias("inertia"),
        "centroid_sha256",
    )
