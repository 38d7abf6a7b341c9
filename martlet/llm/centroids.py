"""Centroid clustering with heap-ordered bounds.

A vector that was compared with all centroids knows its distance to the nearest (upper)
and to the second nearest (lower). While centroids move, the gap between the two shrinks
by at most the drift of its own centroid and the largest drift of the others, which is
the same for all vectors of a cluster. So every cluster orders its vectors by gap plus
the drift the cluster had accumulated when the gap was measured; a vector is compared
again only once the accumulated drift has reached its key.

The heaps are written runs: a round writes the vectors it has popped and compared, with
their new keys, sorted by cluster and key. Drift only grows, so a round pops the entries
whose keys lie between the drift before and now, which Parquet's statistics narrow to
few row groups; no run is ever rewritten. Vectors are whole numbers, so sums of clusters
are exact and are kept up by the vectors that change cluster.
"""

from __future__ import annotations

import hashlib
import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlet.llm.common import ship
from martlet.session import fresh_path, written

#: Components up to this keep a squared distance of 64 components within 64 bits.
LARGEST = 1 << 27
#: Gaps lose this share, against rounding.
SLACK = 1e-9
#: Bytes of a row group of a run: what a pop reads at least.
ROW_GROUP = 4 << 20
_RUN = "cluster int, key double, moved boolean, old int, vec_id long, v array<long>"


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole vectors (rows) to whole centroids (columns)."""
    out = np.empty((len(x), len(centroids)), dtype=np.int64)
    for j, c in enumerate(centroids):
        apart = x - c
        out[:, j] = np.einsum("ij,ij->i", apart, apart)
    return out


def gaps(squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest column of each row (the first of equals), and how much farther the second
    is; infinite where there is one column."""
    nearest = squares.argmin(axis=1)
    rows = np.arange(len(squares))
    upper = np.sqrt(squares[rows, nearest])
    rest = squares.astype(np.float64)
    rest[rows, nearest] = np.inf
    lower = np.sqrt(rest.min(axis=1))
    return nearest, lower * (1 - SLACK) - upper * (1 + SLACK)


def drifts(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How much the gaps of each cluster may shrink when centroids move."""
    moved = np.sqrt([float(sum(int(x) ** 2 for x in row)) for row in new - old]) * (1 + SLACK)
    others = [max(np.delete(moved, j), default=0.0) for j in range(len(moved))]
    return moved + np.array(others)


def _rows(batch, column: str, dim: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _compared(popped: DataFrame, centroids: np.ndarray, drift: np.ndarray) -> DataFrame:
    """Rows of a run for ``popped`` (vec_id, v, cluster: the one so far)."""
    import pyarrow as pa

    dim = centroids.shape[1]

    def run(batches):
        for batch in batches:
            old = batch.column("cluster")
            cluster, gap = gaps(distances(_rows(batch, "v", dim), centroids))
            moved = cluster != old.fill_null(-1).to_numpy(zero_copy_only=False)
            # ties are popped as soon as their cluster's drift grows at all
            key = np.maximum(gap + drift[cluster], np.nextafter(drift[cluster], np.inf))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cluster, pa.int32()), pa.array(key), pa.array(moved), old,
                 batch.column("vec_id"), batch.column("v")],
                names=["cluster", "key", "moved", "old", "vec_id", "v"])

    return popped.select("vec_id", "v", "cluster").mapInArrow(run, _RUN)


def _changes(run: DataFrame, k: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """What the vectors of a run that moved add to counts and sums of the clusters, as
    lists of exact numbers: one row of each for each cluster and task is added up."""
    import pyarrow as pa

    def add(batches):
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dim), dtype=np.int64)
        for batch in batches:
            x = _rows(batch, "v", dim)
            for sign, name in ((1, "cluster"), (-1, "old")):
                at = batch.column(name).fill_null(-1).to_numpy(zero_copy_only=False)
                for j in np.unique(at[at >= 0]):
                    counts[j] += sign * (at == j).sum()
                    sums[j] += sign * x[at == j].sum(axis=0)
        some = np.flatnonzero((counts != 0) | (sums != 0).any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(counts[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "s"])

    parts = run.filter("moved").select("cluster", "old", "v").mapInArrow(add, "cluster int, n long, s array<long>")
    # one value for each component of each cluster
    each = parts.select("cluster", "n", F.posexplode_outer("s").alias("at", "x")).groupBy("cluster", "at").agg(
        F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")
    )
    counts, sums = np.zeros(k, dtype=object), np.zeros((k, dim), dtype=object)
    for row in each.collect():  # k x dim rows
        counts[row["cluster"]] = row["n"]
        sums[row["cluster"], row["at"]] = int(row["x"])
    return counts, sums


class Heaps:
    """The runs of all rounds; an entry is live while its key is above the drift."""

    def __init__(self, spark: SparkSession):
        self.spark, self.runs = spark, []

    def push(self, rows: DataFrame) -> DataFrame:
        path = fresh_path(self.spark, "centroids")
        rows.sortWithinPartitions("cluster", "key").write.option("parquet.block.size", ROW_GROUP).parquet(path)
        self.runs.append(path)
        return self.spark.read.schema(_RUN).parquet(path)

    def _between(self, above: np.ndarray, upto: np.ndarray) -> DataFrame:
        """Entries whose keys lie above one value of their cluster and at most at another."""
        def inside(j: int) -> Column:
            low, high = float(above[j]), float(upto[j])
            return (F.col("cluster") == j) & (F.col("key") > low) & (F.col("key") <= high)

        wanted = [inside(j) for j in range(len(above)) if upto[j] > above[j]]
        rows = self.spark.read.schema(_RUN).parquet(*self.runs)
        return rows.filter(reduce(Column.__or__, wanted)) if wanted else rows.limit(0)

    def pop(self, before: np.ndarray, now: np.ndarray) -> DataFrame:
        return self._between(before, now)

    def live(self, drift: np.ndarray) -> DataFrame:
        return self._between(drift, np.full(len(drift), math.inf))


def whole(embedding: Column | str, scale: int) -> Column:
    """Components times ``scale``, rounded down."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def cluster_vectors(
    vectors: DataFrame, dim: int = 64, k: int = 8, rounds: int = 10, scale: int = 1024, salt: str = "3:"
) -> DataFrame:
    """Clusters of ``vectors`` (vec_id, embedding) after ``rounds`` rounds of assigning
    every vector to its nearest centroid and moving centroids to the floor of their mean.

    Vectors with exactly ``dim`` components, none null or non-finite, take part and are
    returned; each component becomes floor(scale x component). The first centroids are
    the ``k`` vectors (all, if fewer) with the smallest SHA-256 of ``salt`` and id; null
    ids come last, and equal ids go by their components. Ties between centroids go to the
    smaller number, empty clusters stay where they are, repeated rows are vectors of their
    own, and an empty table gives an empty result. Other columns are not looked at.
    Components beyond 2^27 after scaling raise an error, as their squared distances do
    not fit 64 bits. ``k`` is a number of clusters that the driver can hold with their
    sums. Returns vec_id, cluster, distance (squared), cluster_inertia, inertia and
    centroid_sha256.
    """
    ship(__name__)
    spark = vectors.sparkSession
    good = (F.size("embedding") == dim) & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    kept = vectors.filter(F.col("embedding").isNotNull() & good).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole("embedding", scale).alias("v")
    )
    too_large = F.exists("v", lambda x: F.abs(x) > LARGEST)
    kept = kept.withColumn("v", F.when(too_large, F.raise_error(F.lit("a component is too large"))).otherwise(F.col("v")))
    drawn = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = kept.orderBy(drawn.asc_nulls_last(), "v").limit(k).select("v").collect()
    if not first:
        return kept.select(
            "vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
            F.lit("").alias("centroid_sha256"),
        )
    centroids = np.array([r["v"] for r in first], dtype=np.int64)
    k = len(centroids)
    heaps, drift = Heaps(spark), np.zeros(k)
    counts, sums = np.zeros(k, dtype=object), np.zeros((k, dim), dtype=object)
    popped = kept.withColumn("cluster", F.lit(None).cast("int"))
    for _ in range(rounds):
        run = heaps.push(_compared(popped, centroids, drift))
        n, s = _changes(run, k, dim)
        counts, sums = counts + n, sums + s
        moved = np.array([
            [int(x) // int(c) for x in row] if c else list(own)
            for row, c, own in zip(sums, counts, centroids.tolist())
        ], dtype=np.int64)
        before, drift = drift, drift + drifts(centroids, moved)
        # nothing moved: later rounds would change nothing
        if (moved == centroids).all():
            popped = None
            break
        centroids, popped = moved, heaps.pop(before, drift)
    if popped is not None:
        heaps.push(_compared(popped, centroids, drift))
    return _described(heaps.live(drift), centroids)


def _described(live: DataFrame, centroids: np.ndarray) -> DataFrame:
    import pyarrow as pa

    dim = centroids.shape[1]

    def run(batches):
        for batch in batches:
            cluster = batch.column("cluster").to_numpy(zero_copy_only=False)
            apart = _rows(batch, "v", dim) - centroids[cluster]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("cluster"), pa.array(np.einsum("ij,ij->i", apart, apart))],
                names=["vec_id", "cluster", "distance"])

    placed = written(
        live.select("vec_id", "cluster", "v").mapInArrow(run, "vec_id long, cluster int, distance long"), "placed"
    )
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    each = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    summed = each.withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy()))  # k rows
    digests = F.array(*[F.lit(n) for n in names])
    return placed.join(F.broadcast(summed), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        F.element_at(digests, F.col("cluster") + 1).alias("centroid_sha256"),
    )
