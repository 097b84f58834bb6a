"""Centroid clustering of integer vectors by scalar lookup tables.

Vectors become floor(scale * x) and are written once as blocks of at most ``BLOCK`` rows in which each dimension is dictionary-encoded:
the sorted integers that occur in it and a code per row. A round tabulates, for each dimension of a block, the squared difference of
every occurring integer to every centroid's component; distances are gathers from these tables, summed over the dimensions. The
assignment, counts and sums of a block follow, and Spark adds up the (cluster, dimension) sums, so a round moves ``k * dims`` rows a
task and brings ``k * dims`` sums to the driver, whatever the number of vectors. Vectors never move again.

New centroids are floor(sum / count) in exact integers; empty clusters keep theirs. All arithmetic is on integers, so the result depends
on neither the partitioning nor lost executors; each round starts from the written blocks and a few centroid numbers.

Start: the k vectors with the smallest SHA-256 of ``<seed>:<id>``; among rows of one id, the smaller vector first.

Edge cases: a vector that is null, of another length, or holds a null or non-finite component takes no part; a null id has no hash, so it is
clustered but never a start; ids may repeat, and repeated rows count as often as they stand there; equal distances go to the smaller
cluster number; fewer vectors with an id than k give as many clusters; none give an empty result; a table without rows gives none; extra columns
are ignored whatever their names. An integer of ``2**27`` or more in size raises, as squared distances would not fit 64 bits;
an inertia that does not fit is null. There are no texts here; vectors have the fixed length ``dims``.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.session import materialize

BLOCK, LARGEST = 8192, 2**27
BLOCKS = "ids array<long>, codes array<int>, sizes array<int>, occurring array<long>"


def usable(vec: Column, dims: int) -> Column:
    """True for vectors of the length wanted with finite components only."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vec) == dims) & finite, F.lit(False))


def integers(vec: Column, scale: int) -> Column:
    """floor(scale * x) of every component, x as double."""
    def one(x: Column) -> Column:
        v = F.lit(float(scale)) * x.cast("double")
        return F.when(F.abs(v) < LARGEST, F.floor(v).cast("long")).otherwise(F.raise_error(F.lit("a component is too large to cluster")).cast("long"))
    return F.transform(vec, one)


def _encode(dims: int):
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                rows = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                codes, sizes, values = np.empty(rows.shape, np.int32), [], []
                for d in range(dims):
                    occurring, codes[:, d] = np.unique(rows[:, d], return_inverse=True)
                    sizes.append(len(occurring))
                    values.append(occurring)
                lists = [part.column(0), pa.array(codes.T.ravel()), pa.array(sizes, pa.int32()), pa.array(np.concatenate(values))]
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists],
                                                 ["ids", "codes", "sizes", "occurring"])
    return run


def _blocks(batch: pa.RecordBatch, dims: int):
    """(ids, codes by dimension, occurring integers by dimension) of every block."""
    for k in range(batch.num_rows):
        ids, codes, sizes, values = (batch.column(c)[k].values for c in range(4))
        cuts = np.cumsum(sizes.to_numpy())[:-1]
        yield ids, codes.to_numpy().reshape(dims, -1), np.split(values.to_numpy(), cuts)


def assign(codes: np.ndarray, occurring: list[np.ndarray], centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centroid, squared distance) of every row: one table of squared differences a dimension, gathered and summed."""
    total = np.zeros((codes.shape[1], len(centroids)), np.int64)
    for d, values in enumerate(occurring):
        table = (values[:, None] - centroids[None, :, d]) ** 2
        total += table[codes[d]]
    nearest = total.argmin(axis=1)
    return nearest, total[np.arange(len(nearest)), nearest]


def _sums(centroids: np.ndarray, dims: int):
    """Rows (cluster, dimension, sum, n) of a task's vectors."""
    def run(batches):
        k = len(centroids)
        sums, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for b in batches:
            for _, codes, occurring in _blocks(b, dims):
                nearest, _ = assign(codes, occurring, centroids)
                n += np.bincount(nearest, minlength=k)
                for d, values in enumerate(occurring):
                    # how often each occurring integer falls in each cluster
                    seen = np.bincount(nearest * len(values) + codes[d], minlength=k * len(values)).reshape(k, -1)
                    sums[:, d] += seen @ values
        if n.any():
            cluster, dim = np.divmod(np.arange(k * dims), dims)
            yield pa.RecordBatch.from_arrays([pa.array(cluster.astype(np.int32)), pa.array(dim.astype(np.int32)), pa.array(sums.ravel()),
                                              pa.array(np.repeat(n, dims))], ["cluster", "dim", "total", "n"])
    return run


def _labels(centroids: np.ndarray, dims: int):
    def run(batches):
        for b in batches:
            for ids, codes, occurring in _blocks(b, dims):
                nearest, distance = assign(codes, occurring, centroids)
                yield pa.RecordBatch.from_arrays([ids, pa.array(nearest.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"])
    return run


def next_centroids(blocks: DataFrame, centroids: list[list[int]], dims: int) -> list[list[int]]:
    """One round: assignment, then floor of the mean of every non-empty cluster."""
    parts = blocks.mapInArrow(_sums(np.array(centroids, np.int64), dims), "cluster int, dim int, total long, n long")
    totals = parts.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(28,0)")).alias("total"), F.sum("n").alias("n"))
    new = [list(c) for c in centroids]
    for r in totals.where("n > 0").collect():  # k * dims rows
        new[r.cluster][r.dim] = int(r.total) // r.n
    return new


def cluster_vectors(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3",
                    id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid) of every vector that takes part."""
    spark = vectors.sparkSession
    kept = vectors.where(usable(F.col(vec_col), dims)).select(F.col(id_col).cast("long").alias("id"), integers(F.col(vec_col), scale).alias("vec"))
    start = kept.where("id is not null").select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).alias("hash"), "vec")
    centroids = [list(r.vec) for r in start.orderBy("hash", "vec").limit(k).collect()]
    result = f"{id_col} long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
    if not centroids:
        return spark.createDataFrame([], result)
    blocks = materialize(kept.mapInArrow(_encode(dims), BLOCKS), "centroid-blocks")
    for _ in range(rounds):
        new = next_centroids(blocks, centroids, dims)
        if new == centroids:  # every further round would give the same
            break
        centroids = new
    found = materialize(blocks.mapInArrow(_labels(np.array(centroids, np.int64), dims), "id long, cluster int, distance long"), "centroid-labels")
    inertia = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    fits = lambda n: n if n < 2**63 else None
    rows = [(c, fits(inertia.get(c, 0)), fits(sum(inertia.values())), centroids[c]) for c in range(len(centroids))]
    per_cluster = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    out = found.join(F.broadcast(per_cluster), "cluster")  # k rows
    return out.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid")
