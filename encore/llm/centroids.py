"""Centroid clustering: Lloyd's rounds in which tasks hold column blocks of the vectors.

The vectors are cut once into tiles, a run of rows by a block of columns, and
written. In a round, a task that holds a tile knows only the centroids' slice of
those columns: it gives the tile's exact partial squared distances. The tiles of
a run of rows are added up by the run's key, which gives every row's nearest
centroid (ties: the smaller number). The assignment goes back to the tiles, and
every column block sums its own columns by cluster, in tasks first and then over
all, and floors the means: each block updates its own slice. All arithmetic is
on integers, so results do not depend on the order of tiles.

Kept are vectors with exactly ``dims`` components, none null or not finite;
null and shorter vectors have no row in the results. A null id is an id as any
other. Rows that repeat an id are vectors of their own. With fewer kept vectors
than ``k`` there are as many centroids as vectors, with none the result is empty.
Components of 2^26 and more after scaling raise ``OverflowError``: exact sums
need not fit 64 bits then. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.sources.tables import materialize

#: Rows a tile: a row of the tile table stays within tens of kilobytes, whatever a task reads at once.
TILE_ROWS = 256
LIMIT = 1 << 26
#: Centroids are sent to every task; what they may take at most.
MAX_CENTROID_BYTES = 64 << 20
IDS = -1  # the block number of the rows that hold a run's ids


@dataclass
class Clusters:
    tiles: DataFrame           # (tile, block, n, data, ids)
    nearest: DataFrame | None  # (tile, cluster, distance): packed by tile
    centroids: np.ndarray      # integers, centroids x columns


def kept_vectors(vectors: DataFrame, id_col: str, vec_col: str, dims: int) -> DataFrame:
    """(id, v): rows whose vector has ``dims`` finite components, as doubles."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(F.size(v).eqNullSafe(dims) & F.coalesce(finite, F.lit(False))).select(F.col(id_col).alias("id"), v.alias("v"))


def _scaled(flat: np.ndarray, dims: int, scale: float) -> np.ndarray:
    x = np.floor(flat.reshape(-1, dims) * scale)
    if len(x) and np.abs(x).max() >= LIMIT:
        raise OverflowError(f"a component is {LIMIT} or more after scaling by {scale}")
    return x.astype(np.int32)


def _cut(dims: int, block: int, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column("id")
            x = _scaled(batch.column("v").flatten().to_numpy(zero_copy_only=False), dims, scale)
            for a in range(0, len(x), TILE_ROWS):
                rows = x[a:a + TILE_ROWS]
                parts = [np.ascontiguousarray(rows[:, c:c + block]).tobytes() for c in range(0, dims, block)]
                held = ids.slice(a, len(rows))
                m = len(parts)
                yield pa.record_batch({
                    "tile": pa.array([tile] * (m + 1), pa.int64()), "block": pa.array([IDS, *range(m)], pa.int32()),
                    "n": pa.array([len(rows)] * (m + 1), pa.int32()), "data": pa.array([None, *parts], pa.binary()),
                    "ids": pa.ListArray.from_arrays(pa.array([0] + [len(held)] * (m + 1), pa.int32()), held)})
                tile += 1
    return run


def _distances(centroids: np.ndarray, block: int):
    """Partial squared distances of a tile's rows to all centroids, over the tile's columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for b, n, data in zip(batch.column("block").to_pylist(), batch.column("n").to_pylist(), batch.column("data")):
                c = centroids[:, b * block:(b + 1) * block]
                x = np.frombuffer(data.as_buffer(), np.int32).reshape(n, -1).astype(np.int64)
                bound = int(np.abs(x).max(initial=0)) * int(np.abs(c).max(initial=0)) * c.shape[1]
                # Doubles are exact up to 2^53, and their product is the faster one.
                dot = (x.astype(float) @ c.T.astype(float)).astype(np.int64) if bound < 1 << 53 else x @ c.T
                out.append(((x * x).sum(1)[:, None] - 2 * dot + (c * c).sum(1)[None, :]).tobytes())
            yield pa.record_batch({"tile": batch.column("tile"), "part": pa.array(out, pa.binary())})
    return run


def _nearest(k: int, blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = [], []
            for parts in batch.column("parts"):
                if len(parts.values) != blocks:
                    raise RuntimeError("a tile of a run of rows is missing")
                total = sum(np.frombuffer(p.as_buffer(), np.int64) for p in parts.values).reshape(-1, k)
                at = total.argmin(1)  # the first of equal ones
                cluster.append(at.astype(np.int32).tobytes())
                distance.append(total[np.arange(len(at)), at].tobytes())
            yield pa.record_batch({"tile": batch.column("tile"), "cluster": pa.array(cluster, pa.binary()), "distance": pa.array(distance, pa.binary())})
    return run


def _sums(k: int):
    """Per block and cluster: the rows and the column sums of a task's tiles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for b, n, data, cluster in zip(batch.column("block").to_pylist(), batch.column("n").to_pylist(), batch.column("data"), batch.column("cluster")):
                x = np.frombuffer(data.as_buffer(), np.int32).reshape(n, -1).astype(np.int64)
                at = np.frombuffer(cluster.as_buffer(), np.int32)
                counts, sums = totals.setdefault(b, (np.zeros(k, np.int64), np.zeros((k, x.shape[1]), np.int64)))
                counts += np.bincount(at, minlength=k)
                np.add.at(sums, at, x)
        rows = [(b, c, int(counts[c]), sums[c].tolist()) for b, (counts, sums) in totals.items() for c in np.flatnonzero(counts).tolist()]
        if rows:
            blocks, clusters, ns, values = zip(*rows)
            yield pa.record_batch({"block": pa.array(blocks, pa.int32()), "cluster": pa.array(clusters, pa.int32()),
                                   "n": pa.array(ns, pa.int64()), "sums": pa.array(values, pa.list_(pa.int64()))})
    return run


def _assign(tiles: DataFrame, centroids: np.ndarray, block: int) -> DataFrame:
    k, blocks = len(centroids), -(-centroids.shape[1] // block)
    parts = tiles.where(F.col("block") >= 0).select("tile", "block", "n", "data").mapInArrow(_distances(centroids, block), "tile long, part binary")
    added = parts.groupBy("tile").agg(F.collect_list("part").alias("parts"))  # one part a column block
    return added.mapInArrow(_nearest(k, blocks), "tile long, cluster binary, distance binary")


def fit(vectors: DataFrame, id_col: str, vec_col: str, dims: int, k: int = 16, rounds: int = 3, scale: float = 64.0, seed: int = 1,
        block: int = 16) -> Clusters:
    """Cluster the kept vectors' components ``floor(scale * x)``.

    Centroids start as the k vectors of smallest sha256 of ``seed:id`` (ties:
    by the vector). A round replaces a centroid by the floor of its vectors'
    mean; an empty one stays. The last assignment is to the final centroids.
    """
    if k * dims * 8 > MAX_CENTROID_BYTES:
        raise ValueError(f"{k} centroids of {dims} columns exceed {MAX_CENTROID_BYTES} bytes")
    kept = kept_vectors(vectors, id_col, vec_col, dims)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = kept.withColumn("h", key).orderBy("h", "v").limit(k).collect()
    id_type = kept.schema["id"].dataType.simpleString()
    tiles = materialize(kept.mapInArrow(_cut(dims, block, scale), f"tile long, block int, n int, data binary, ids array<{id_type}>"),
                        "tiles", partition_by=["block"])
    centroids = _scaled(np.array([r["v"] for r in first], float), dims, scale).astype(np.int64)
    if not len(centroids):
        return Clusters(tiles, None, centroids)
    for _ in range(rounds):
        held = tiles.where(F.col("block") >= 0).select("tile", "block", "n", "data").join(_assign(tiles, centroids, block).select("tile", "cluster"), "tile")
        sums = held.mapInArrow(_sums(len(centroids)), "block int, cluster int, n long, sums array<long>")
        total = (sums.select("block", "cluster", "n", F.posexplode("sums").alias("column", "s"))
                     .groupBy("block", "cluster", "column").agg(F.sum("n").alias("n"), F.sum("s").alias("s")))
        # One row a component of a centroid: the parameters bound them.
        for r in total.select("block", "cluster", "column", F.expr("(s - pmod(s, n)) div n").alias("mean")).collect():
            centroids[r["cluster"], r["block"] * block + r["column"]] = r["mean"]
    return Clusters(tiles, materialize(_assign(tiles, centroids, block), "nearest"), centroids)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cluster = np.concatenate([np.frombuffer(x.as_buffer(), np.int32) for x in batch.column("cluster")] or [np.zeros(0, np.int32)])
        distance = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("distance")] or [np.zeros(0, np.int64)])
        yield pa.record_batch({"id": batch.column("ids").flatten(), "cluster": pa.array(cluster), "distance": pa.array(distance)})


def assignments(clusters: Clusters) -> DataFrame:
    """(id, cluster, distance): one row a kept vector, with the squared distance to its centroid."""
    ids = clusters.tiles.where(F.col("block") == IDS).select("tile", "ids")
    id_type = clusters.tiles.schema["ids"].dataType.elementType.simpleString()
    schema = f"id {id_type}, cluster int, distance long"
    if clusters.nearest is None:
        return clusters.tiles.sparkSession.createDataFrame([], schema)
    return ids.join(clusters.nearest, "tile").select("ids", "cluster", "distance").mapInArrow(_rows, schema)


def _inertias(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per cluster: a task's sum of distances, in two halves that can't overflow before they are added."""
    totals: dict[int, list[int]] = {}
    for batch in batches:
        for c, d in zip(batch.column("cluster"), batch.column("distance")):
            c, d = np.frombuffer(c.as_buffer(), np.int32), np.frombuffer(d.as_buffer(), np.int64)
            for cluster in np.unique(c).tolist():
                own = d[c == cluster]
                total = totals.setdefault(cluster, [0, 0])
                total[0] += len(own)
                total[1] += sum(own.tolist())
    rows = [(c, n, str(s)) for c, (n, s) in totals.items()]
    if rows:
        c, n, s = zip(*rows)
        yield pa.record_batch({"cluster": pa.array(c, pa.int32()), "n": pa.array(n, pa.int64()), "s": pa.array(s, pa.string())})


def summary(clusters: Clusters) -> DataFrame:
    """(cluster, n, cluster_inertia, inertia, centroid_sha256): one row a cluster that has vectors.

    Inertias are sums of squared distances over the cluster and over all; a sum
    that does not fit a long is an error.
    """
    spark = clusters.tiles.sparkSession
    found = []
    if clusters.nearest is not None:
        sums = clusters.nearest.select("cluster", "distance").mapInArrow(_inertias, "cluster int, n long, s string")
        found = sums.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()  # k rows
    inertia = sum(int(r["s"]) for r in found)
    if inertia >= 1 << 63:
        raise OverflowError("the inertia does not fit 64 bits")
    rows = [(r["cluster"], r["n"], int(r["s"]), inertia, hashlib.sha256(",".join(map(str, clusters.centroids[r["cluster"]])).encode()).hexdigest()) for r in found]
    return spark.createDataFrame(rows, "cluster int, n long, cluster_inertia long, inertia long, centroid_sha256 string")
