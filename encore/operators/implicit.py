"""Implicit ALS for many factors: a system has as many equations as a vector has ratings, where these are fewer than the rank.

MLlib solves ``rank`` equations for each vector, at rank cubed a vector and half step,
which is most of a fit's time from some 50 factors on. The same system

    (Y'Y + Z'CZ + reg m I) x = Z'w

(Y: the other side's vectors; Z: those of the n rated ones; c = alpha |rating|; w = 1 + c,
0 for ratings of 0 or less; m: positive ratings) is solved in the basis Q of the
eigenvectors of Y'Y, which one decomposition a half step gives. There Y'Y + reg m I is a
diagonal D for any m, and

    x = D^-1 Z'y,    (I + C Z D^-1 Z') y = w

has n equations. Vectors with ``rank`` ratings or more are solved as they stand.

A half step is one shuffle: blocks of vectors send each block of the other side the
vectors that it has ratings of, once. It starts from MLlib's own initial vectors and
keeps vectors as floats between half steps, as MLlib does.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vectors that a block's ratings name, at most, on average over the blocks; more ratings make more blocks.
BLOCK_BYTES = 128 << 20
#: Rated vectors that are solved at once.
BATCH_BYTES = 16 << 20


@dataclass
class Block:
    """One side's vectors of a block; ``rows`` are places among the vectors that it is sent, ordered by sending block and id."""

    ids: np.ndarray
    starts: np.ndarray      # the ratings of ids[i] are starts[i]:starts[i + 1]
    rows: np.ndarray
    ratings: np.ndarray
    out: dict[int, np.ndarray]  # block of the other side -> places of the vectors it needs


@dataclass
class Solved:
    block: int
    ids: np.ndarray
    vectors: np.ndarray
    out: dict[int, np.ndarray]


def block_count(ratings: int, rank: int, wanted: int) -> int:
    return max(wanted, -(-ratings * rank * 4 // BLOCK_BYTES))


def _pack(table: pa.Table) -> pa.Table:
    """A block's ratings as one row, and the vectors it needs from each block of the other side."""
    own, other, of, rating = (table[c].to_numpy() for c in ("own", "other", "other_block", "rating"))
    order = np.lexsort((rating, other, own))
    ids, first = np.unique(own[order], return_index=True)
    key = (of[order].astype(np.int64) << 32) + (other[order].astype(np.int64) + 2**31)
    need, rows = np.unique(key, return_inverse=True)
    wanted = {int(b): ((need[need >> 32 == b] & (2**32 - 1)) - 2**31).astype(np.int32) for b in np.unique(need >> 32)}
    data = pickle.dumps((ids, np.append(first, len(order)), rows.astype(np.int32), rating[order].astype(np.float64), wanted))
    return pa.table({"block": pa.array([table["own_block"][0].as_py()], pa.int32()), "data": pa.array([data], pa.binary())})


def _pack_vectors(table: pa.Table) -> pa.Table:
    ids = table["id"].to_numpy()
    order = np.argsort(ids)
    vectors = table["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)[order]
    return pa.table({"block": table["block"][:1].cast(pa.int32()), "data": pa.array([pickle.dumps((ids[order], vectors))], pa.binary())})


def _unpack_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column("data").to_pylist():
            ids, vectors = pickle.loads(data)
            for a in range(0, len(ids), 4096):
                part = vectors[a:a + 4096]
                offsets = pa.array(np.arange(len(part) + 1) * vectors.shape[1], pa.int32())
                yield pa.record_batch({"id": pa.array(ids[a:a + 4096], pa.int32()),
                                       "features": pa.ListArray.from_arrays(offsets, pa.array(part.ravel(), pa.float32()))})


def _pairs(packed: DataFrame) -> RDD:
    return packed.rdd.map(lambda r: (r["block"], pickle.loads(r["data"])))


def _place(column: str, blocks: int):
    return F.pmod(F.hash(column), F.lit(blocks))


def _sides(data: DataFrame, user: str, item: str, rating: str, blocks: tuple[int, int]) -> tuple[RDD, RDD]:
    """(user blocks, item blocks) as (number, Block)."""
    ub, ib = blocks
    rows = data.select(user, item, F.col(rating).alias("rating"), _place(user, ub).alias("ub"), _place(item, ib).alias("ib"))

    def packed(own, other, own_block, other_block):
        side = rows.select(F.col(own).alias("own"), F.col(other).alias("other"), "rating",
                           F.col(own_block).alias("own_block"), F.col(other_block).alias("other_block"))
        return _pairs(side.groupBy("own_block").applyInArrow(_pack, "block int, data binary")).persist(StorageLevel.MEMORY_AND_DISK)

    def complete(side, others, n):
        needed = others.flatMap(lambda x: [(b, (x[0], ids)) for b, ids in x[1][4].items()])

        def joined(parts):
            for block, values in parts:
                own = next(v for v in values if len(v) == 5)
                out = {v[0]: np.searchsorted(own[0], v[1]) for v in values if len(v) == 2}
                yield block, Block(*own[:4], out)
        return side.union(needed).groupByKey(n).mapPartitions(joined).persist(StorageLevel.MEMORY_AND_DISK)

    users, items = packed(user, item, "ub", "ib"), packed(item, user, "ib", "ub")
    sides = complete(users, items, ub), complete(items, users, ib)
    for side in sides:
        side.count()
    users.unpersist()
    items.unpersist()
    return sides


def solve(block: Block, sent: np.ndarray, basis: tuple[np.ndarray, np.ndarray], reg: float, alpha: float) -> np.ndarray:
    """The block's vectors; ``sent`` are the rated vectors, ``basis`` the eigenvalues and eigenvectors of Y'Y."""
    values, q = basis
    rank = len(values)
    z = sent.astype(np.float64) @ q
    x = np.zeros((len(block.ids), rank))
    sizes = np.diff(block.starts)
    for n in np.unique(sizes):
        alike = np.flatnonzero(sizes == n)
        step = max(1, BATCH_BYTES // (8 * rank * int(n)))
        for a in range(0, len(alike), step):
            at = alike[a:a + step]
            places = block.starts[at][:, None] + np.arange(n)
            rating, rows = block.ratings[places], block.rows[places]
            c = alpha * np.abs(rating)
            w = np.where(rating > 0, 1 + c, 0.0)
            m = (rating > 0).sum(1)
            # Without a positive rating w is 0, and so is x.
            d = np.where(m[:, None] > 0, values + reg * m[:, None], 1.0)
            if n < rank:
                own = z[rows]
                scaled = own / d[:, None, :]
                system = c[:, :, None] * (own @ scaled.transpose(0, 2, 1))
                system[:, np.arange(n), np.arange(n)] += 1
                x[at] = (np.linalg.solve(system, w[:, :, None]).transpose(0, 2, 1) @ scaled)[:, 0]
            else:
                system, right = np.zeros((len(at), rank, rank)), np.zeros((len(at), rank, 1))
                system[:, np.arange(rank), np.arange(rank)] = d
                most = max(rank, BATCH_BYTES // (8 * rank))  # a vector of any number of ratings is summed up in parts
                for b in range(0, n, most):
                    own = z[rows[:, b:b + most]]
                    system += own.transpose(0, 2, 1) @ (c[:, b:b + most, None] * own)
                    right += own.transpose(0, 2, 1) @ w[:, b:b + most, None]
                x[at] = np.linalg.solve(system, right)[:, :, 0]
    return (x @ q.T).astype(np.float32)


def _messages(solved: RDD) -> RDD:
    return solved.flatMap(lambda s: [(b, (s.block, s.vectors[places])) for b, places in s.out.items()])


def _basis(solved: RDD) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of the Gram matrix; a block gives a rank x rank sum."""
    def gram(s):
        v = s.vectors.astype(np.float64)
        return v.T @ v
    values, q = np.linalg.eigh(solved.map(gram).treeReduce(np.add))
    return np.maximum(values, 0.0), q


def _half(solved: RDD, side: RDD, blocks: int, reg: float, alpha: float) -> RDD:
    """The other side's vectors from this side's."""
    basis = _basis(solved)

    def run(parts):
        for block, values in parts:
            own, sent = None, []
            for v in values:
                if isinstance(v, Block):
                    own = v
                else:
                    sent.append(v)
            rows = np.concatenate([v for _, v in sorted(sent, key=lambda x: x[0])])
            yield Solved(block, own.ids, solve(own, rows, basis, reg, alpha), own.out)
    return side.union(_messages(solved)).groupByKey(blocks).mapPartitions(run)


def factorize(data: DataFrame, first: DataFrame, rank: int, reg: float, alpha: float, max_iter: int, blocks: tuple[int, int],
              user: str, item: str, rating: str, checkpoint_interval: int = 10) -> tuple[DataFrame, DataFrame]:
    """((id, features) of users, of items) after ``max_iter`` iterations from the users' ``first`` vectors."""
    ub, ib = blocks
    users, items = _sides(data, user, item, rating, blocks)
    begun = _pairs(first.select("id", "features", _place("id", ub).alias("block")).groupBy("block").applyInArrow(_pack_vectors, "block int, data binary"))

    def start(parts):
        for block, values in parts:
            own = next(v for v in values if isinstance(v, Block))
            ids, vectors = next(v for v in values if not isinstance(v, Block))
            yield Solved(block, own.ids, vectors[np.searchsorted(ids, own.ids)], own.out)
    found = users.union(begun).groupByKey(ub).mapPartitions(start).persist(StorageLevel.MEMORY_AND_DISK)
    kept = [found]
    for n in range(max_iter):
        of_items = _half(found, items, ib, reg, alpha).persist(StorageLevel.MEMORY_AND_DISK)
        if checkpoint_interval > 0 and (n + 1) % checkpoint_interval == 0:
            of_items.checkpoint()
        found = _half(of_items, users, ub, reg, alpha).persist(StorageLevel.MEMORY_AND_DISK)
        kept += [of_items, found]
        while len(kept) > 3:  # what the new vectors are made from stays until they are
            kept.pop(0).unpersist()

    def frame(solved):
        packed = solved.map(lambda s: (pickle.dumps((s.ids, s.vectors)),))
        return data.sparkSession.createDataFrame(packed, "data binary").mapInArrow(_unpack_vectors, "id int, features array<float>")
    return frame(found), frame(of_items)
