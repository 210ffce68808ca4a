"""Scoring with factor vectors in blocks: exact top-k lists and rank counts without the users x items product.

Item vectors are numbered by falling norm and written in chunks of bounded bytes.
The tasks hold user vectors and get the items by chunks, never more than
``PASS_BYTES`` of them at once; no row a (user, item) pair is made.

* ``top_k``: |u| |v| bounds a score, so once it falls under a user's k-th score no
  later item can enter the list. Blocks of items are skipped by that bound, and
  users that are done leave after each pass. Lists are exact. A pass goes through
  as many chunks as a task may hold, so the users' lists are written once for
  that many items, not once a chunk.
* ``auc_per_user``: for each positive the items scored lower and equal are counted;
  two sums a user and chunk leave a task.

A score is the dot product in doubles, rounded to a float: sums in another order
then give the same score. Equal scores are ordered by item id.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions.ordering import global_row_number
from encore.sources.tables import materialize

U, I = "user_id", "item_id"
#: Items that the driver holds at once, at 8 bytes a component.
CHUNK_BYTES = 32 << 20
#: Items that a task holds at once, at 4 bytes a component: 6.7 million of rank 8, 332,000 of rank 200.
PASS_BYTES = 256 << 20
#: Items scored, and users held, at once: a block of scores stays within a few megabytes.
BLOCK, USERS = 1024, 512
#: Lists longer than a block are held for fewer users: so many entries.
ENTRIES = 4 * BLOCK * USERS
#: Scores of a user that one row holds; more positives are split over rows.
POSITIVES_ROW = 50_000
#: Up to so many positives of a user, comparisons with each take less than sorting the scores.
FEW = 16
#: Users and items whose scores are compared at once.
FEW_USERS, FEW_ITEMS = 64, 8192
#: Rounding to floats may raise a score over the bound of its doubles.
SLACK = 1 + 1e-6
STATE = "user_id long, features array<float>, items array<long>, scores array<float>, scored long, open int"


@dataclass
class ItemBlocks:
    table: DataFrame       # (place, id, features, chunk): place 1 has the largest norm
    items: int
    chunks: int

    def load(self, chunk: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, vectors) of a chunk, by falling norm; its bytes are bounded."""
        held = self.table.where(F.col("chunk") == chunk).select("place", "id", "features").toArrow().combine_chunks()
        order = np.argsort(held["place"].to_numpy())
        return held["id"].to_numpy()[order], _matrix(held["features"].combine_chunks(), len(order))[order].astype(np.float32)


def _norm(vector: np.ndarray) -> float:
    return float(np.sqrt((vector.astype(np.float64) ** 2).sum()))


def _matrix(lists: pa.Array, rows: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1).astype(np.float64)


def item_blocks(factors: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> ItemBlocks:
    """Number (id, features) by falling norm and write them in chunks of at most ``chunk_bytes`` of vectors."""
    norm = F.aggregate("features", F.lit(0.0), lambda a, x: a + x * x)
    rows = factors.select(F.col("id").cast("long").alias("id"), F.col("features").cast("array<float>").alias("features"), norm.alias("norm"))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("rank")).first()
    each = max(1, chunk_bytes // (8 * (facts["rank"] or 1) + 16))
    placed = global_row_number(rows, [F.col("norm").desc(), F.col("id").asc()], out="place")
    placed = placed.select("place", "id", "features", F.floor((F.col("place") - 1) / each).cast("int").alias("chunk"))
    return ItemBlocks(materialize(placed, "item_blocks", partition_by=["chunk"]), facts["n"], -(-facts["n"] // each))


def _best(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (items, scores) of each row from (row, item, score) triples; every row has as many."""
    row, item, score = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((item, -score, row))
    row, item, score = row[order], item[order], score[order]
    first = np.searchsorted(row, np.arange(rows))
    kept = np.arange(len(row)) - first[row] < k
    return item[kept].reshape(rows, -1), score[kept].reshape(rows, -1)


def _error(size: np.ndarray, rank: int, norm: float) -> np.ndarray:
    """What a float sum of float products may differ by from a user's score of a vector of this norm at most."""
    return (rank + 4) * 2.0**-24 * norm * size + 1e-37


def _over(u: np.ndarray, size: np.ndarray, v: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, score) of the scores that are at least their row's ``least``; the first of ``v`` has the largest norm.

    Products in floats leave out what their error cannot lift; the others are scored in doubles.
    """
    rough = np.nextafter((least - _error(size, u.shape[1], _norm(v[0]))).astype(np.float32), np.float32(-np.inf))
    row, column = np.nonzero(u.astype(np.float32) @ v.T >= rough[:, None])
    found = np.empty(len(row), np.float32)
    for a in range(0, len(row), BLOCK * 64):
        part = slice(a, a + BLOCK * 64)
        found[part] = (u[row[part]] * v[column[part]]).sum(1)
    kept = found >= least[row]
    return row[kept], column[kept], found[kept]


def _search(ids: np.ndarray, vectors: np.ndarray, k: int, next_norm: float | None, more: Sequence[Broadcast] = ()):
    """A pass over a chunk and the ``more`` that follow it; ``next_norm`` is the largest norm after them, None after the last."""
    def chunks() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield ids, vectors
        for sent in more:
            yield sent.value

    def block(u: np.ndarray, items: np.ndarray, scores: np.ndarray, scored: np.ndarray):
        size = np.sqrt((u * u).sum(1)) * SLACK
        for i, v in chunks():
            a = b = 0
            while b < len(i):
                # All items enter a list that is not full: long lists are filled in one step, not merged block by block.
                a, b = b, min(len(i), b + max(BLOCK, k - scores.shape[1], k // 4))
                if scores.shape[1] == k:
                    at = np.flatnonzero(size * _norm(v[a]) >= scores[:, -1])
                else:
                    at = np.arange(len(u))
                if not len(at):  # nor for any later item
                    return items, scores, scored, np.zeros(len(u), np.int32)
                scored[at] += b - a
                if scores.shape[1] == k:
                    row, column, found = _over(u[at], size[at], v[a:b], scores[at, -1])
                else:
                    s = (u[at] @ v[a:b].astype(np.float64).T).astype(np.float32)
                    least = np.full(len(at), -np.inf, np.float32)
                    if s.shape[1] > k:  # only scores that can be among a row's k best go on
                        least = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
                    row, column = np.nonzero(s >= least[:, None])
                    found = s[row, column]
                if not len(row):
                    continue
                held = np.repeat(np.arange(len(at)), scores.shape[1])
                best = _best([(held, items[at].ravel(), scores[at].ravel()), (row, i[a + column], found)], len(at), k)
                if scores.shape[1] < best[0].shape[1]:  # every row grows alike until it has k
                    items, scores = best
                else:
                    items[at], scores[at] = best
        still = next_norm is not None and np.ones(len(u), bool)
        if next_norm is not None and scores.shape[1] == k:
            still = size * next_norm >= scores[:, -1]
        return items, scores, scored, np.broadcast_to(still, len(u)).astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            users = max(1, min(USERS, ENTRIES // max(1, k)))
            for start in range(0, len(batch), users):
                part = batch.slice(start, users)
                n = len(part)
                items, scores, scored, still = block(
                    _matrix(part.column("features"), n), part.column("items").flatten().to_numpy(zero_copy_only=False).reshape(n, -1).copy(),
                    part.column("scores").flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.float32),
                    part.column("scored").to_numpy().copy())
                lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                # After the last pass nobody's vector is read again.
                features = part.column("features") if next_norm is not None else pa.nulls(n, pa.list_(pa.float32()))
                yield pa.record_batch({"user_id": part.column("user_id"), "features": features, "items": lists(items),
                                       "scores": lists(scores), "scored": pa.array(scored), "open": pa.array(still)})
    return run


def _user_vectors(factors: DataFrame) -> DataFrame:
    return factors.select(F.col("id").cast("long").alias(U), F.col("features").cast("array<float>").alias("features"))


def top_k(users: DataFrame, items: ItemBlocks, k: int) -> DataFrame:
    """(user_id, items, scores, scored): each user's k best items (all, if there are fewer), and how many items were scored.

    ``users`` is (id, features). A pass over the chunks that a task may hold is one
    job over the users that are still open; their state is written, so a lost
    executor costs one pass.
    """
    empty = [F.array().cast("array<long>").alias("items"), F.array().cast("array<float>").alias("scores"), F.lit(0).cast("long").alias("scored")]
    sc = users.sparkSession.sparkContext
    # A model's vectors come in as many partitions as it has blocks: fewer than there are cores.
    spread = _user_vectors(users).repartition(sc.defaultParallelism)
    state = spread.select("*", *empty, F.lit(1).alias("open"))
    done, chunk = [], 0
    ahead = items.load(0) if items.chunks else None
    while ahead is not None:
        ids, vectors = ahead
        after = min(items.chunks, chunk + max(1, PASS_BYTES // (ids.nbytes + vectors.nbytes)))
        more = [sc.broadcast(items.load(c)) for c in range(chunk + 1, after)]
        ahead = items.load(after) if after < items.chunks else None
        next_norm = None if ahead is None else _norm(ahead[1][0])
        state = materialize(state.mapInArrow(_search(ids, vectors, k, next_norm, more), STATE), "top_k", partition_by=["open"])
        for sent in more:
            sent.destroy()
        done.append(state.where("open = 0"))
        state = state.where("open = 1")
        if ahead is None or not state.limit(1).count():
            break
        chunk = after
    parts = done or [state.limit(0)]
    return reduce(lambda a, b: a.unionByName(b), parts).select(U, "items", "scores", "scored")


def as_rows(lists: DataFrame) -> DataFrame:
    """(user_id, item_id, rank, score) of ``top_k``'s lists."""
    return (lists.select(U, F.posexplode(F.arrays_zip("items", "scores")).alias("p", "r"))
                 .select(U, F.col("r.items").alias(I), (F.col("p") + 1).cast("long").alias("rank"), F.col("r.scores").cast("double").alias("score")))


def work(lists: DataFrame, items: ItemBlocks) -> DataFrame:
    """(users, items, scored, skipped): how many scores the bounds made needless, as a share of users x items."""
    n = F.count(F.lit(1))
    whole = n.cast("double") * items.items
    return lists.agg(n.alias("users"), F.lit(items.items).cast("long").alias("items"), F.coalesce(F.sum("scored"), F.lit(0)).cast("long").alias("scored"),
                     F.when(whole > 0, 1 - F.sum("scored") / whole).otherwise(0.0).alias("skipped"))


def score(u: str | Column, v: str | Column) -> Column:
    """The score of two vector columns."""
    return F.aggregate(F.zip_with(u, v, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda a, x: a + x).cast("float")


def _row_sums(flags: np.ndarray) -> np.ndarray:
    """How many of each row's bytes are 1; the rows' length is a multiple of 8."""
    words = flags.view(np.uint64)
    sums = np.zeros(len(flags), np.int64)
    for a in range(0, words.shape[1], 255):  # eight counts of a byte each in a word
        sums += np.ascontiguousarray(words[:, a:a + 255].sum(1))[:, None].view(np.uint8).sum(1, dtype=np.int64)
    return sums


def _few(u: np.ndarray, own: list[np.ndarray], blocks: Sequence[tuple[np.ndarray, float]], lower: np.ndarray, equal: np.ndarray) -> None:
    """Add to each user's counts by comparing the scores with each of its positives'; most positives first.

    Scores in floats of float products differ from the exact ones by less than a
    bound, so a comparison with the positive's score less, and plus, the bound
    settles nearly all items. What is between the two is scored in doubles.
    """
    single, size = u.astype(np.float32), np.sqrt((u * u).sum(1))
    m = np.array([len(x) for x in own])
    x = np.zeros((len(own), m.max()))
    for i, scores in enumerate(own):
        x[i, :len(scores)] = scores
    wide = max((-(-v.shape[1] // 8) * 8 for v, _ in blocks), default=0)
    all_scores, all_flags = np.empty(len(u) * wide, np.float32), np.empty(len(u) * wide, bool)
    for v, norm in blocks:
        width = -(-v.shape[1] // 8) * 8
        s, flags = (held[:len(u) * width].reshape(len(u), width) for held in (all_scores, all_flags))
        s[:, v.shape[1]:] = np.inf  # greater than any score
        np.matmul(single, v, out=s[:, :v.shape[1]])
        error = _error(size, u.shape[1], norm)[:, None]
        least = np.nextafter((x - error).astype(np.float32), np.float32(-np.inf))
        most = np.nextafter((x + error).astype(np.float32), np.float32(np.inf))
        for j in range(x.shape[1]):
            n = np.count_nonzero(m > j)
            surely = _row_sums(np.less(s[:n], least[:n, j:j + 1], out=flags[:n]))
            upto = _row_sums(np.less_equal(s[:n], most[:n, j:j + 1], out=flags[:n]))
            lower[:n] += surely
            for i in np.flatnonzero(upto > surely):
                between = np.flatnonzero(flags[i] & (s[i] >= least[i, j]))
                exact = (u[i] @ v[:, between].astype(np.float64)).astype(np.float32)
                lower[i] += np.count_nonzero(exact < own[i][j])
                equal[i] += np.count_nonzero(exact == own[i][j])


def _counts(vectors: np.ndarray):
    """Per row of positive scores: items scored lower, and equal, summed over the positives.

    A user's scores are sorted where the positives are many; where they are few,
    comparing all scores with each of them takes less.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
        blocks = [(np.ascontiguousarray(vectors[a:a + FEW_ITEMS].T, np.float32), norms[a:a + FEW_ITEMS].max()) for a in range(0, len(vectors), FEW_ITEMS)]
        for batch in batches:
            u = _matrix(batch.column("features"), len(batch))
            lower, equal = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            own = [np.asarray(s.values.to_numpy(zero_copy_only=False), np.float32) for s in batch.column("scores")]
            sizes = np.array([len(x) for x in own], np.int64)
            few = np.flatnonzero((sizes > 0) & (sizes <= FEW))
            few = few[np.argsort(-sizes[few], kind="stable")]
            for start in range(0, len(few), FEW_USERS):
                at = few[start:start + FEW_USERS]
                counts = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
                _few(u[at], [own[i] for i in at], blocks, *counts)
                lower[at], equal[at] = counts
            many = np.flatnonzero(sizes > FEW)
            for a in range(0, len(vectors) if len(many) else 0, 1 << 13):
                v = np.ascontiguousarray(vectors[a:a + (1 << 13)].T, np.float64)
                for start in range(0, len(many), 64):
                    at = many[start:start + 64]
                    s = (u[at] @ v).astype(np.float32)
                    for i, row in zip(at, s):
                        row.sort()
                        left, right = np.searchsorted(row, own[i], "left"), np.searchsorted(row, own[i], "right")
                        lower[i] += left.sum()
                        equal[i] += (right - left).sum()
            yield pa.record_batch({"user_id": batch.column("user_id"), "lower": pa.array(lower), "equal": pa.array(equal)})
    return run


def sample_users(users: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """(user_id): n distinct users (all, if fewer), those of the smallest md5 of ``seed|user``: n rows a task are kept."""
    key = F.md5(F.concat(F.lit(f"{seed}|"), F.col(U).cast("string")))
    return users.select(U).distinct().orderBy(key, U).limit(n)


def auc_per_user(users: DataFrame, factors: DataFrame, items: ItemBlocks, positives: DataFrame) -> DataFrame:
    """(user_id, m, auc): AUC of every item's score, for users that have a vector and 0 < m < items positives.

    The universe is the items that have vectors; positives without one are left
    out. AUC = (sum of the positives' mid-ranks - m(m+1)/2) / (m (N - m)), where
    a mid-rank is items scored lower + (items scored equal + 1) / 2.
    """
    vectors = _user_vectors(users)
    pos = positives.select(U, I).distinct().join(vectors, U).join(factors.select(F.col("id").cast("long").alias(I), F.col("features").alias("v")), I)
    pos = materialize(pos.select(U, I, score("features", "v").alias("s")), "positives")
    sizes = pos.groupBy(U).agg(F.count(F.lit(1)).alias("m"))
    most = sizes.agg(F.max("m")).first()[0] or 0
    parts = -(-most // POSITIVES_ROW) or 1
    held = pos.groupBy(U, F.pmod(F.xxhash64(I), F.lit(parts)).alias("part")).agg(F.collect_list("s").alias("scores"))
    # Dealt to all cores: rows of one file part are counted by one task.
    held = held.join(vectors, U).select(U, "scores", "features").repartition(users.sparkSession.sparkContext.defaultParallelism)
    held = materialize(held, "positive_scores")
    counts = [materialize(held.mapInArrow(_counts(items.load(c)[1]), "user_id long, lower long, equal long"), "rank_counts") for c in range(items.chunks)]
    if not counts:
        return sizes.select(U, "m", F.lit(0.0).alias("auc")).limit(0)
    sums = reduce(lambda a, b: a.unionByName(b), counts).groupBy(U).agg(F.sum("lower").alias("lower"), F.sum("equal").alias("equal"))
    m, n = F.col("m").cast("double"), F.lit(float(items.items))
    ranks = F.col("lower").cast("double") + (F.col("equal").cast("double") + m) / 2.0
    return (sums.join(sizes, U).where((F.col("m") > 0) & (F.col("m") < items.items))
                .select(U, "m", ((ranks - m * (m + 1) / 2.0) / (m * (n - m))).alias("auc")))
