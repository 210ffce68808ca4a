"""The solver for many factors against MLlib and against the plain normal equations."""

import random

import numpy as np
import pytest

from encore.operators import als, implicit


def _block(rnd, sizes, others):
    starts = np.append(0, np.cumsum(sizes))
    return implicit.Block(np.arange(len(sizes)), starts, rnd.integers(0, others, starts[-1]), rnd.integers(-2, 9, starts[-1]).astype(float), {})


def _plain(block, y, reg, alpha):
    out = []
    for a, b in zip(block.starts[:-1], block.starts[1:]):
        z, r = y[block.rows[a:b]], block.ratings[a:b]
        c = alpha * np.abs(r)
        system = y.T @ y + (z.T * c) @ z + reg * (r > 0).sum() * np.eye(y.shape[1])
        out.append(np.linalg.solve(system, z.T @ np.where(r > 0, 1 + c, 0)))
    return np.array(out)


@pytest.mark.parametrize("batch_bytes", [16 << 20, 1])
def test_solutions_are_those_of_the_normal_equations(monkeypatch, batch_bytes):
    monkeypatch.setattr(implicit, "BATCH_BYTES", batch_bytes)
    rnd = np.random.default_rng(1)
    y = rnd.normal(size=(60, 12)).astype(np.float32).astype(float)
    block = _block(rnd, [1, 5, 5, 11, 12, 13, 40, 3], 60)
    block.ratings[:1] = 0  # no positive rating: zeros
    got = implicit.solve(block, y.astype(np.float32), np.linalg.eigh(y.T @ y), 0.3, 2.0)
    assert got.dtype == np.float32 and not got[0].any()
    assert np.abs(got - _plain(block, y, 0.3, 2.0)).max() < 1e-6


def test_few_ratings_make_small_systems(monkeypatch):
    """A system of rank equations a vector is what made tuning at rank 200 last."""
    rnd, shapes, solved = np.random.default_rng(2), [], np.linalg.solve
    y = rnd.normal(size=(80, 50)).astype(np.float32)
    monkeypatch.setattr(np.linalg, "solve", lambda a, b: shapes.append(a.shape) or solved(a, b))
    implicit.solve(_block(rnd, [7] * 30 + [9] * 20, 80), y, np.linalg.eigh(y.T.astype(float) @ y), 0.5, 1.0)
    assert shapes == [(30, 7, 7), (20, 9, 9)]


def _vectors(df):
    rows = sorted((r["id"], list(r["features"])) for r in df.collect())
    return [i for i, _ in rows], np.array([v for _, v in rows])


@pytest.mark.parametrize("rank,max_iter,interval", [(6, 3, 10), (40, 2, 1)])
def test_same_vectors_as_mllib(spark, monkeypatch, rank, max_iter, interval):
    rnd = random.Random(3)
    rows = [(u, i * 7 - 50, rnd.randint(-1, 9)) for u in range(50) for i in rnd.sample(range(40), rnd.randint(1, 20))]
    rows += rows[:20] + [(100, 6, 0), (101, 9999, 3)]  # repeated pairs, nothing positive, an item of one user
    ix = spark.createDataFrame(rows, "user_id long, item_id long, interactions long")
    found = []
    for least in (rank + 1, rank):
        monkeypatch.setattr(als, "MANY_FACTORS", least)
        model = als.fit_als(ix, rank=rank, reg=0.1, max_iter=max_iter, user_blocks=3, item_blocks=2, checkpoint_interval=interval)
        assert model.rank == rank and als.recommend_als(model, 2).count() == 2 * 52
        found.append([_vectors(model.userFactors), _vectors(model.itemFactors)])
        als.release_als(model)
    for (ids, plain), (same, ours) in zip(*found):
        assert ids == same and np.abs(plain - ours).max() < 1e-5


def test_many_factors_are_not_fitted_by_mllib(spark, monkeypatch):
    from pyspark.ml.recommendation import ALS
    iterations, fit = [], ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, data: iterations.append(self.getMaxIter()) or fit(self, data))
    ix = spark.createDataFrame([(a, b, 1) for a in range(8) for b in range(6) if (a + b) % 3], "user_id long, item_id long, interactions long")
    for rank in (als.MANY_FACTORS, 4):
        als.fit_als(ix, rank=rank, max_iter=2, user_blocks=2, item_blocks=2)
    assert iterations == [0, 2]


def test_blocks_grow_with_the_ratings():
    assert implicit.block_count(240_000, 200, 4) == 4
    assert implicit.block_count(14_000_000, 200, 4) == 84
