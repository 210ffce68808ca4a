import random

import pytest

from encore.operators import als, metrics, popularity


def _data(spark, seed=5):
    rnd = random.Random(seed)
    train = [(u, i, rnd.randint(1, 20)) for u in range(60) for i in rnd.sample(range(40), 12)]
    labels = [(u, i) for u in range(0, 60, 2) for i in rnd.sample(range(40), 5)]
    return (spark.createDataFrame(train, "user_id long, item_id long, interactions long"),
            spark.createDataFrame(labels, "user_id long, item_id long"))


def test_beta_sweep_equals_one_list_at_a_time(spark):
    train, labels = _data(spark)
    users = train.select("user_id")
    betas = [1.0, 50.0, 1e6]
    sweep = {r["beta"]: (r["users"], r["map"]) for r in
             popularity.sweep_popularity(train, {"seg": (labels, users)}, betas, 5).collect()}
    for b in betas:
        top = popularity.top_k(popularity.popularity(train, b), 5)
        row = metrics.map_at_k(labels, top, 5, users).first()
        assert sweep[b][0] == row["users"]
        assert sweep[b][1] == pytest.approx(row["map"], abs=1e-12)


def test_sweep_side_by_side_equals_one_by_one(spark):
    train, labels = _data(spark)
    grid = [dict(rank=2), dict(rank=3, reg=0.1), dict(alpha=2.0), dict(max_iter=1)]
    base = dict(rank=2, max_iter=2, user_blocks=2, item_blocks=2)
    one = als.sweep_als(train, labels, grid, 5, base=base).collect()
    assert als.sweep_als(train, labels, grid, 5, base=base, at_once=3).collect() == one
    with pytest.raises(Exception):
        als.sweep_als(train, labels, [dict(rank=2), dict(rank=-1)], 5, base=base, at_once=2)


def test_als_sweep_one_row_per_setting(spark):
    train, labels = _data(spark)
    grid = [dict(rank=2), dict(rank=3, reg=0.1)]
    rows = als.sweep_als(train, labels, grid, 5, base=dict(max_iter=2, user_blocks=2, item_blocks=2)).collect()
    assert [(r["rank"], r["reg"]) for r in rows] == [(2, 0.5), (3, 0.1)]
    assert all(r["users"] == 30 and 0.0 <= r["map"] <= 1.0 for r in rows)


def test_as_many_fits_side_by_side_as_the_cores_hold(spark):
    blocks = dict(user_blocks=4, item_blocks=4)
    assert als.side_by_side([blocks], 12) == 3 and als.side_by_side([blocks], 8) == 2 and als.side_by_side([blocks], 1) == 2
    assert als.side_by_side([{}], 200) == 2 and als.side_by_side([], 4) == 2
    train, labels = _data(spark)
    grid = [dict(rank=2), dict(rank=3), dict(rank=2, max_iter=3)]  # the second begins first; rows keep the grid's order
    rows = als.sweep_als(train, labels, grid, 5, base=dict(max_iter=1, user_blocks=2, item_blocks=2), at_once=None).collect()
    assert [(r["rank"], r["max_iter"]) for r in rows] == [(2, 1), (3, 1), (2, 3)]
