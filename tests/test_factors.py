"""Blocked factor scoring against the plain product."""

import numpy as np
import pyarrow as pa
import pytest

from encore.operators import als, factors


def _vectors(spark, n, rank, seed, scale=None):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, rank)).astype(np.float32)
    if scale is not None:
        x *= (np.arange(1, n + 1, dtype=np.float32) ** -scale)[rnd.permutation(n), None]
    return x, spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id int, features array<float>")


def _plain(u, v, k):
    s = (u.astype(float) @ v.astype(float).T).astype(np.float32)
    return [[(int(i), float(row[i])) for i in np.lexsort((np.arange(len(row)), -row))[:k]] for row in s]


@pytest.mark.parametrize("k,chunk_bytes", [(5, 1 << 20), (5, 4000), (70, 2000), (200, 3000)])
def test_top_k_is_exact(spark, k, chunk_bytes):
    u, users = _vectors(spark, 60, 6, 1)
    v, items = _vectors(spark, 150, 6, 2, scale=1.0)
    blocks = factors.item_blocks(items, chunk_bytes)
    assert blocks.items == 150 and (blocks.chunks > 1) == (chunk_bytes < 1 << 20)
    lists = factors.top_k(users, blocks, k)
    got = {r["user_id"]: list(zip(r["items"], r["scores"])) for r in lists.collect()}
    assert got == dict(enumerate(_plain(u, v, k)))
    rows = factors.as_rows(lists).where("user_id = 3").orderBy("rank").collect()
    assert [(r["item_id"], r["rank"]) for r in rows] == [(i, n + 1) for n, (i, _) in enumerate(got[3])]


def test_blocks_under_the_bound_are_skipped(spark):
    _, users = _vectors(spark, 40, 4, 3)
    _, items = _vectors(spark, 6000, 4, 4, scale=1.0)
    blocks = factors.item_blocks(items, 48 * 1500)
    w = factors.work(factors.top_k(users, blocks, 5), blocks).first()
    assert w["users"] == 40 and w["items"] == 6000 and w["skipped"] > 0.5
    assert w["scored"] == round((1 - w["skipped"]) * 40 * 6000)


def test_ties_zero_vectors_and_nothing(spark):
    items = spark.createDataFrame([(i, [1.0, 0.0] if i != 4 else [0.0, 0.0]) for i in (9, 4, 7, 5)], "id int, features array<float>")
    users = spark.createDataFrame([(1, [2.0, 0.0]), (2, [0.0, 0.0]), (3, [-1.0, 0.0])], "id int, features array<float>")
    for chunk in (1, 1 << 20):
        blocks = factors.item_blocks(items, chunk)
        got = {r["user_id"]: (r["items"], r["scores"]) for r in factors.top_k(users, blocks, 2).collect()}
        assert got == {1: ([5, 7], [2.0, 2.0]), 2: ([4, 5], [0.0, 0.0]), 3: ([4, 5], [0.0, -1.0])}
    assert factors.top_k(users.limit(0), blocks, 2).count() == 0
    none = factors.item_blocks(items.limit(0))
    assert none.chunks == 0 and factors.top_k(users, none, 2).count() == 0


def _pairwise(u, v, positives):
    out = {}
    for user, own in positives.items():
        s = (u[user].astype(float) @ v.astype(float).T).astype(np.float32)
        rest = [i for i in range(len(v)) if i not in own]
        own = [i for i in own if i < len(v)]
        if own and rest:
            wins = sum((s[p] > s[q]) + 0.5 * (s[p] == s[q]) for p in own for q in rest)
            out[user] = (len(own), wins / (len(own) * len(rest)))
    return out


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 2000])
def test_auc_equals_all_pairs(spark, chunk_bytes, monkeypatch):
    monkeypatch.setattr(factors, "POSITIVES_ROW", 20)  # heavy users are split over rows
    u, users = _vectors(spark, 12, 5, 5)
    v, items = _vectors(spark, 90, 5, 6)
    v[10:20] = v[30]  # ties
    items = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(v)], "id int, features array<float>")
    rnd = np.random.default_rng(7)
    positives = {i: set(map(int, rnd.choice(100, 1 + 7 * i, replace=False))) for i in range(12)} | {11: set(range(100))}
    df = spark.createDataFrame([(a, b) for a, own in positives.items() for b in own] + [(99, 1), (3, next(iter(positives[3])))], "user_id long, item_id long")
    got = {r["user_id"]: (r["m"], r["auc"]) for r in factors.auc_per_user(users, items, factors.item_blocks(items, chunk_bytes), df).collect()}
    expected = _pairwise(u, v, positives)
    assert set(got) == set(expected)
    for user, (m, auc) in expected.items():
        assert got[user][0] == m and got[user][1] == pytest.approx(auc, abs=1e-12)


def test_same_lists_as_the_full_product(spark):
    rows = [(a, b, 1 + (a * b) % 3) for a in range(1, 40) for b in range(1, 60) if (a * 7 + b) % 3]
    model = als.fit_als(spark.createDataFrame(rows, "user_id long, item_id long, interactions long"), rank=4, max_iter=3, user_blocks=2, item_blocks=2)
    full = {(r["user_id"], r["rank"]): r["score"] for r in als.recommend_als(model, 10).collect()}
    ours = {(r["user_id"], r["rank"]): r["score"] for r in als.recommend_exact(model, 10, chunk_bytes=600).collect()}
    assert full.keys() == ours.keys() and all(abs(full[x] - ours[x]) < 1e-5 for x in full)
    some = spark.createDataFrame([(1,), (2,), (2,), (999,)], "user_id long")
    assert {r["user_id"] for r in als.recommend_exact(model, 3, some).collect()} == {1, 2}


def test_long_lists_are_filled_in_one_step(spark, monkeypatch):
    """A list of all items is merged once a chunk, not once a block: merging block by block grows with the items' square."""
    u, _ = _vectors(spark, 7, 4, 10)
    v, _ = _vectors(spark, 5000, 4, 11)
    v = v[np.argsort(-(v.astype(float) ** 2).sum(1), kind="stable")].astype(float)
    merges, best = [], factors._best
    monkeypatch.setattr(factors, "_best", lambda *a: merges.append(1) or best(*a))
    empty = lambda t: pa.array([[]] * 7, pa.list_(t))
    batch = pa.record_batch({"user_id": pa.array(range(7)), "features": pa.array(u.tolist(), pa.list_(pa.float32())), "items": empty(pa.int64()),
                             "scores": empty(pa.float32()), "scored": pa.array([0] * 7, pa.int64()), "open": pa.array([1] * 7, pa.int32())})
    for k in (5000, 2000, 10):
        merges.clear()
        out = next(factors._search(np.arange(5000), v, k, None)(iter([batch])))
        assert [list(zip(a, b)) for a, b in zip(out["items"].to_pylist(), out["scores"].to_pylist())] == _plain(u, v, k)
        assert len(merges) <= {5000: 1, 2000: 4, 10: 5}[k]


def test_few_positives_need_no_sorted_scores(spark, monkeypatch):
    """Up to FEW positives of a user are compared with the scores, more are looked up among the sorted ones: the same counts."""
    u, _ = _vectors(spark, 9, 4, 8)
    v, _ = _vectors(spark, 9000, 4, 9)  # more than one block
    v[100:140] = v[8500]
    scores = [(u[i].astype(float) @ v[100:101 + 3 * i].astype(float).T).astype(np.float32).tolist() for i in range(9)]
    batch = pa.record_batch({"user_id": pa.array(range(9)), "scores": pa.array(scores, pa.list_(pa.float32())),
                             "features": pa.array(u.tolist(), pa.list_(pa.float32()))})
    out = [next(factors._counts(v.astype(float))(iter([batch])))]
    monkeypatch.setattr(factors, "FEW", 0)
    out.append(next(factors._counts(v.astype(float))(iter([batch]))))
    assert out[0].equals(out[1]) and out[0]["equal"][0].as_py() == 41
    monkeypatch.setattr(factors, "FEW", 10**6)
    monkeypatch.setattr(np, "searchsorted", None)  # nothing is sorted or looked up
    assert next(factors._counts(v.astype(float))(iter([batch]))).equals(out[0])


def test_products_blocks_and_checked_chunks_grow_with_the_items(spark):
    """The product gives each user k candidates a block of items, and a chunk of the search is a job: neither may grow with the items alone."""
    from encore.plans import catalog
    assert catalog._checked_chunk(1000, 8) == 64 << 10
    assert -(-600_000 * 80 // catalog._checked_chunk(600_000, 8)) <= 13
    assert catalog._checked_chunk(10**9, 8) == factors.CHUNK_BYTES
    rows = [(a, b, 1) for a in range(12) for b in range(9) if (a + b) % 3]
    model = als.fit_als(spark.createDataFrame(rows, "user_id long, item_id long, interactions long"), rank=4, max_iter=1, user_blocks=2, item_blocks=2)
    assert als.recommend_als(model, 3).count() == 36
    assert model.getBlockSize() == als.PRODUCT_BYTES // 16


def test_users_in_one_partition_are_dealt_to_all_cores(spark, monkeypatch):
    _, users = _vectors(spark, 80, 3, 12)
    _, items = _vectors(spark, 20, 3, 13)
    tasks, write = [], factors.materialize
    monkeypatch.setattr(factors, "materialize", lambda df, name, **a: (tasks.append(df.rdd.getNumPartitions()) if name == "top_k" else None) or write(df, name, **a))
    assert factors.top_k(users.coalesce(1), factors.item_blocks(items), 4).count() == 80
    assert tasks == [spark.sparkContext.defaultParallelism]


def test_lists_are_written_once_a_pass_not_once_a_chunk(spark, monkeypatch):
    """Users x chunks would be written else: both grow with the tables. Passes of any size give the same lists."""
    u, users = _vectors(spark, 30, 4, 14)
    v, items = _vectors(spark, 120, 4, 15)
    blocks = factors.item_blocks(items, 10 * 48)
    assert blocks.chunks == 12
    written, write = [], factors.materialize
    monkeypatch.setattr(factors, "materialize", lambda df, name, **a: written.append(name) or write(df, name, **a))
    want = dict(enumerate(_plain(u, v, 7)))
    for most, passes in ((factors.PASS_BYTES, 1), (10 * 24 * 5, 3), (1, 12)):
        monkeypatch.setattr(factors, "PASS_BYTES", most)
        written.clear()
        got = {r["user_id"]: list(zip(r["items"], r["scores"])) for r in factors.top_k(users, blocks, 7).collect()}
        assert got == want and 1 <= len(written) <= passes and set(written) == {"top_k"}


def test_scored_lists_are_written_once(spark, monkeypatch):
    rows = [(a, b, 1 + (a * b) % 3) for a in range(20) for b in range(15) if (a + b) % 3]
    ix = spark.createDataFrame(rows, "user_id long, item_id long, interactions long")
    model = als.fit_als(ix, rank=3, max_iter=1, user_blocks=2, item_blocks=2)
    monkeypatch.setattr(als, "materialize", None)  # the search has written its lists
    recs, users = als.score_als(model, ix, 4)
    assert recs.count() == 80 and users.distinct().count() == 20


def test_positives_of_many_users_are_compared_at_once(monkeypatch):
    """The comparisons' calls grow with the blocks, not with users x blocks; scores closer than a float product's error are told apart."""
    rnd = np.random.default_rng(16)
    u, v = rnd.normal(size=(40, 8)).astype(np.float32), rnd.normal(size=(20_000, 8)).astype(np.float32)
    v[1:3000] = v[0] * (1 + rnd.normal(size=(2999, 1)).astype(np.float32) * 2e-7)  # nearly and exactly tied
    plain = (u.astype(float) @ v.astype(float).T).astype(np.float32)
    own = [sorted({*range(i % 5 + 1), *rnd.choice(20_000, i % 7).tolist()}) if i % 9 else [] for i in range(40)]
    own[11] = list(range(2990, 3020))  # more than FEW
    u[13] = 0
    plain[13] = 0
    batch = pa.record_batch({"user_id": pa.array(range(40)), "features": pa.array(u.tolist(), pa.list_(pa.float32())),
                             "scores": pa.array([[float(plain[i, p]) for p in x] for i, x in enumerate(own)], pa.list_(pa.float32()))})
    calls, less = [], np.less
    monkeypatch.setattr(np, "less", lambda *a, **b: calls.append(1) or less(*a, **b))
    out = next(factors._counts(v)(iter([batch])))
    assert out["lower"].to_pylist() == [sum(int((plain[i] < plain[i, p]).sum()) for p in x) for i, x in enumerate(own)]
    assert out["equal"].to_pylist() == [sum(int((plain[i] == plain[i, p]).sum()) for p in x) for i, x in enumerate(own)]
    assert len(calls) <= 3 * max(len(x) for i, x in enumerate(own) if i != 11)  # three blocks of items


def test_positives_are_dealt_to_all_cores(spark, monkeypatch):
    _, users = _vectors(spark, 30, 3, 17)
    _, items = _vectors(spark, 20, 3, 18)
    parts, write = [], factors.materialize
    monkeypatch.setattr(factors, "materialize", lambda df, name, **a: (parts.append(df.rdd.getNumPartitions()) if name == "positive_scores" else None) or write(df, name, **a))
    pos = spark.createDataFrame([(a, a % 20) for a in range(30)], "user_id long, item_id long").coalesce(1)
    assert factors.auc_per_user(users, items, factors.item_blocks(items), pos).count() == 30
    assert parts == [spark.sparkContext.defaultParallelism]


def test_full_lists_take_what_exceeds_their_last_score(monkeypatch):
    """No block is partitioned once the lists are full; near ties at the last place are settled in doubles."""
    rnd = np.random.default_rng(19)
    u, v = rnd.normal(size=(30, 6)).astype(np.float32), rnd.normal(size=(6000, 6)).astype(np.float32)
    v[:3000] = v[0] * (1 + rnd.normal(size=(3000, 1)).astype(np.float32) * 2e-7)
    u[4] = 0
    v = v[np.argsort(-(v.astype(float) ** 2).sum(1), kind="stable")]
    empty = lambda t: pa.array([[]] * 30, pa.list_(t))
    batch = pa.record_batch({"user_id": pa.array(range(30)), "items": empty(pa.int64()), "scores": empty(pa.float32()), "features": pa.array(u.tolist(), pa.list_(pa.float32())),
                             "scored": pa.array([0] * 30, pa.int64()), "open": pa.array([1] * 30, pa.int32())})
    calls, partition = [], np.partition
    monkeypatch.setattr(np, "partition", lambda *a, **b: calls.append(1) or partition(*a, **b))
    out = next(factors._search(np.arange(6000), v, 10, None)(iter([batch])))
    assert [list(zip(a, b)) for a, b in zip(out["items"].to_pylist(), out["scores"].to_pylist())] == _plain(u, v, 10)
    assert len(calls) == 1
