import pytest
from pyspark.sql import functions as F

from encore.functions.columns import conform
from encore.operators import metrics, popularity, ranking
from encore.sources import tables


def _ix(spark):
    rows = [(1, 10, 5), (1, 11, 1), (2, 10, 2), (2, 12, 9), (3, 12, 1), (3, 13, 0)]
    return spark.createDataFrame(rows, "user_id long, item_id long, interactions long")


def test_popularity_scores_and_top_k(spark):
    pop = {r["item_id"]: r for r in popularity.popularity(_ix(spark), beta=1).collect()}
    assert pop[10]["total_listens"] == 7 and pop[10]["num_users"] == 2
    assert pop[10]["score"] == pytest.approx(7 / 3)
    assert 13 not in pop  # zero interactions are not positive feedback
    top = [(r["item_id"], r["rank"]) for r in popularity.top_k(popularity.popularity(_ix(spark), 1), 2)
           .orderBy("rank").collect()]
    assert top == [(12, 1), (10, 2)]  # 10/3 > 7/3


def test_recommend_popular_same_list_for_every_user(spark):
    top = popularity.top_k(popularity.popularity(_ix(spark), 1), 2)
    recs = {r["user_id"]: r["recommendations"] for r in popularity.recommend_popular(top, _ix(spark)).collect()}
    assert recs == {1: [12, 10], 2: [12, 10], 3: [12, 10]}


def test_true_top_k_ties_by_item(spark):
    ix = spark.createDataFrame([(1, 5, 3), (1, 4, 3), (1, 6, 9)], "user_id long, item_id long, interactions long")
    got = [(r["item_id"], r["rank"]) for r in ranking.true_top_k(ix, 2).orderBy("rank").collect()]
    assert got == [(6, 1), (4, 2)]
    arr = ranking.true_arrays(ranking.true_top_k(ix, 3), as_double=True).first()["true_labels"]
    assert arr == [6.0, 4.0, 5.0]


def test_model_output_arrays_and_explode(spark):
    recs = spark.createDataFrame([(1, [(7, 0.9), (3, 0.5)])],
                                 "user_id long, recommendations array<struct<item_id:int,rating:float>>")
    assert ranking.rec_items(recs).first()["predicted_labels"] == [7.0, 3.0]
    rows = [(r["item_id"], r["rank"]) for r in ranking.explode_recs(recs).orderBy("rank").collect()]
    assert rows == [(7, 1), (3, 2)]


def test_left_population_scores_missing_predictions_zero(spark):
    labels = spark.createDataFrame([(1, 2), (9, 2)], "user_id long, item_id long")
    recs = spark.createDataFrame([(1, 2, 1)], "user_id long, item_id long, rank long")
    assert metrics.map_at_k(labels, recs, 3).first()["map"] == 1.0
    left = metrics.map_at_k(labels, recs, 3, how="left").first()
    assert left["users"] == 2 and left["map"] == 0.5


def test_conform_and_head(spark):
    ix = _ix(spark)
    assert conform(ix, positions=[2, 1, 0]).columns == ["interactions", "item_id", "user_id"]
    head = tables.head_rows(ix, [F.col("user_id"), F.col("item_id")], 2).collect()
    assert [(r["user_id"], r["item_id"]) for r in head] == [(1, 10), (1, 11)]


def test_unseen_lists_are_filled_to_k(spark):
    import random

    from encore.operators import popularity
    rnd = random.Random(1)
    items = list(range(60))
    pop = spark.createDataFrame([(i, float(100 - i // 2)) for i in items], "item_id long, score double")
    ranked = sorted(items, key=lambda i: (-(100 - i // 2), i))
    seen = {u: set(rnd.sample(items, n)) for u, n in enumerate([0, 1, 5, 30, 55, 60])}
    seen[6], seen[7] = set(ranked[:20]), set(ranked[3:9]) | set(ranked[12:40])
    rows = [(u, i) for u, s in seen.items() for i in s]
    users = spark.createDataFrame([(u,) for u in seen], "user_id long")
    history = spark.createDataFrame(rows, "user_id long, item_id long")
    for width in (4, 1000):
        got = {(r["user_id"], r["rank"]): r["item_id"] for r in popularity.recommend_unseen(pop, users, history, 8, width=width).collect()}
        want = {(u, r + 1): i for u, s in seen.items() for r, i in enumerate([x for x in ranked if x not in s][:8])}
        assert got == want


def test_unseen_als_lists_are_filled_to_k(spark):
    from encore.operators import als
    rows = [(u, i, 1 + (u * i) % 3) for u in range(20) for i in range(30) if (u + i) % (2 + u % 4) == 0]
    ix = spark.createDataFrame(rows, "user_id long, item_id long, interactions long")
    model = als.fit_als(ix, rank=3, max_iter=2, user_blocks=2, item_blocks=2)
    recs = als.recommend_unseen_als(model, ix, ix, 6)
    seen = {(u, i) for u, i, _ in rows}
    lists = {}
    for r in recs.collect():
        assert (r["user_id"], r["item_id"]) not in seen
        lists.setdefault(r["user_id"], []).append(r["rank"])
    assert all(sorted(v) == [1, 2, 3, 4, 5, 6] for v in lists.values()) and len(lists) == 20
