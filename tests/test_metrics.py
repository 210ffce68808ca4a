import random

import pytest
from pyspark.ml.evaluation import RankingEvaluator
from pyspark.sql import functions as F

from encore.operators import metrics, ranking


def _case(spark):
    recs = spark.createDataFrame([(1, i, i) for i in (1, 2, 3, 4)], "user_id long, item_id long, rank long")
    labels = spark.createDataFrame([(1, i) for i in (2, 4, 9)], "user_id long, item_id long")
    return labels, recs


@pytest.mark.parametrize("k,ap,p,r,ndcg", [
    (2, 0.25, 0.5, 1 / 3, 0.38685281),
    (3, 1 / 6, 1 / 3, 1 / 3, 0.29608191),
    (4, 1 / 3, 0.5, 2 / 3, 0.49818925),
])
def test_hand_worked_metrics(spark, k, ap, p, r, ndcg):
    labels, recs = _case(spark)
    row = metrics.per_user_metrics(labels, recs, k).first()
    assert row["ap"] == pytest.approx(ap)
    assert row["precision"] == pytest.approx(p)
    assert row["recall"] == pytest.approx(r)
    assert row["ndcg"] == pytest.approx(ndcg, abs=1e-8)
    assert row["rr"] == 0.5


def test_precision_at_10(spark):
    labels, recs = _case(spark)
    assert metrics.precision_at_k(labels, recs, 10).first()["precision"] == pytest.approx(0.2)


def test_user_without_labels_scores_zero(spark):
    labels, recs = _case(spark)
    recs2 = recs.unionByName(spark.createDataFrame([(2, 1, 1)], "user_id long, item_id long, rank long"))
    assert metrics.map_at_k(labels, recs2, 4, how="pred").first()["map"] == pytest.approx(1 / 6)
    assert metrics.map_at_k(labels, recs2, 4).first()["map"] == pytest.approx(1 / 3)


def test_global_list_needs_users(spark):
    labels, recs = _case(spark)
    top = recs.drop("user_id")
    users = spark.createDataFrame([(1,)], "user_id long")
    assert metrics.map_at_k(labels, top, 4, users).first()["map"] == pytest.approx(1 / 3)
    with pytest.raises(ValueError):
        metrics.map_at_k(labels, top, 4)


def test_matches_ranking_evaluator(spark):
    rnd = random.Random(11)
    rec_rows, lab_rows = [], []
    for u in range(40):
        items = rnd.sample(range(30), 12)
        rec_rows += [(u, it, r + 1) for r, it in enumerate(items[:8])]
        lab_rows += [(u, it) for it in rnd.sample(range(30), rnd.randint(1, 9))]
    recs = spark.createDataFrame(rec_rows, "user_id long, item_id long, rank long")
    labels = spark.createDataFrame(lab_rows, "user_id long, item_id long")
    k = 6
    ours = metrics.per_user_metrics(labels, recs, k)
    summary = ours.agg(F.avg("ap"), F.avg("precision"), F.avg("recall"), F.avg("ndcg")).first()
    pred = ranking.ranked_array(recs, "prediction", ["user_id"], as_double=True)
    truth = labels.groupBy("user_id").agg(F.collect_list(F.col("item_id").cast("double")).alias("label"))
    joined = truth.join(pred, "user_id")
    for metric, value in zip(["meanAveragePrecisionAtK", "precisionAtK", "recallAtK", "ndcgAtK"], summary):
        ev = RankingEvaluator(k=k, metricName=metric, labelCol="label", predictionCol="prediction")
        assert ev.evaluate(joined) == pytest.approx(value, abs=1e-12), metric


def test_auc_with_tie(spark):
    scores = spark.createDataFrame([(1, .9), (2, .8), (3, .7), (4, .6), (5, .6)], "item_id long, score double")
    positives = spark.createDataFrame([(1, 1), (1, 4)], "user_id long, item_id long")
    row = metrics.auc_global_scores(positives, scores).first()
    assert row["auc"] == pytest.approx(3.5 / 6)


def test_exclude_seen_reranks(spark):
    recs = spark.createDataFrame([(1, i, i) for i in (1, 2, 3)], "user_id long, item_id long, rank long")
    seen = spark.createDataFrame([(1, 2)], "user_id long, item_id long")
    got = sorted((r["item_id"], r["rank"]) for r in ranking.exclude_seen(recs, seen).collect())
    assert got == [(1, 1), (3, 2)]


def test_users_with_more_labels_than_k(spark):
    """Precision, recall and reciprocal rank count all relevant items; MAP and NDCG the k strongest."""
    truth = spark.createDataFrame([(1, i, 10 - i) for i in range(6)], "user_id long, item_id long, interactions long")
    recs = spark.createDataFrame([(1, 5, 1), (1, 4, 2), (1, 0, 3)], "user_id long, item_id long, rank long")
    k = 3
    row = metrics.ranking_summary(ranking.true_top_k(truth, k), truth.select("user_id", "item_id"), recs, k).first()
    assert row["precision"] == pytest.approx(1.0) and row["recall"] == pytest.approx(0.5) and row["mrr"] == 1.0
    assert row["map"] == pytest.approx((1 / 3) / 3)  # only item 0 is among the three strongest


def test_auc_counts_unscored_items_of_the_dictionary(spark):
    scores = spark.createDataFrame([(1, .9), (2, .8)], "item_id long, score double")
    universe = spark.createDataFrame([(i,) for i in range(1, 6)], "item_id long")
    positives = spark.createDataFrame([(1, 1), (1, 4), (2, 5)], "user_id long, item_id long")
    got = {r["user_id"]: (r["m"], r["auc"]) for r in metrics.auc_global_scores(positives, scores, universe=universe).collect()}
    # User 1: item 1 beats 2, 3 and 5; item 4 loses to 2 and ties with 3 and 5. User 2: item 5 loses to two, ties with two.
    assert got == {1: (2, pytest.approx((3 + 1) / 6)), 2: (1, pytest.approx(1 / 4))}
