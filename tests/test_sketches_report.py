"""Sketch states, seeded samples, bootstrap intervals and checked casts."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from encore.operators import report, sketches
from encore.sources import tables


def _plays(spark, n=20_000):
    rnd = random.Random(3)
    rows = [(rnd.randrange(3000), None if rnd.random() < 0.01 else int(rnd.random() ** 3 * 20), rnd.choice("ab")) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "user_id long, item_id long, period string")


def test_listener_states_merge_over_periods(spark):
    rows, plays = _plays(spark)
    states = sketches.listener_states(plays, by=["period"])
    assert states.count() == len({(i, p) for _, i, p in rows if i is not None})
    exact = {}
    for u, i, _ in rows:
        exact.setdefault(i, set()).add(u)
    got = {r["item_id"]: r["listeners"] for r in sketches.estimates(sketches.merge_states(states)).collect()}
    assert set(got) == set(exact) - {None}
    assert all(abs(n - len(exact[i])) <= 5 * sketches.hll_error() * len(exact[i]) for i, n in got.items())
    whole = {r["item_id"]: r["listeners"] for r in sketches.estimates(sketches.listener_states(plays)).collect()}
    assert all(abs(whole[i] - n) <= 2 * sketches.hll_error() * n for i, n in got.items())  # merging loses nothing


def test_quantiles_within_the_rank_error(spark):
    values = spark.range(30_000).select((F.col("id") * F.col("id") % 7919).alias("v"), (F.col("id") % 7).alias("part"))
    values = values.unionByName(spark.createDataFrame([(None, 1)], "v long, part long"))
    qs = [0.0, 0.01, 0.5, 0.9, 1.0]
    for state in (sketches.quantile_state(values, "v"), sketches.merge_quantiles(sketches.quantile_state(values, "v", by=["part"]))):
        found = sketches.quantiles(state, qs)
        errors = {r["q"]: r["error"] for r in sketches.rank_errors(values, "v", found, qs).collect()}
        assert set(errors) == set(qs) and max(errors.values()) <= 3 * sketches.kll_error()


def test_few_values_are_exact(spark):
    values = spark.createDataFrame([(v,) for v in (5, 1, 9, 7)], "v long")
    got = {r["q"]: r["value"] for r in sketches.quantiles(sketches.quantile_state(values, "v"), [0.25, 0.5, 1.0]).collect()}
    assert got == {0.25: 1, 0.5: 5, 1.0: 9}


def test_rank_error_of_a_wrong_value(spark):
    values = spark.createDataFrame([(v,) for v in range(10)], "v long")
    found = spark.createDataFrame([(0.5, 9)], "q double, value long")
    r = sketches.rank_errors(values, "v", found, [0.5]).first()
    assert r["error"] == pytest.approx(0.4)


def test_sample_is_the_same_however_rows_lie(spark):
    df = spark.range(500).select("id", (F.col("id") % 7).alias("x"))
    got = {r["id"] for r in tables.sample_rows(df, 40, ["id"]).collect()}
    assert len(got) == 40 == len(got & {r["id"] for r in tables.sample_rows(df.repartition(9), 40, ["id"]).collect()})
    assert got == set(sorted(range(500), key=lambda i: hashlib.md5(f"42|{i}".encode()).hexdigest())[:40])
    assert got != {r["id"] for r in tables.sample_rows(df, 40, ["id"], seed=1).collect()}
    # Samples of parts merge into the sample of the whole.
    parts = tables.sample_rows(df.where("x < 3"), 40, ["id"]).union(tables.sample_rows(df.where("x >= 3"), 40, ["id"]))
    assert got == {r["id"] for r in tables.sample_rows(parts, 40, ["id"]).collect()}
    assert tables.sample_rows(df, 900, ["id"]).count() == 500


def _draws(user, replicate, seed=42):
    u = int(hashlib.md5(f"{seed}|{user}|{replicate}".encode()).hexdigest()[:13], 16) / 2 ** 52
    return sum(u >= c for c in report.POISSON_STEPS)


def test_bootstrap_from_the_definition(spark):
    rows = [(u, (u * 37 % 101) / 101, float(u % 2)) for u in range(60)]
    per_user = spark.createDataFrame(rows, "user_id long, ap double, rr double")
    got = {r["metric"]: r for r in report.bootstrap(per_user.repartition(5), ["ap", "rr"], replicates=50).collect()}
    for m, at in (("ap", 1), ("rr", 2)):
        means = []
        for r in range(1, 51):
            w = [_draws(row[0], r) for row in rows]
            means.append(sum(x * row[at] for x, row in zip(w, rows)) / sum(w))
        means.sort()
        at_q = lambda q: means[int(q * 49)] + (q * 49 - int(q * 49)) * (means[min(int(q * 49) + 1, 49)] - means[int(q * 49)])
        assert got[m]["users"] == 60 and got[m]["value"] == pytest.approx(sum(x[at] for x in rows) / 60)
        assert (got[m]["low"], got[m]["high"]) == (pytest.approx(at_q(0.025)), pytest.approx(at_q(0.975)))
    assert report.bootstrap(per_user.limit(0), ["ap"]).count() == 0


def test_paired_difference(spark):
    a = spark.createDataFrame([(1, 0.5), (2, 0.25)], "user_id long, ap double")
    b = spark.createDataFrame([(2, 0.5), (3, 1.0)], "user_id long, ap double")
    assert [tuple(r) for r in report.paired_difference(a, b, ["ap"]).collect()] == [(2, -0.25)]


def test_a_fraction_does_not_fit_a_whole_number(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1.0, 2.0), (None, 5.7)], "a double, b double").write.parquet(path)
    assert [r["a"] for r in tables.read_table(spark, path, "a INT").orderBy(F.col("a").desc()).collect()] == [1, None]
    with pytest.raises(Exception, match="does not fit"):
        tables.read_table(spark, path, "b INT").collect()
    assert {float(r["b"]) for r in tables.read_table(spark, path, "b DECIMAL(5,1)").collect()} == {2.0, 5.7}
