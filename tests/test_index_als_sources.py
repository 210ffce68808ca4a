import pytest
from pyspark.sql import functions as F

from encore.operators import als, index
from encore.sources import tables


def test_item_index_frequency_then_label(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "item_id string")
    idx = index.fit_item_index(df)
    assert {r["item_id"]: r["item_idx"] for r in idx.collect()} == {"c": 0, "a": 1, "b": 2}
    probe = spark.createDataFrame([("zz",), (None,), ("c",)], "item_id string")
    got = sorted((r["item_id"] or "", r["item_idx"]) for r in index.apply_item_index(probe, idx).collect())
    assert got == [("", 3), ("c", 0), ("zz", 3)]


def test_fit_ids_and_coo(spark):
    ix = spark.createDataFrame([(5, 7, 2), (3, 7, 1), (5, 9, 4)], "user_id long, item_id long, interactions long")
    users = index.fit_ids(ix, "user_id", "u_idx")
    items = index.fit_ids(ix, "item_id", "i_idx")
    assert {r[0]: r[1] for r in users.collect()} == {3: 0, 5: 1}
    coo = sorted(tuple(r) for r in index.to_coo(ix, users, items).collect())
    assert coo == [(0, 0, 1.0, 1.0), (1, 0, 1.0, 2.0), (1, 1, 1.0, 4.0)]


def test_csr_blocks_hold_the_triples(spark):
    rows = sorted((u, i, float(u + i)) for u, i in {(u * u % 13, (7 * u + 3 * i) % 50) for u in range(20) for i in range(20)})
    rows += [(99, i, 0.5) for i in range(100)]  # a user that spans blocks
    coo = spark.createDataFrame(rows, "u_idx long, i_idx long, weight double")
    for entries in (1, 7, 64, 10_000):
        blocks = index.to_csr(coo.repartition(3), entries, partitions=3).orderBy("block").collect()
        assert [len(b["indices"]) for b in blocks[:-1]] == [entries] * (len(blocks) - 1) and len(blocks) == -(-len(rows) // entries)
        out = []
        for b in blocks:
            assert b["indptr"][0] == 0 and b["indptr"][-1] == len(b["indices"]) == len(b["data"]) and len(b["indptr"]) == len(b["rows"]) + 1
            for j, u in enumerate(b["rows"]):
                out += [(u, b["indices"][n], b["data"][n]) for n in range(b["indptr"][j], b["indptr"][j + 1])]
        assert out == sorted(rows)
        back = index.from_csr(index.to_csr(coo, entries))
        assert sorted(tuple(r) for r in back.collect()) == sorted(rows)
    assert index.to_csr(coo.limit(0)).count() == 0


def test_counts_taken_while_a_stage_is_written(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("x"))
    table, counts = tables.materialize_counted(df, "counted", {"rows": F.lit(True), "zeros": F.col("x") == 0, "none": F.lit(None).cast("boolean")}, partition_by=["x"])
    assert counts == {"rows": 100, "zeros": 34, "none": 0} and table.where("x = 0").count() == 34
    empty, counts = tables.materialize_counted(df.limit(0), "counted", {"rows": F.lit(True)})
    assert counts == {"rows": 0} and empty.count() == 0


def _als_data(spark):
    rows = [(u, i, 1 + (u * i) % 3) for u in range(1, 30) for i in range(1, 25) if (u + i) % 3 != 0]
    return spark.createDataFrame(rows, "user_id long, item_id long, interactions long")


def test_als_unknown_user_and_k_rows(spark):
    model = als.fit_als(_als_data(spark), rank=4, max_iter=3, user_blocks=2, item_blocks=2)
    users = spark.createDataFrame([(1,), (2,), (999999,)], "user_id long")
    recs = als.recommend_als(model, 5, users)
    counts = {r[0]: r[1] for r in recs.groupBy("user_id").count().collect()}
    assert counts == {1: 5, 2: 5}
    assert recs.where(~F.isnan("score")).count() == 10


def test_als_same_seed_same_factors(spark):
    data = _als_data(spark)
    a = als.fit_als(data, rank=4, max_iter=3, user_blocks=2, item_blocks=2, seed=1)
    b = als.fit_als(data, rank=4, max_iter=3, user_blocks=2, item_blocks=2, seed=1)
    fa = {r["id"]: list(r["features"]) for r in a.userFactors.collect()}
    fb = {r["id"]: list(r["features"]) for r in b.userFactors.collect()}
    assert fa == fb


def test_als_rejects_ids_outside_int(spark):
    data = spark.createDataFrame([(3_000_000_000, 1, 1)], "user_id long, item_id long, interactions long")
    with pytest.raises(ValueError):
        als.fit_als(data, rank=2, max_iter=1)


def test_typed_scan_and_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], "a long, b double")
    path = tables.write_table(df, str(tmp_path / "t"), mode="overwrite")
    back = tables.read_table(spark, path, schema="b INT, a BIGINT")
    assert back.columns == ["b", "a"] and sorted(tuple(r) for r in back.collect()) == [(2, 1), (3, 2)]
    with pytest.raises(Exception):
        tables.write_table(df, path)


def test_union_distinct_and_profile(spark):
    a = spark.createDataFrame([(1, "a")], "u long, i string")
    b = spark.createDataFrame([(1, "a"), (2, "b")], "u long, i string")
    assert tables.union_distinct(a, b).count() == 2
    prof = {r["stage"]: r["rows"] for r in tables.profile({"a": a, "b": b}).collect()}
    assert prof == {"a": 1, "b": 2}
