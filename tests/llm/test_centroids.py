import hashlib
import math

import pytest
from pyspark.sql import functions as F

from encore.llm import centroids

SF = "/root/testdata/sf0.001"


def brute(rows, dims, k=16, rounds=3, scale=64, seed=1):
    """Sorted [(id, cluster, distance)] and the centroids, for rows (id, vector)."""
    kept = [(i, [math.floor(float(x) * scale) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    at = [v for _, v in sorted(kept, key=key)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(at))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        at = [[sum(x) // len(x) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(at)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in kept), key=str), at


def found(clusters):
    return sorted(((r["id"], r["cluster"], r["distance"]) for r in centroids.assignments(clusters).collect()), key=str)


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.read.parquet(f"{SF}/embeddings.parquet")


@pytest.mark.parametrize("block", [16, 5, 64])
def test_against_brute_force(vectors, block):
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    expected, at = brute(rows, 64)
    clusters = centroids.fit(vectors.repartition(3), "vec_id", "embedding", 64, block=block)
    assert found(clusters) == expected
    assert clusters.centroids.tolist() == at


def test_summary(vectors):
    clusters = centroids.fit(vectors, "vec_id", "embedding", 64)
    rows = found(clusters)
    for r in centroids.summary(clusters).collect():
        own = [d for _, c, d in rows if c == r["cluster"]]
        assert (r["n"], r["cluster_inertia"], r["inertia"]) == (len(own), sum(own), sum(d for *_, d in rows))
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, clusters.centroids[r["cluster"]])).encode()).hexdigest()


def test_odd_rows(spark):
    """Null, short, long and non-finite vectors go; null and repeated ids, equal vectors, ties and clashing names stay."""
    rows = [(1, [0.0, 1.0]), (2, [0.0, 1.0]), (2, [3.0, 4.0]), (None, [-3.5, 0.01]), (4, None), (5, []), (6, [1.0]), (7, [1.0, 2.0, 3.0]),
            (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (10, [None, 1.0]), (2, [3.0, 4.0]), (11, [1.5, 2.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.withColumns({c: F.lit("x") for c in ("id", "v", "h", "tile", "block", "n", "data", "ids", "cluster", "part")})
    for k in (1, 2, 16):
        expected, at = brute(rows, 2, k=k)
        clusters = centroids.fit(df, "vec_id", "embedding", 2, k=k, block=1)
        assert (found(clusters), clusters.centroids.tolist()) == (expected, at)


def test_tie_goes_to_the_smaller_number(spark):
    df = spark.createDataFrame([(i, [x]) for i, x in enumerate([0.0, 0.0, 0.0, 5.0])], "vec_id long, embedding array<float>")
    clusters = centroids.fit(df, "vec_id", "embedding", 1, k=4, rounds=1)
    zeros = [c for i, c, _ in found(clusters) if i < 3]
    assert len(set(zeros)) == 1 and zeros[0] == min(n for n, c in enumerate(clusters.centroids.tolist()) if c == [0])


def test_nothing_and_limits(spark, vectors):
    clusters = centroids.fit(vectors.limit(0), "vec_id", "embedding", 64)
    assert found(clusters) == [] and centroids.summary(clusters).count() == 0
    with pytest.raises(ValueError):
        centroids.fit(vectors, "vec_id", "embedding", 64, k=10**6)
    big = spark.createDataFrame([(1, [1e9])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="after scaling"):
        centroids.fit(big, "vec_id", "embedding", 1)


def test_one_vector_is_a_third_of_the_rows(spark):
    rows = [(i, [1.0, 2.0] if i % 3 else [float(i % 7), float(i % 11)]) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    expected, _ = brute(rows, 2, k=3)
    assert found(centroids.fit(df, "vec_id", "embedding", 2, k=3, block=1)) == expected
