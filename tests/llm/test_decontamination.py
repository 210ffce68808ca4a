"""FM-index and decontamination against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.llm import decontamination as d
from tests.llm import brute


@pytest.mark.parametrize("seed", range(6))
def test_index_finds_every_occurrence(seed):
    rng = random.Random(seed)
    letters = "abc" if seed < 4 else "a"
    texts = [[rng.choice(letters + "??") for _ in range(rng.randint(0, 60))] for _ in range(8)]
    rows = sorted({(" ".join(rng.choice(letters) for _ in range(rng.randint(1, 4))), str(i)) for i in range(6)})
    phrases = d.Phrases(rows)
    code = {w: i + 1 for i, w in enumerate(phrases.vocabulary)}
    flat = [w for t in texts for w in t]
    starts = np.cumsum([0, *map(len, texts)])
    first, phrase = phrases.occurrences(np.array([code.get(w, 0) for w in flat], np.int64), starts[:-1])
    got = sorted(zip(first.tolist(), phrase.tolist()))
    want = []
    for p, window in enumerate(sorted({w for w, _ in rows})):
        words = window.split()
        for t, a in zip(texts, starts):
            want += [(int(a) + k, p) for k in range(len(t) - len(words) + 1) if t[k:k + len(words)] == words]
    assert got == sorted(want)


def test_matches_brute_force_in_blocks(spark, docs):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    want = {r.doc_id: brute.contamination(r.text, items) for r in docs.collect()}
    assert any(x[1] for x in want.values())
    for block_bytes, shard_bytes in ((32 << 20, 8 << 20), (30_000, 20_000)):  # the second: several blocks, many shards
        found, name = d.find_contamination(docs, bench, block_bytes=block_bytes, shard_bytes=shard_bytes)
        got = {r.doc_id: (r[name].n_words, r[name].n_hit, list(r[name]["items"])) for r in found.collect()}
        assert got == want
        assert found._jdf.queryExecution().optimizedPlan().toString().count("search(") == 1  # a block a plan


def test_defined_cases(spark, odd, nothing):
    bench = spark.createDataFrame([(1, "One  TWO"), (2, None), (3, "..."), (None, "straße"), (1, "same words here")], "item_id long, text string")
    found, name = d.find_contamination(odd, bench)
    got = [(r.doc_id, r[name].n_words, r[name].n_hit, list(r[name]["items"])) for r in found.collect()]
    assert found.columns[:-1] == odd.columns and len(got) == odd.count()
    assert (11, 2, 2, ["1"]) in got and (7, 0, 0, []) in got and (8, 0, 0, []) in got and got.count((12, 7, 3, ["1"])) == 2
    assert [x[2:] for x in got if x[0] == 14] == [(1, [""])]
    assert d.drop_contaminated(odd, bench).columns == odd.columns
    assert {r.doc_id for r in d.drop_contaminated(odd, bench).collect()} == {None, 7, 8, 9, 10}
    empty, name = d.find_contamination(odd, bench.limit(0))
    assert {r[name].n_hit for r in empty.collect()} == {0}
    assert d.find_contamination(nothing, bench)[0].count() == 0


def test_spans_are_cut_from_the_text(spark):
    docs = spark.createDataFrame([(1, "Keep this. Alpha, BETA gamma! And this.")], "doc_id long, text string")
    bench = spark.createDataFrame([(5, "alpha beta gamma")], "item_id long, text string")
    found, name = d.find_contamination(docs, bench)
    assert found.select(d.remove_spans("text", name).alias("t")).first().t == "Keep this. ! And this."
    assert "Exchange" not in found.where(F.col(name)["n_hit"] > 0)._jdf.queryExecution().executedPlan().toString()
