"""Registered queries against their SQL, and the pipeline against brute force, on the small tables."""

from collections import Counter

import pytest

import corpus_pipeline
from encore.llm import language
from encore.llm.oracle import ORACLE_SQL
from encore.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import SF
from tests.oracle_compare import compare


def test_one_query_for_each_operator():
    assert [int(k[2:].split("_")[0]) for k in QUERIES] == list(range(1, 14)) and set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_matches_duckdb(spark, key):
    assert compare(spark, SF, [key], verbose=False)[key][0] == "OK"


def test_stages_and_whole_match_brute_force(spark, docs):
    want = {r.doc_id: r.asDict() for r in docs.collect()}
    coder = language.Coder(language.fit(docs))
    want = {i: r for i, r in want.items() if not coder.predict(r["text"])[3]}
    label = brute.near_duplicates([(i, r["text"]) for i, r in want.items()])
    want = {i: r for i, r in want.items() if label[i][1] == i}
    for i, text, spans in brute.without_repeats([(i, r["text"]) for i, r in want.items()]):
        if spans:
            want[i] |= {"text": text, "n_chars": len(text)}
            if not text.strip():
                del want[i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for i in list(want):
        words, hit, _ = brute.contamination(want[i]["text"], items)
        if hit and 20 * hit >= words:
            del want[i]
    copies = brute.mix_counts([(i, r["source"]) for i, r in want.items()])
    rows = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in rows) == Counter({i: n for i, n in copies.items() if n})
    for r in rows:
        assert {c: r[c] for c in docs.columns} == want[r.doc_id]
    assert 0 < len(want) < docs.count()


def test_stages_keep_the_columns(spark, odd):
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd.select(cols), SF).columns == cols
        assert stage(spark, odd.select(cols).limit(0), SF).count() == 0


def test_the_native_operators_run_no_python(spark):
    for key in ("op2_mix_sources", "op3_fingerprints"):
        plan = QUERIES[key](spark, SF)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan
