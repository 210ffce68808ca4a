"""Substring dedup and source mixing against plain Python, and their defined cases."""

import math
import random
from collections import Counter

import pyarrow as pa

from encore.llm import mixing, substrings
from tests.llm import brute

PASSAGE = " ".join(f"shared{i}" for i in range(30)) + ". " + " ".join(f"more{i}" for i in range(30)) + "."


def test_matches_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    done, name = substrings.remove_repeats(docs)
    got = {r.doc_id: (r[name].text, [(s.start, s.end) for s in r[name].spans]) for r in done.collect()}
    want = {i: (t, s) for i, t, s in brute.without_repeats(rows)}
    assert got == want
    assert any(s for _, s in want.values())


def test_passage_inside_a_line_goes_and_clean_text_stays(spark):
    rows = [(3, f"Own start here. {PASSAGE} Own end three."), (1, f"First text. {PASSAGE} Tail one."), (2, "Yes. First text. No. Quite clean.")]
    out = {r.doc_id: r.text for r in substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: rows[1][1], 2: rows[2][1], 3: "Own start here. Own end three."}


def test_no_long_run_and_no_copy_stays(spark):
    rng = random.Random(4)
    word = lambda: rng.choice("abcdefgh") + str(rng.randint(0, 60)) + rng.choice(["", "", "", "", "", "", ".", ","])
    shared = [[word() for _ in range(rng.randint(50, 90))] for _ in range(12)]
    rows = []
    for i in range(160):
        own = [word() for _ in range(rng.randint(0, 60))]
        k = rng.randint(0, len(own))
        rows.append((i, rng.choice([" ", "  "]).join(own[:k] + (rng.choice(shared) if i % 3 else []) + own[k:])))
    rows += [(200, "A short note. "), (201, "a short  note."), (202, "A short note. And more.")]
    out = substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    seen, left = set(), {r.doc_id: r.text for r in out}
    for i in sorted(left):
        w = left[i].lower().split()
        runs = {tuple(w[k:k + 50]) for k in range(len(w) - 49)}
        assert not runs & seen
        seen |= runs
    assert 200 in left and 201 not in left and left[202] == rows[-1][1]
    assert all(left.get(i, t) == t for i, t in rows if not i % 3)  # nothing of a document without a shared passage goes
    want = {i: t for i, t, _ in brute.without_repeats(rows)}
    assert left == {i: t for i, t in want.items() if t.strip() or not dict(rows)[i]}  # an empty text stays


def test_stretches_cover_the_text():
    texts = pa.array(["", " \n ", " \n a. é\u00a0B \n\n c", "x", "A. É\u00a0b c"], pa.large_string())
    row, start, end, digest = substrings.stretches(texts, 25)
    assert list(zip(row, start, end)) == [(2, 0, 14), (3, 0, 1), (4, 0, 8)]
    assert digest[0].tolist() == digest[2].tolist() != digest[1].tolist()
    assert len(substrings.stretches(texts.slice(0, 2), 25)[0]) == 0


def test_defined_cases_of_repeats(odd, nothing):
    out = substrings.without_repeats(odd, min_words=3, length_col="n_chars")
    assert out.columns == odd.columns
    rows = Counter((r.doc_id, r.text) for r in out.collect())
    same = "same words here and there and everywhere"
    assert rows[12, same] == 2 and (13, same) not in rows  # repeated rows are one document; the later copy has nothing left
    assert rows[7, None] == rows[8, ""] == rows[9, " \n\t "] == 1
    assert substrings.without_repeats(nothing).count() == 0


def test_offsets_are_of_the_original(docs):
    done, name = substrings.remove_repeats(docs)
    for r in done.collect():
        kept, last = "", 0
        for s in r[name].spans:
            kept += r.text[last:s.start]
            last = s.end
        assert kept + r.text[last:] == r[name].text


def test_mix_matches_brute_force(docs):
    rows = [(r.doc_id, r.source) for r in docs.collect()]
    got = Counter(r.doc_id for r in mixing.mix(docs, mixing.source_rates(docs)).collect())
    assert got == Counter({i: n for i, n in brute.mix_counts(rows).items() if n})


def test_large_rates_follow_the_target(spark):
    df = spark.range(0, 600).selectExpr("id as doc_id", "concat('t', id) as text", "if(id < 20, 'few', 'many') as source")
    rates = mixing.source_rates(df, weights={"few": 3.0, "many": 1.0}, wanted_rows=8000)
    assert {r.source: (round(r.rate, 6), r.parts) for r in rates.collect()} == {"few": (300.0, 19), "many": (round(2000 / 580, 6), 1)}
    got = Counter(r.source for r in mixing.mix(df, rates).collect())
    assert abs(got["few"] - 6000) < 4 * math.sqrt(6000) and abs(got["many"] - 2000) < 4 * math.sqrt(2000)


def test_defined_cases_of_mixing(odd, nothing):
    rates = mixing.source_rates(odd, weights={None: 1.0, "absent": 2.0}, wanted_rows=200)
    out = mixing.mix(odd, rates)
    assert out.columns[:len(odd.columns)] == odd.columns and len(set(out.columns)) == len(out.columns)
    counts = Counter((r.doc_id, r.text) for r in out.collect())
    assert counts[12, "same words here and there and everywhere"] % 2 == 0  # repeated rows draw alike
    assert all(k in counts for k in ((None, "a text without an id that has quite a few words in it"), (7, None), (8, "")))
    assert mixing.mix(odd, mixing.source_rates(odd, weights={"absent": 1.0})).count() == 0
    assert mixing.mix(nothing, mixing.source_rates(nothing)).count() == 0


def test_shuffle_is_global(docs):
    ids = [r.doc_id for r in mixing.mix(docs, mixing.source_rates(docs)).collect()]
    assert ids != sorted(ids)
    again = [r.doc_id for r in mixing.mix(docs, mixing.source_rates(docs)).collect()]
    assert Counter(ids) == Counter(again)
