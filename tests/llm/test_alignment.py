import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from encore.llm import alignment

TEXTS = ["<|endoftext|> and </s> <unk>", "a ▁ b", "tab\t two  spaces   three\n  line \n\n x", "　wide   space", "日本語のテキスト 中文", "x", " ", "  ", "\n",
         "naïve café  éé", "word" * 500, "\x00 \x01", "😀😃 emoji", "'s don't we'll", "same words here", "same words here", "a\x1c b \x85 c   d"]


@pytest.fixture(scope="module")
def pair():
    return alignment.load_pair(alignment.TOKENIZERS)


def tokens(pair, text):
    """Ids and ends of whole texts, straight from the libraries."""
    if not text:
        return [], [], [], []
    a = pair.a.encode(" " + text, add_special_tokens=False).ids
    b = pair.b.encode(text)
    raw = (" " + text).encode()
    if b"".join(pair.bytes_a[i] for i in a) != raw or b"".join(pair.bytes_b[i] for i in b) != raw:
        return [], [], [], []
    return a, b, np.cumsum([len(pair.bytes_a[i]) for i in a]).tolist(), np.cumsum([len(pair.bytes_b[i]) for i in b]).tolist()


def brute(pair, rows):
    """Sorted rows of the summary for rows (id, text): every overlap by comparing byte ranges, bounded by groups."""
    held, counts = [], Counter()
    for i, text in rows:
        a, b, ends_a, ends_b = tokens(pair, text)
        groups, linked, x, y = [], [], 0, 0
        begin_a, begin_b = [0, *ends_a], [0, *ends_b]
        for cut in sorted(set(ends_a) & set(ends_b)):
            u, v = ends_a.index(cut, x) + 1, ends_b.index(cut, y) + 1
            groups.append((a[x:u], b[y:v]))
            for p in range(x, u):
                for q in range(y, v):
                    if max(begin_a[p], begin_b[q]) < min(ends_a[p], ends_b[q]):
                        linked.append((a[p], b[q]))
            x, y = u, v
        counts.update(linked)
        held.append((i, a, b, groups, linked))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for i, a, b, groups, linked in held:
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, len(a), len(b), len(groups), len(linked), sum(counts[p] == best[p[1]] for p in linked), sum(counts[p] for p in linked),
                    hashlib.sha256(shown.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_documents_against_brute_force(pair, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = brute(pair, rows)
    assert found(alignment.summaries(docs.repartition(3))) == expected
    assert found(alignment.summaries(docs, broadcast_pairs=0)) == expected


def test_odd_rows(pair, odd, spark, nothing):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert found(alignment.summaries(odd)) == brute(pair, rows)
    rows = list(enumerate(TEXTS))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(alignment.summaries(df)) == brute(pair, rows)
    assert alignment.summaries(nothing).collect() == []


def test_alignments_hold_tokens_and_groups(pair, spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in alignment.alignments(df).collect():
        a, b, ends_a, ends_b = tokens(pair, TEXTS[r["id"]])
        assert (r["a_ids"], r["b_ids"]) == (a, b)
        cuts = sorted(set(ends_a) & set(ends_b))
        assert r["a_ends"] == [ends_a.index(c) + 1 for c in cuts] and r["b_ends"] == [ends_b.index(c) + 1 for c in cuts]


def test_stretches_tokenize_as_whole_texts(pair):
    assert pair.cuttable
    a, b = alignment.tokenize(pair, pa.array(TEXTS, pa.large_string()))
    for i, text in enumerate(TEXTS):
        x, y, _, _ = tokens(pair, text)
        assert a.ids[a.starts[i]:a.starts[i + 1]].tolist() == x and b.ids[b.starts[i]:b.starts[i + 1]].tolist() == y


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab é\t\n'1日▁ ", max_size=40), min_size=1, max_size=5))
def test_any_texts(texts):
    pair = alignment.load_pair(alignment.TOKENIZERS)
    a, b = alignment.tokenize(pair, pa.array(texts, pa.large_string()))
    for i, text in enumerate(texts):
        x, y, _, _ = tokens(pair, text)
        assert a.ids[a.starts[i]:a.starts[i + 1]].tolist() == x and b.ids[b.starts[i]:b.starts[i + 1]].tolist() == y


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 40)), st.sets(st.integers(1, 40)), st.integers(41, 50)), max_size=5))
def test_shared_cuts_are_all_found(texts):
    a, b, lo_a, lo_b, base, expected = [], [], [0], [0], 0, []
    for x, y, end in texts:
        a += [base + e for e in sorted(x | {end})]
        b += [base + e for e in sorted(y | {end})]
        expected += [base + e for e in sorted((x & y) | {end})]
        lo_a.append(len(a))
        lo_b.append(len(b))
        base += end
    a, b, lo_a, lo_b = (np.array(v, np.int64) for v in (a, b, lo_a, lo_b))
    last_a, last_b = alignment.shared_cuts(a, b, lo_a[:-1], lo_a[1:], lo_b[:-1], lo_b[1:])
    assert a[last_a].tolist() == b[last_b].tolist() == expected
