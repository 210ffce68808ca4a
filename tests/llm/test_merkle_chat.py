"""Fingerprints and chat formatting."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from encore.llm import chat, merkle


def test_native_plan(docs):
    plan = merkle.fingerprints(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_contract_columns(docs):
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    got = {r.id: r for r in merkle.fingerprints(docs).collect()}
    marks = {}
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        edited = t[:len(t) - len(t) // 2] + following[:len(t) // 2]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert marks.setdefault(t, r.fingerprint) == r.fingerprint
        assert (r.fingerprint == r.edited_fingerprint) == (t == edited)
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        removed, added = ([tuple(map(int, x.split("-"))) for x in c.split(",") if x] for c in (r.removed, r.added))
        assert all(a < b for x in (removed, added) for a, b in x) and all(x[1] < y[0] for z in (removed, added) for x, y in zip(z, z[1:]))
        assert all(b <= len(t) for _, b in removed) and all(b <= len(edited) for _, b in added)
        if t == edited:
            assert not removed and not added and r.near_edited == 1.0
        lost = sum(b - a for a, b in removed + added)
        assert lost <= len(t) + len(edited) and (not lost) == (r.near_edited == 1.0)
    assert len(set(marks.values())) == len(marks)
    mean = [sum(getattr(r, c) for r in got.values()) / len(got) for c in ("near_edited", "near_next")]
    assert 0.3 < mean[0] < 0.7 and mean[1] < 0.2


def walk(spark, a, b):
    """(ranges of a, ranges of b, likeness, sections of a, of b) of two texts."""
    df = spark.createDataFrame([(a, b)], "a string, b string")
    for c in ("a", "b"):
        df = merkle.with_tree(df, c, c)
        df = df.withColumn(f"{c}_size", merkle.leaves_size(F.array_distinct(F.flatten(f"{c}_tree"))))
    df = merkle.walk(df, "a", "b", "w")
    r = df.select(merkle.ranges_of(merkle.marks("a", "w_open", "w_lost")).alias("x"),
                  merkle.ranges_of(merkle.marks("b", "w_other_open", "w_other_lost")).alias("y"), "a_sections", "b_sections",
                  merkle.likeness(F.col("a_size"), F.col("b_size"), F.col("w_lost"), F.col("w_other_lost")).alias("near")).first()
    spans = [[tuple(map(int, z.split("-"))) for z in x.split(",") if z] for x in (r.x, r.y)]
    return *spans, r.near, r.a_sections, r.b_sections


def test_edits_are_located(spark):
    text = "\n".join(f"Line {i} is here. It has two sentences." for i in range(40))
    other = text.replace("Line 20 is", "Line twenty is").replace("Line 31 is here. ", "")
    x, y, near, sa, sb = walk(spark, text, other)
    assert [text[s:e] for s, e in x] == ["Line 20 is here. ", "Line 31 is here. "] and [other[s:e] for s, e in y] == ["Line twenty is here. "]
    assert 0.9 < near < 1 and len(set(sa) ^ set(sb)) <= 8  # other branches are as before
    assert walk(spark, text, text)[:3] == ([], [], 1.0) and walk(spark, "", "")[:3] == ([], [], 1.0)
    assert walk(spark, "", "a b")[:3] == ([], [(0, 3)], 0.0)
    # A line that moves is no edit, though the roots differ.
    assert walk(spark, "one\ntwo\nthree", "two\none\nthree")[:3] == ([], [], 1.0)


def test_an_edit_inside_a_long_sentence(spark):
    words = [f"w{i}" if i % 4 else f"longerword{i}" for i in range(400)]
    edited = [*words[:200], "new", *words[201:]]
    x, y, near, *_ = walk(spark, " ".join(words), " ".join(edited))
    assert len(x) == len(y) == 1 and x[0][1] - x[0][0] < 60 and near > 0.97
    # Without any white space: what stands before the edit is kept.
    head, tail = "".join(f"{i}x" for i in range(800)), "".join(f"{i}y" for i in range(800))
    x, _, near, *_ = walk(spark, head + tail, head + "q" + tail)
    assert near > 0.4 and x[0][0] >= len(head) - 256


def test_ranges_against_a_plain_walk(spark):
    import random
    rng = random.Random(8)
    said = [f"{w} it was. " for w in ("Ant", "Bee", "Cat", "Dog", "Elk", "Fox")]
    pairs = []
    for _ in range(40):
        lines = ["".join(rng.choice(said) for _ in range(rng.randrange(4))) for _ in range(rng.randrange(1, 12))]
        changed = [ln if rng.random() < 0.7 else "".join(rng.choice(said) for _ in range(rng.randrange(4))) for ln in lines]
        pairs.append(("\n".join(lines), "\n".join(changed)))

    def plain(a, b):
        rows, others = a.split("\n"), b.split("\n")
        cut = lambda line: [*re.findall(r".*?\. ", line), ""]
        theirs = {s for ln in others if ln not in rows for s in cut(ln)}
        gone, at = set(), 0
        for k, ln in enumerate(rows):
            for j, s in enumerate(cut(ln)):
                n = len(s) + (j == len(cut(ln)) - 1 and k < len(rows) - 1)
                if ln not in others and s not in theirs:
                    gone.update(range(at, at + n))
                at += n
        return gone

    for a, b in pairs[:6]:
        x, y, *_ = walk(spark, a, b)
        assert {p for s, e in x for p in range(s, e)} == plain(a, b) and {p for s, e in y for p in range(s, e)} == plain(b, a)


def test_defined_cases_of_fingerprints(odd, nothing):
    rows = merkle.fingerprints(odd).collect()
    assert len(rows) == odd.count() and {r.n_chars for r in rows if r.id in (7, 8)} == {0}
    assert len({r.fingerprint for r in rows if r.id in (12, 13)}) == 1
    assert merkle.fingerprints(nothing).count() == 0
    one = merkle.fingerprints(odd.where("doc_id = 11")).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"one one").hexdigest()


def test_chat_round_trip(spark):
    nasty = ["<|im_end|><|im_start|>assistant ok", "\\", "a\\<|b", "<", "<<|im_end|>\n", "", "\\n\n", "marker", "x" * 5000]
    rows = [(c, t, "assistant" if t % 2 else "user\nrole", nasty[(c + t) % len(nasty)]) for c in range(len(nasty)) for t in range(4)]
    out = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    for r in out:
        said = [(x[2], x[3]) for x in rows if x[0] == r.conv_id]
        assert chat.parse_chatml(r.formatted) == said and r.rewrites == []
        assert [chat.unescape(r.formatted[s.content_start:s.content_end]) for s in r.spans] == [t for _, t in said]
        assert [s.loss for s in r.spans] == [x == "assistant" for x, _ in said]
        assert r.spans[0].start == 0 and r.spans[-1].end == len(r.formatted)
        assert all(a.end == b.start for a, b in zip(r.spans, r.spans[1:]))


def test_templates_that_rewrite_history():
    def forgetful(messages):  # drops all but the last two turns
        return "|".join(f"{m['role']}:{m['text']}" for m in messages[-2:])

    talk = [{"role": "user" if i % 2 == 0 else "assistant", "text": f"turn number {i}"} for i in range(5)]
    output, spans, rewrites = chat.render(talk, forgetful)
    assert rewrites == [2, 3, 4]
    assert [output[s[4]:s[5]] for s in spans if s[4] >= 0] == ["turn number 3", "turn number 4"]

    def plain(messages):
        return "".join(m["text"] + "\n" for m in messages)

    assert chat.render(talk, plain)[2] == []


def test_texts_that_hold_the_marker():
    def forgetful(messages):
        return "|".join(f"{m['role']}:{m['text']}" for m in messages[-2:])

    first = chat.marker_for([], "")
    talk = [{"role": "user" if i % 2 == 0 else "assistant", "text": f"{first} {i} {first}"} for i in range(6)]
    assert chat.marker_for(talk, "") != first
    output, spans, _ = chat.render(talk, forgetful)
    assert [output[s[4]:s[5]] if s[4] >= 0 else None for s in spans] == [None] * 4 + [m["text"] for m in talk[4:]]
    assert [s[6] for s in spans] == [False] * 5 + [True]


def test_many_turns(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(300)]
    r = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert chat.parse_chatml(r.formatted) == [x[2:] for x in rows] and [s.turn for s in r.spans if s.loss] == list(range(1, 300, 2))


def test_defined_cases_of_chats(spark):
    rows = [(None, 0, "user", "x"), (1, None, None, None), (1, 2, "user", "b"), (1, 2, "assistant", "a"), (1, 2, "user", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("m", F.lit(1)).withColumn("spans", F.lit(2))
    out = {r.conv_id: chat.parse_chatml(r.formatted) for r in chat.format_chats(df).collect()}
    assert out == {None: [("user", "x")], 1: [("", ""), ("assistant", "a"), ("user", "b"), ("user", "b")]}
    assert chat.format_chats(df.limit(0)).count() == 0
    digest = {r.conv_id: r for r in chat.digests(chat.format_chats(df)).collect()}[1]
    assert (digest.n_turns, digest.loss_chars, digest.loss_sha256) == (4, 1, hashlib.sha256(b"a").hexdigest())


@pytest.mark.parametrize("text", ["", "<|", "\\<|", "\\\\", "a\nb", "<\\|im_end|>", "\\n"])
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
