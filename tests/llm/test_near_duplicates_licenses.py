"""Near duplicates against brute force, components, and license scans."""

import random

import numpy as np

from encore.llm import licenses, near_duplicates
from encore.llm.components import connected_components
from tests.llm import brute


def test_matches_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.id: (r.n_shingles, r.component_id) for r in near_duplicates.near_duplicates(docs).collect()}
    want = brute.near_duplicates(rows)
    assert got == want and len({c for _, c in want.values()}) < len(want)


def test_chains_and_groups_with_much_in_common(spark):
    """Chains of edits, a large group of near copies, and texts that share half their words without being near."""
    rng = random.Random(4)

    def words(n):
        return [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]

    rows, base, common = [], words(200), words(60)
    for _ in range(25):  # a chain: each text differs from the one before in a few places
        base = list(base)
        for _ in range(3):
            base[rng.randrange(200)] = f"n{rng.randrange(10 ** 6)}"
        rows.append(" ".join(base))
    seed = words(120)
    rows += [" ".join(w if rng.random() > 0.01 else "edit" + str(k) for w in seed) for k in range(60)]
    rows += [" ".join(words(60) + common) for _ in range(60)]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: (r.n_shingles, r.component_id) for r in near_duplicates.near_duplicates(df).collect()}
    assert got == brute.near_duplicates(rows)


def test_pairs_among_many_nearly_near_texts_are_found(spark):
    """1500 texts of similarity 170/230 = 0.739, and 50 pairs of them of similarity 173/227 = 0.762."""
    common, rows = " ".join(f"common{i}" for i in range(174)), []
    for k in range(1500):
        with_partner = [f"pair{k // 2}x{i}" for i in range(3)] if k < 100 else [f"own{k}y{i}" for i in range(3)]
        rows.append((k * 7919 % 1500, " ".join([common, *with_partner, *(f"own{k}x{i}" for i in range(27))]), k // 2 if k < 100 else None))
    got = {r.id: r.component_id for r in near_duplicates.near_duplicates(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()}
    pairs = {}
    for i, _, pair in rows:
        if pair is not None:
            pairs.setdefault(pair, []).append(i)
    want = {i: min(pairs[pair]) if pair is not None else i for i, _, pair in rows}
    assert got == want


def test_common_counts():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.choice(rng.choice([20, 400, 6000]), 150)).astype(np.int64) for _ in range(90)]
    got = near_duplicates.common_counts(sets)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(90) for j in range(i + 1, 90))


def test_half_keys_meet_as_often_as_they_should():
    rng = np.random.default_rng(2)
    pairs = []
    for _ in range(400):
        common = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
        pairs += [np.concatenate([common, rng.integers(0, 1 << 63, 50, dtype=np.uint64)]) for _ in range(2)]  # similarity 0.75
    keys = near_duplicates.half_keys(pairs, 10, 2, 5)
    a, b = keys[0::2] == keys[1::2], None
    assert abs(a.mean() - 0.75 ** 2) < 0.03
    b = a[:, :10].any(axis=1) & a[:, 10:].any(axis=1)
    assert b.mean() > 0.99


def test_defined_cases(spark, odd, nothing):
    got = [(r.id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates.near_duplicates(odd).collect()]
    assert len(got) == odd.count()
    assert got.count((12, 3, 12, True)) == 2 and (13, 3, 12, False) in got
    assert (7, 0, 7, True) in got and (8, 0, 8, True) in got and (11, 1, 11, True) in got
    assert [x[2:] for x in got if x[0] is None] == [(None, True)]
    assert near_duplicates.near_duplicates(nothing).count() == 0
    kept = near_duplicates.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=lambda x: x or 0) == [None, 7, 8, 9, 10, 11, 12, 14]
    # Rows that share an id join the groups of all its texts.
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "g h i j k l"), (5, "g h i j k l")]
    linked = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.id, r.component_id) for r in linked} == {(1, 1), (2, 1), (5, 1)}


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == brute.components({x for e in links for x in e}, links)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_patience_alignment():
    a, b = "x a b c y d e z".split(), "a b c d e".split()
    assert [(a[i], b[j]) for i, j in licenses.align(a, b)] == [(w, w) for w in b]
    assert licenses.increasing([3, 1, 2, 5, 4]) in ([1, 2, 4], [1, 2, 3])
    rng = random.Random(0)
    for _ in range(200):
        a, b = [[rng.choice("abcdefgh") for _ in range(rng.randint(0, 12))] for _ in range(2)]
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    same = [rng.choice("abc") for _ in range(50)]
    assert len(licenses.align(same, same)) == 50


def common_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_alignment_against_the_longest_common_subsequence():
    rng = random.Random(5)
    for _ in range(200):  # words unique on either side: all that both hold are anchors
        a, b = ([f"w{x}" for x in rng.sample(range(60), rng.randint(0, 40))] for _ in range(2))
        assert len(licenses.align(a, b)) == common_length(a, b)


def test_scan_against_every_window():
    """Notices of unique words, damaged and interrupted: found if and only if some window of the greatest length covers them."""
    rng = random.Random(6)
    notice = [f"n{i}" for i in range(30)]
    scanner = licenses.Scanner({"N": " ".join(notice)}, 0.8, 1.5)
    code, seen = {w: i for i, w in enumerate(scanner.vocabulary)}, set()
    for _ in range(150):
        damaged = [w for w in notice if rng.random() > 0.12]
        at, extra = rng.randrange(len(damaged)), rng.randrange(28)
        damaged[at:at] = ["x"] * extra
        text = ["y"] * rng.randrange(60) + damaged + ["y"] * rng.randrange(60)
        want = any(common_length(text[p:p + 45], notice) >= 24 for p in range(len(text)))
        found = scanner.scan(np.array([code.get(w, -1) for w in text]))
        assert (len(found) == 1) == want
        if found:
            assert common_length(text[found[0][1]:found[0][2]], notice) == round(found[0][3] * 30)
        seen.add((want, extra > 20))
    assert len(seen) >= 3  # also notices interrupted by over 20 words


def test_license_matches(spark, odd):
    mit = licenses.TEMPLATES["MIT-text"]
    changed = mit.replace("free of charge", "at no cost").replace("without restriction", "freely")
    texts = ["Some prose. " + changed + " The end.", "All rights reserved. Mid text here. " * 30, "all our rights are well reserved by nobody in particular",
             "Licensed under the\nApache License,\n Version 2.0.", "license " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.f for r in df.select("doc_id", licenses.scan_licenses().alias("f")).collect()}
    assert found[0].license == "MIT-text" and 0.9 < found[0].coverage < 1 and len(found[0].matches) == 1
    assert texts[0][found[0].matches[0].start:found[0].matches[0].end].startswith("Permission is hereby")
    assert len(found[1].matches) == 30 and found[2].license is None and found[4].license is None
    assert (found[3].license, found[3].coverage) == ("Apache-2.0", 1.0)
    assert odd.withColumn("f", licenses.scan_licenses()).where("f.license is not null").count() == 0
    assert odd.limit(0).select(licenses.scan_licenses()).count() == 0


def test_names_and_versions_tell_licenses_apart(spark):
    gpl3 = licenses.TEMPLATES["GPL-3.0"]
    cases = {"Released under the BSD License.": "BSD", gpl3.replace("3", "2"): "GPL-2.0", gpl3.replace("General", "Lesser General"): "LGPL-3.0",
             gpl3.replace("General", "Affero General"): "AGPL-3.0", "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0-short",
             "All your rights reserved": None, "MIT License\n\nCopyright (c) 2020 Ann": "MIT-copyright", "SPDX-License-Identifier: GPL-2.0": None,
             licenses.TEMPLATES["Apache-2.0-notice"].replace("of the License at", "of it " + "foreign " * 21 + "of the License at"): "Apache-2.0-notice",
             "Released under the Foo License.": None, gpl3.replace("3", "7"): None, gpl3: "GPL-3.0",
             "Released under the BSD License. Released under the MIT License.": "BSD,MIT"} | {v: k for k, v in licenses.TEMPLATES.items()}
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    rows = df.select("doc_id", licenses.scan_licenses().alias("f")).collect()
    got = {r.doc_id: ",".join(sorted(m.license for m in r.f.matches)) or None for r in rows}
    assert [got[i] for i in range(len(cases))] == list(cases.values())
