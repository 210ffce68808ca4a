"""Language ID, language model and quality score: held-out accuracy, exact parts against brute force, defined cases."""

import random
import math

import numpy as np
from pyspark.sql import functions as F

from encore.llm import language, ngram_model, quality
from encore.llm.common import id_remainder
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held_out = id_remainder("doc_id", 3) == 1
    model = language.fit(docs.where(~held_out))
    assert sorted(model.languages) == ["de", "en", "es", "fr"]
    rows = docs.where(held_out).select("lang", language.identify(spark, model).alias("p")).collect()
    assert sum(r.lang == r.p.lang for r in rows) / len(rows) > 0.98
    assert sum(r.p.rejected for r in rows) <= 0.01 * len(rows)
    assert all(0 <= r.p.score <= 1 for r in rows)


def test_language_defined_cases(spark, odd, nothing, docs):
    model = language.fit(docs)
    rows = {(r.doc_id, r.text): r.p for r in odd.drop("p").withColumn("p", language.identify(spark, model)).collect()}
    for key in ((7, None), (8, ""), (9, " \n\t ")):
        assert (rows[key].lang, rows[key].score, rows[key].rejected) == ("und", 0.0, True)
    assert rows[14, "ünïcode Ärger 😀 straße \u0001 \\ | %"].lang in model.languages
    kept = language.keep_identified(odd, model)
    assert kept.columns == odd.columns and {7, 8, 9}.isdisjoint(r.doc_id for r in kept.collect())
    none = language.fit(nothing)
    assert none.languages == () and docs.limit(3).select(language.identify(spark, none).alias("p")).first().p.lang == "und"


def test_unlearnt_languages_and_random_letters_are_rejected(docs):
    coder = language.Coder(language.fit(docs))
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    for words in (5, 50, 200, 800):
        texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(words)) for _ in range(50)]
        assert sum(coder.predict(t)[3] for t in texts) >= 40
    assert all(coder.predict(t)[3] for t in ("Это короткое предложение на русском языке.", "これは短い日本語の文です。 東京に行きました"))


def test_a_single_language_and_rows_without_one(docs):
    english = docs.where("lang = 'en'").unionByName(docs.where("lang = 'de'").withColumn("lang", F.lit(None).cast("string")))
    model = language.fit(english)
    coder = language.Coder(model)
    assert model.languages == ("en",)  # rows without a language teach nothing
    texts = [r.text for r in docs.where("lang = 'en' and length(text) > 200").limit(40).collect()]
    found = [coder.predict(t) for t in texts]
    assert sum(not f[3] for f in found) >= 38 and all(f[0] == "en" and 0 <= f[1] <= 1 for f in found)
    assert coder.predict("Съешь ещё этих мягких французских булок, да выпей чаю. " * 3)[3]


def test_narrow_margins_are_rejected():
    model = language.LanguageModel(("a", "b"), (b" aaa bbb ccc ", b" aaa bbb ccc "), (0.125, 0.125))
    assert language.Coder(model).predict("aaa bbb ccc ddd")[3]


def test_base_scores_are_exact_with_few_broadcast_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 200").select("doc_id", "text")
    held_out = id_remainder("doc_id", 10) == 0
    rows = {r.doc_id: (r.text, r.h) for r in docs.withColumn("h", held_out).collect()}
    one, _ = brute.ngram_counts([t for t, h in rows.values() if not h])
    total, size = sum(one.values()), len(one)
    model = ngram_model.fit(docs.where(~held_out), bucket_bytes=50_000)
    assert (model.train_tokens, model.train_words) == (total, size)
    # The second call: 100 words broadcast, the rest joined; the filter in segments of 20 kB.
    results = [ngram_model.score(spark, docs, model), ngram_model.score(spark, docs, model, frequent=100, segment_bytes=20_000)]
    first, second = [{r.id: r for r in df.collect()} for df in results]
    for i, (t, _) in rows.items():
        w = [*brute.spaced(t), 0]
        base = sum(math.log10((one[x] + 0.1) / (total + 0.1 * (size + 1))) for x in w)
        for r in (first[i], second[i]):
            assert (r.n_tokens, r.n_known) == (len(w), sum(one[x] > 0 for x in w)) and abs(r.base_score - base) < 1e-6 * len(w)
        assert abs(first[i].score - second[i].score) < 1e-6 * len(w)


def test_scores_against_exact_counts(spark):
    """With 40 bits and 10 probes an insertion a false positive has probability 3e-7: levels are those of the exact counts."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held_out = id_remainder("doc_id", 10) == 0
    rows = {r.doc_id: (r.text, r.h) for r in docs.withColumn("h", held_out).collect()}
    one, two = brute.ngram_counts([t for t, h in rows.values() if not h])
    total, size, prior = sum(one.values()), len(one), 200.0
    level = {c: c.bit_length() for c in {*one.values(), *two.values()}}

    def means(counts):
        of = {}
        for c in counts.values():
            of.setdefault(level[c], []).append(c)
        return {0: 0.0} | {k: sum(v) / len(v) for k, v in of.items()}

    word, pair = means(one), means(two)
    model = ngram_model.fit(docs.where(~held_out), bits=40, probes=10, bucket_bytes=50_000)
    got = {r.id: r.score for r in ngram_model.score(spark, docs, model, segment_bytes=100_000).collect()}
    for i, (t, _) in rows.items():
        w, want = [*brute.spaced(t), 0], 0.0
        for u, v in zip([0, *w], w):
            single = (word[level.get(one[v], 0)] + 0.1) / (total + 0.1 * (size + 1))
            past = word[level.get(one[u], 0)]
            want += math.log10((min(pair[level.get(two.get((u, v), 0), 0)], past) + prior * single) / (past + prior))
        assert abs(got[i] - want) < 1e-6 * len(w)


def test_filter_gives_back_the_level_of_every_ngram():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    counts = rng.integers(1, 3000, 4000)
    import pyarrow as pa
    table = pa.table({"bucket": pa.array([0], pa.int32()), "words": [keys[:1000].tobytes()], "word_counts": [counts[:1000].astype(np.uint32).tobytes()],
                      "pairs": [keys[1000:].tobytes()], "pair_counts": [counts[1000:].astype(np.uint32).tobytes()]})
    part = ngram_model._builder(12, 5)((pa.scalar(0, pa.int32()),), table).to_pylist()[0]
    found = ngram_model.Filter([(0, part["bits"]), (1, part["bits"])], part["filter"], 1, 5)
    found.base[:] = 0
    want = ngram_model.levels(counts)
    got = found.levels(keys)
    assert (got >= want).all() and (got > want).mean() < 0.02  # never too low, seldom too high
    assert (found.levels(rng.integers(0, 1 << 63, 4000, dtype=np.uint64)) > 0).mean() < 0.02


def test_model_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    held_out = id_remainder("doc_id", 10) == 0
    rows = ngram_model.score(spark, docs, ngram_model.fit(docs.where(~held_out))).withColumnRenamed("id", "doc_id").where(held_out).collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) and all(r.score <= 0 for r in rows)


def test_language_model_defined_cases(spark, odd, nothing):
    got = [(r.id, r.n_tokens) for r in ngram_model.score(spark, odd, ngram_model.fit(odd)).collect()]
    assert len(got) == odd.count() and {(7, 1), (8, 1), (9, 1), (11, 3)} <= set(got) and got.count((12, 8)) == 2
    unknown = ngram_model.score(spark, odd, ngram_model.fit(nothing)).collect()
    assert len(unknown) == odd.count() and all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in unknown)
    assert ngram_model.score(spark, nothing, ngram_model.fit(odd)).count() == 0


def test_quality_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held_out = id_remainder("doc_id", 4) == 2
    net = quality.fit(docs.where(~held_out), labels.where(~held_out))
    rows = docs.where(held_out).join(labels, "doc_id").select("quality", quality.quality_score(spark, net).alias("score")).collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad)) > 0.9


def test_chunks_cover_every_byte():
    for n in (0, 1, 895, 896, 897, 1024, 1025, 5000):
        data = bytes(i % 251 for i in range(n))
        chunks = quality.chunked(data)
        assert chunks.shape[1] == quality.CHUNK
        step, out = quality.CHUNK - quality.OVERLAP, []
        for k, c in enumerate(chunks):
            out += c[:step].tolist() if k < len(chunks) - 1 else c.tolist()
        assert bytes(x for x in out if x != quality.PADDING) == data


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = quality.ByteConvNet.random(rng, dim=4, width=4, filters=6, hidden=5)
    for name in ("embed", "filters", "filter_bias", "hidden", "hidden_bias", "out", "out_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net._training = True
    x, y = rng.integers(0, 257, (7, 40)), rng.integers(0, 2, 7).astype(np.float64)

    def loss():
        z = net.forward(x)[0]
        return np.mean(np.log1p(np.exp(z)) - y * z)

    for w, g in zip(net.weights(), net.gradients(x, y, np.ones(7))):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, step = w[at], 1e-6
        w[at] = old + step
        up = loss()
        w[at] = old - step
        down = loss()
        w[at] = old
        assert abs((up - down) / (2 * step) - g[at]) < 1e-4 * max(1, abs(g[at]))


def test_quality_defined_cases(spark, odd, nothing, docs):
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (2, None), (3, 5), (None, 1)], "doc_id long, quality int")
    net = quality.fit(docs, labels)
    rows = odd.select("doc_id", "text", quality.quality_score(spark, net).alias("score")).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (7, 8)}) == 1 and len({r.score for r in rows if r.doc_id in (12, 13)}) == 1
    none = quality.fit(docs, labels.limit(0))
    assert none is None and odd.select(quality.quality_score(spark, none).alias("s")).where(F.col("s") != 0.5).count() == 0
    assert nothing.select(quality.quality_score(spark, net)).count() == 0
