"""Language ID against a plain loop over compressors, and the quality network against loops over places and filters."""

import math

import numpy as np
import pytest
import zstandard

from encore.llm import language, quality


def _plain_language(model, text):
    """(language, rejected) from one compressor call a piece and language."""
    plain = language.normalise(text or "")
    if not any(c.isalpha() for c in plain):
        return "und", True
    data, sizes = plain.encode(), []
    for content, naming in zip(model.dictionaries, model.naming_bytes):
        params = zstandard.ZstdCompressionParameters(strategy=zstandard.STRATEGY_GREEDY, min_match=3, window_log=17, hash_log=16, chain_log=16, search_log=4,
                                                     write_content_size=0, write_checksum=0, write_dict_id=0)
        total = 0
        for a in range(0, len(data), model.piece_bytes):
            coder = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=params)
            total += len(coder.compress(data[a:a + model.piece_bytes]))
        sizes.append((total + naming, total))
    order = sorted(range(len(sizes)), key=lambda i: (sizes[i][0], i))
    best, second = sizes[order[0]], sizes[order[1]]
    return model.languages[order[0]], second[1] - best[1] < model.min_bytes or (second[0] - best[0]) / second[0] < model.min_margin


def test_language_against_plain_compressors(spark, docs, odd):
    model = language.fit(docs)
    some = docs.select("doc_id", "text").unionByName(odd.where("doc_id <> 10").select("doc_id", "text"))
    rows = some.select("text", language.identify(spark, model).alias("p")).collect()
    assert len(rows) > 200
    for r in rows:
        assert (r.p.lang, r.p.rejected) == _plain_language(model, r.text)


def _plain_quality(net, text):
    data, logits, start = text.encode(), [], 0
    while True:
        chunk = list(data[start:start + quality.CHUNK])
        chunk += [quality.PADDING] * (quality.CHUNK - len(chunk))
        pooled = [-math.inf] * net.filters.shape[1]
        for place in range(0, quality.CHUNK - net.width + 1, net.stride):
            seen = np.concatenate([net.embed[s] for s in chunk[place:place + net.width]])
            for f in range(len(pooled)):
                pooled[f] = max(pooled[f], float(seen @ net.filters[:, f]))
        active = [max(0.0, p + float(b)) for p, b in zip(pooled, net.filter_bias)]
        inner = [max(0.0, sum(a * float(net.hidden[i, j]) for i, a in enumerate(active)) + float(net.hidden_bias[j])) for j in range(net.hidden.shape[1])]
        logits.append(sum(x * float(net.out[j, 0]) for j, x in enumerate(inner)) + float(net.out_bias[0]))
        if start + quality.CHUNK >= len(data):
            return 1 / (1 + math.exp(-sum(logits) / len(logits)))
        start += quality.CHUNK - quality.OVERLAP


def test_quality_against_loops(spark, docs):
    net = quality.ByteConvNet.random(np.random.default_rng(5), filters=6, hidden=4)
    net.filter_bias += 0.1
    net.out_bias += 0.2
    texts = ["", "x", "Grüße and so on. " * 20, "exactly" * 146 + "12", "long text " * 250] + [r.text for r in docs.where("length(text) < 900").limit(4).collect()]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(2)
    got = {r.doc_id: r.s for r in df.select("doc_id", quality.quality_score(spark, net).alias("s")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(_plain_quality(net, t), abs=1e-4)
