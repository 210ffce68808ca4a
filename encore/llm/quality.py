"""Quality score by a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it.
Bytes are embedded; learned filters of ``width`` bytes run over a chunk at
every ``stride``-th place; each filter's largest response in the chunk
(max-pooling) enters one hidden layer, which gives the chunk's logit. The
document's probability is the logistic function of its chunks' mean logit, so
a score does not drift with length.

The network is trained on the driver, on chunks of at most ``sample_rows``
labelled documents drawn by a hash: a bounded sample. Scoring is one pass over
the documents without a shuffle.

Defined cases: null and empty texts are one chunk of padding and get a score
like others; labels other than 0 and 1 (or null) teach nothing; a document
with several labels is several training rows; without any label every score is
0.5; repeated rows get equal scores; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.common import id_text, unit_hash

PADDING = 256  # the symbol after the bytes
CHUNK, OVERLAP = 1024, 128
#: Chunks that are worked on at once.
GROUP = 128


@dataclass
class ByteConvNet:
    """Weights; ``embed`` has 257 rows, the last for padding."""

    embed: np.ndarray
    filters: np.ndarray  # (width * embedding, filters)
    filter_bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    width: int = 8
    stride: int = 2

    @staticmethod
    def random(rng: np.random.Generator, dim: int = 8, width: int = 8, stride: int = 2, filters: int = 32, hidden: int = 16) -> ByteConvNet:
        def draw(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        return ByteConvNet(draw(257, dim, scale=0.5), draw(width * dim, filters, scale=(2 / (width * dim)) ** 0.5), np.zeros(filters, np.float32),
                           draw(filters, hidden, scale=(2 / filters) ** 0.5), np.zeros(hidden, np.float32),
                           draw(hidden, 1, scale=hidden ** -0.5), np.zeros(1, np.float32), width, stride)

    def windows(self, chunks: np.ndarray) -> np.ndarray:
        """(chunks, places, width * dim): the embedded bytes under the filters at every place."""
        embedded = self.embed[chunks]
        n, length, dim = embedded.shape
        places = (length - self.width) // self.stride + 1
        s = embedded.strides
        view = np.lib.stride_tricks.as_strided(embedded, (n, places, self.width * dim), (s[0], self.stride * s[1], s[2]))
        return np.ascontiguousarray(view)

    def forward(self, chunks: np.ndarray):
        """(logits, what the training step needs)."""
        x = self.windows(chunks)
        response = x.reshape(-1, x.shape[2]) @ self.filters
        response = response.reshape(x.shape[0], x.shape[1], -1)
        at = response.argmax(axis=1) if self._training else None
        pooled = response.max(axis=1) + self.filter_bias
        active = np.maximum(pooled, 0)
        inner = active @ self.hidden + self.hidden_bias
        shown = np.maximum(inner, 0)
        return (shown @ self.out + self.out_bias)[:, 0], (x, at, pooled, active, inner, shown)

    _training = False

    def gradients(self, chunks: np.ndarray, labels: np.ndarray, weights: np.ndarray):
        """Gradients of the mean weighted log loss, in the order of the weights."""
        logits, (x, at, pooled, active, inner, shown) = self.forward(chunks)
        n = len(labels)
        d_logit = (weights * (1 / (1 + np.exp(-logits)) - labels) / n).astype(np.float32)[:, None]
        d_out, d_shown = shown.T @ d_logit, d_logit @ self.out.T
        d_inner = d_shown * (inner > 0)
        d_hidden, d_active = active.T @ d_inner, d_inner @ self.hidden.T
        d_pooled = d_active * (pooled > 0)
        rows = x[np.arange(n)[:, None], at]  # the window that each filter's maximum comes from
        d_filters = np.einsum("nf,nfk->kf", d_pooled, rows)
        d_rows = d_pooled[:, :, None] * self.filters.T[None]
        under = at[:, :, None] * self.stride + np.arange(self.width)
        symbols = chunks[np.arange(n)[:, None, None], under]
        d_embed = np.zeros_like(self.embed)
        np.add.at(d_embed, symbols.ravel(), d_rows.reshape(-1, self.embed.shape[1]))
        return [d_embed, d_filters, d_pooled.sum(0), d_hidden, d_inner.sum(0), d_out, d_logit.sum(0)]

    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.filter_bias, self.hidden, self.hidden_bias, self.out, self.out_bias]


def chunked(data: bytes) -> np.ndarray:
    """(chunks, CHUNK) symbols: overlapping chunks over all bytes, the last one padded."""
    step = CHUNK - OVERLAP
    count = max(1, -(-max(0, len(data) - OVERLAP) // step))
    padded = np.full(count * step + OVERLAP, PADDING, np.int16)
    padded[:len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::step]


def train(rows: list[tuple[bytes, int]], epochs: int = 12, batch: int = 32, rate: float = 3e-3, seed: int = 3) -> ByteConvNet | None:
    """Adam on one random chunk of each row and epoch; the two labels weigh as often as they occur."""
    if not rows:
        return None
    rng = np.random.default_rng(seed)
    net = ByteConvNet.random(rng)
    net._training = True
    chunks = [chunked(data) for data, _ in rows]
    labels = np.array([y for _, y in rows], np.float32)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights()]
    steps, total = 0, epochs * -(-len(rows) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(rows), batch):
            picked = order[start:start + batch]
            x = np.stack([chunks[i][rng.integers(len(chunks[i]))] for i in picked])
            steps += 1
            now = rate * (1 - steps / (total + 1))
            for w, g, (m, v) in zip(net.weights(), net.gradients(x, labels[picked], np.ones(len(picked), np.float32)), moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= now * (m / (1 - 0.9 ** steps)) / (np.sqrt(v / (1 - 0.999 ** steps)) + 1e-8)
    net._training = False
    return net


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample_rows: int = 6000, excerpt_chars: int = 8000, seed: int = 3) -> ByteConvNet | None:
    """Train on the ``sample_rows`` labelled rows of smallest hash, on excerpts of ``excerpt_chars`` from a hashed place."""
    drawn = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
             .select(F.col(id_col), F.col(label_col).cast("int").alias("label"), unit_hash(seed, id_text(id_col)).alias("u"))
             .orderBy("u", id_col, "label").limit(sample_rows))
    length = F.length(text_col)
    start = F.floor(unit_hash(seed + 1, id_text(id_col)) * (F.greatest(length - excerpt_chars, F.lit(0)) + 1)).cast("int")
    excerpt = F.coalesce(F.substring(F.col(text_col), start + 1, F.lit(excerpt_chars)), F.lit(""))
    rows = (docs.select(F.col(id_col), excerpt.alias("excerpt")).join(F.broadcast(drawn), id_col)  # at most sample_rows rows
            .select("u", "label", "excerpt").orderBy("u", "label", "excerpt").limit(sample_rows).collect())
    return train([(r["excerpt"].encode("utf-8", "surrogatepass"), r["label"]) for r in rows], seed=seed)


def scorer(net: ByteConvNet, texts: list[str]) -> np.ndarray:
    """Probabilities of the texts."""
    parts = [chunked(t.encode("utf-8", "surrogatepass")) for t in texts]
    counts = np.array([len(p) for p in parts])
    logits = np.empty(counts.sum())
    at, waiting, size = 0, [], 0
    for i, p in enumerate(parts):
        for a in range(0, len(p), GROUP):
            waiting.append(p[a:a + GROUP])
            size += len(waiting[-1])
            if size >= GROUP or (i == len(parts) - 1 and a + GROUP >= len(p)):
                logits[at:at + size] = net.forward(np.concatenate(waiting))[0]
                at, waiting, size = at + size, [], 0
    mean = np.add.reduceat(logits, np.cumsum(counts) - counts) / counts
    # Rounded: a matrix product's last digits depend on what else is in it, and equal texts get equal scores.
    return 1 / (1 + np.exp(-np.round(mean, 4)))


def quality_score(spark: SparkSession, net: ByteConvNet | None, text_col: str = "text") -> Column:
    """A column expression: the probability of quality label 1."""
    if net is None:
        return F.lit(0.5)
    shared = spark.sparkContext.broadcast(asdict(net))

    def predict(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = ByteConvNet(**shared.value)
        for texts in arrays:
            out = [scorer(own, [t.as_py() or "" for t in texts[a:a + 256]]) for a in range(0, len(texts), 256)]
            yield pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    return F.arrow_udf(predict, "double").asNondeterministic()(F.col(text_col))
