"""Language identification by a convolutional network over bytes.

Texts are lower-cased (A-Z), taken as UTF-8 bytes and cut into windows of ``LENGTH`` bytes, the last one
filled up with zeros. Every byte has a learnt vector; filters of several widths run over the vectors,
the largest response of each filter in the window goes to a softmax over the languages. A text's
probabilities are the mean over all its windows.

The network is trained in numpy on a bounded sample: at most about ``sample_docs`` documents of each
language, chosen by a hash of doc_id, and ``sample_windows`` windows of each of them, spread over its
whole length. Prediction reads every whole text.

Cases: a text that is null or has no letter is ``und`` with score 0; rows without a language are not
learnt from; without any row to learn from everything is ``und``; repeated rows are predicted alike;
other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import batches, with_text_column

LENGTH = 256
WIDTHS = (2, 3, 4, 5)
STRIDE = 2  # every filter looks at every second place
SIZE = 8  # of a byte's vector
FILTERS = 10  # of each width
GUESS = "struct<lang string, score double>"
UNKNOWN = {"lang": "und", "score": 0.0}


def windows(text: bytes) -> np.ndarray:
    """All windows of a text, one row each."""
    count = max(1, -(-len(text) // LENGTH))
    return np.frombuffer(text.ljust(count * LENGTH, b"\0"), np.uint8).reshape(count, LENGTH)


class ByteNetwork:
    def __init__(self, languages: list[str], seed: int = 1):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.vectors = rng.normal(0, 0.5, (256, SIZE)).astype(np.float32)
        # Filters of all widths as one matrix; what a narrow filter does not see stays zero.
        self.seen = np.repeat(np.array([[i < w for w in WIDTHS] for i in range(max(WIDTHS))]), FILTERS, axis=1)
        self.seen = np.repeat(self.seen, SIZE, axis=0).astype(np.float32)
        self.filters = self.seen * rng.normal(0, 0.3, self.seen.shape).astype(np.float32)
        self.bias = np.zeros(self.seen.shape[1], np.float32)
        self.out = rng.normal(0, 0.1, (self.seen.shape[1], len(languages))).astype(np.float32)
        self.out_bias = np.zeros(len(languages), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.vectors, self.filters, self.bias, self.out, self.out_bias]

    def patches(self, rows: np.ndarray) -> np.ndarray:
        """The bytes' vectors side by side at every place a filter looks at."""
        vectors = self.vectors.copy()
        vectors[0] = 0
        line = vectors[rows].reshape(len(rows), -1)
        places = (LENGTH - max(WIDTHS)) // STRIDE + 1
        shape = (len(rows), places, max(WIDTHS) * SIZE)
        step = line.strides[1]
        return np.lib.stride_tricks.as_strided(line, shape, (line.strides[0], STRIDE * SIZE * step, step))

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        parts = [self.forward(rows[at : at + 256])[2] for at in range(0, len(rows), 256)]
        return np.concatenate(parts)

    def forward(self, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        patches = self.patches(rows)
        n, places, width = patches.shape
        responses = (patches.reshape(n * places, width) @ self.filters).reshape(n, places, -1)
        top = np.maximum(responses.max(axis=1) + self.bias, 0)
        scores = top @ self.out + self.out_bias
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        return responses, top, scores / scores.sum(axis=1, keepdims=True)

    def gradients(self, rows: np.ndarray, wanted: np.ndarray) -> list[np.ndarray]:
        responses, top, p = self.forward(rows)
        d_scores = p.copy()
        d_scores[np.arange(len(rows)), wanted] -= 1
        d_scores /= len(rows)
        d_top = (d_scores @ self.out.T) * (top > 0)
        places = responses.argmax(axis=1)  # only the largest response of a filter counts
        at = np.broadcast_to(np.arange(len(rows))[:, None], places.shape)
        chosen = self.patches(rows)[at, places]
        d_filters = np.einsum("nf,nfk->kf", d_top, chosen) * self.seen
        d_chosen = (d_top[:, :, None] * self.filters.T[None]).reshape(-1, SIZE)
        steps = places[:, :, None] * STRIDE + np.arange(max(WIDTHS))
        bytes_seen = rows[at[:, :, None], steps].ravel()
        d_vectors = np.stack([np.bincount(bytes_seen, d_chosen[:, k], 256) for k in range(SIZE)], axis=1)
        d_vectors[0] = 0
        return [d_vectors, d_filters, d_top.sum(0), top.T @ d_scores, d_scores.sum(0)]

    def fit(self, rows: np.ndarray, wanted: np.ndarray, epochs: int = 6, batch: int = 128, seed: int = 1) -> None:
        rng, step = np.random.default_rng(seed), 0
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.parameters()]
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(rows), batch):
                step += 1
                some = order[at : at + batch]
                for p, g, (m, v) in zip(self.parameters(), self.gradients(rows[some], wanted[some]), moments):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= 0.004 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)


def sample(docs: DataFrame, sample_docs: int, sample_windows: int) -> DataFrame:
    """lang, window of the sampled documents."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    limits = counts.select("lang", (F.lit(float(sample_docs)) / F.col("n")).alias("part"))
    place = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    # One row of two values for each language.
    chosen = rows.join(F.broadcast(limits), "lang").where(place < F.col("part")).select("lang", "text")

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts):
            langs, made = [], []
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = windows(text.encode().lower())
                kept = np.unique(np.linspace(0, len(found) - 1, sample_windows).astype(int))
                langs += [lang] * len(kept)
                made += [found[k].tobytes() for k in kept]
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(made, pa.binary())], ["lang", "window"])

    return chosen.mapInArrow(cut, "lang string, window binary")


def train(docs: DataFrame, sample_docs: int = 1500, sample_windows: int = 4) -> ByteNetwork:
    rows = sample(docs, sample_docs, sample_windows).toArrow().sort_by([("lang", "ascending"), ("window", "ascending")])
    network = ByteNetwork(sorted(set(rows["lang"].to_pylist())))
    if network.languages:
        number = {lang: k for k, lang in enumerate(network.languages)}
        data = np.frombuffer(b"".join(rows["window"].to_pylist()), np.uint8).reshape(-1, LENGTH)
        network.fit(data, np.array([number[lang] for lang in rows["lang"].to_pylist()]))
    return network


def with_language(docs: DataFrame, network: ByteNetwork, into: str = "language") -> DataFrame:
    """``docs`` plus a struct of the language and its probability."""
    sent = docs.sparkSession.sparkContext.broadcast(network)  # a few thousand numbers

    def start():
        network = sent.value

        def guess(texts: pa.Array) -> list[dict]:
            letters = pc.match_substring_regex(texts, r"\p{L}").to_pylist()
            found = [windows(t.encode().lower()) for t in texts.to_pylist()]
            if not network.languages:
                return [UNKNOWN] * len(found)
            p = network.probabilities(np.concatenate(found))
            starts = np.cumsum([0, *[len(f) for f in found[:-1]]])
            means = np.add.reduceat(p, starts, axis=0) / np.array([len(f) for f in found])[:, None]
            return [
                {"lang": network.languages[int(m.argmax())], "score": min(1.0, float(m.max()))} if has else UNKNOWN
                for m, has in zip(means, letters)
            ]

        return guess

    return with_text_column(docs, into, GUESS, start)
