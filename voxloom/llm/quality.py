"""Quality classifier by positive-unlabelled learning.

It learns from trusted positives and from unlabelled web text alone; labelled negatives are never used.
With the class prior p (the share of good documents in the unlabelled text) the risk of a scorer g is

    p * E+[loss(g)] + max(0, Eu[loss(-g)] - p * E+[loss(-g)])

where the second part is the unbiased estimate of the risk on negatives, held at zero or above: when it
falls below, the step goes up that part's gradient instead, so that positives are not fitted out of the
unlabelled text. The loss is logistic, so the sigmoid of g estimates the probability of good quality.

The prior is estimated first: a plain classifier of positives against unlabelled text is fitted on one
half of the sample; on the other half, p is the least ratio of the shares of unlabelled and positive
texts above a threshold, the threshold being chosen by an upper confidence bound of that ratio.

Features are read from blocks of a whole text, so that memory is bounded and long texts count in full:
frequencies of pairs of neighbouring byte classes, and shares of repeated, capitalised and marked words.

The fit sees at most ``sample_rows`` positives and as many unlabelled documents, chosen by a hash of
doc_id, one row per doc_id. Scoring reads every whole text.

Cases: null and empty texts get the score that the model gives to no evidence; a document labelled more
than once is positive if all its labels say so; null labels and null doc_ids are not learnt from;
without positives or unlabelled text every score is 0.5; repeated rows are scored alike; other columns
are kept as they are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import batches, with_text_column

BLOCK = 1 << 14  # characters
CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\t\r", "\n", ".", ",", "!", "?", "-_", "'\"", "|", "*", "#", "$%&", "()[]{}", "<>", "/\\", ":;", "=+~^@`"]
N_CLASSES = len(CLASSES) + 3  # control bytes, lead and further bytes of other characters
BINS = 8


def byte_classes() -> np.ndarray:
    table = np.full(256, len(CLASSES), np.int64)
    table[0x80:0xC0], table[0xC0:] = len(CLASSES) + 2, len(CLASSES) + 1
    for k, letters in enumerate(CLASSES):
        table[list(letters.encode())] = k
    return table


CLASS_OF = byte_classes()
SHARES = 10
WIDTH = N_CLASSES**2 + SHARES + 1


def block_features(text: str) -> np.ndarray:
    """What one block of text shows; the shares lie between 0 and 1."""
    kinds = CLASS_OF[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    pairs = np.bincount(kinds[:-1] * N_CLASSES + kinds[1:], minlength=N_CLASSES**2)
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n, counts = max(len(words), 1), Counter(words)
    least = lambda c: 1 - len(c) / max(sum(c.values()), 1)
    shares = [
        least(counts),
        max(counts.values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        least(Counter(zip(words, words[1:]))),
        least(Counter(lines)),
        sum(w.isupper() for w in words) / n,
        sum(not w[-1].isalnum() for w in words) / n,
        sum(not any(map(str.isalpha, w)) for w in words) / n,
        sum(w[:1].isupper() for w in words) / n,
        min(sum(map(len, words)) / n / 20, 1.0),
    ]
    return np.concatenate([np.sqrt(pairs / max(len(kinds) - 1, 1)), shares, [1.0]])


def features(text: str | None) -> np.ndarray:
    """The mean over all blocks by their length; zeros for no text."""
    out, size = np.zeros(WIDTH), max(len(text or ""), 1)
    for at in range(0, len(text or ""), BLOCK):
        block = text[at : at + BLOCK]
        out += block_features(block) * (len(block) / size)
    return out


class Scorer:
    """A linear scorer over standardised features and bins of the shares."""

    def __init__(self, seen: np.ndarray):
        self.mean, self.spread = seen.mean(0), seen.std(0)
        self.used = np.flatnonzero(self.spread > 1e-9)
        shares = seen[:, N_CLASSES**2 : -1]
        self.edges = np.quantile(shares, np.arange(1, BINS) / BINS, axis=0)
        self.weights = np.zeros(len(self.used) + BINS * SHARES + 1)

    def rows(self, seen: np.ndarray) -> np.ndarray:
        scaled = np.clip((seen[:, self.used] - self.mean[self.used]) / self.spread[self.used], -6, 6)
        shares = seen[:, N_CLASSES**2 : -1]
        bins = [np.eye(BINS)[np.searchsorted(self.edges[:, k], shares[:, k], "right")] for k in range(SHARES)]
        return np.concatenate([scaled, *bins, np.ones((len(seen), 1))], 1)

    def scores(self, seen: np.ndarray) -> np.ndarray:
        return self.rows(seen) @ self.weights


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def risk_parts(g_pos: np.ndarray, g_unl: np.ndarray, prior: float) -> tuple[float, float]:
    """The risk on positives and the unbiased estimate of the risk on negatives, which may be below zero."""
    loss = lambda z: np.logaddexp(0, -z)
    return prior * loss(g_pos).mean(), loss(-g_unl).mean() - prior * loss(-g_pos).mean()


def _descend(scorer: Scorer, gradient, steps: int, rate: float) -> None:
    first, second = np.zeros_like(scorer.weights), np.zeros_like(scorer.weights)
    for step in range(1, steps + 1):
        slope = gradient(scorer.weights)
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        scorer.weights -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)


def fit(pos: np.ndarray, unl: np.ndarray, prior: float, *, ridge: float = 1e-3, steps: int = 500, rate: float = 0.03) -> Scorer:
    """The scorer of least non-negative risk."""
    scorer = Scorer(np.concatenate([pos, unl]))
    p, u = scorer.rows(pos), scorer.rows(unl)

    def gradient(w: np.ndarray) -> np.ndarray:
        g_pos, g_unl = p @ w, u @ w
        negative = _sigmoid(g_unl) @ u / len(u) - prior * (_sigmoid(g_pos) @ p) / len(p)
        if risk_parts(g_pos, g_unl, prior)[1] < 0:
            return -negative + ridge * w
        return prior * (-_sigmoid(-g_pos) @ p) / len(p) + negative + ridge * w

    _descend(scorer, gradient, steps, rate)
    return scorer


def positive_against_unlabelled(pos: np.ndarray, unl: np.ndarray, *, ridge: float = 1e-3, steps: int = 300) -> Scorer:
    """The plain classifier that the prior is read from."""
    scorer = Scorer(np.concatenate([pos, unl]))
    p, u = scorer.rows(pos), scorer.rows(unl)

    def gradient(w: np.ndarray) -> np.ndarray:
        return -_sigmoid(-(p @ w)) @ p / len(p) + _sigmoid(u @ w) @ u / len(u) + ridge * w

    _descend(scorer, gradient, steps, 0.03)
    return scorer


def share_above(pos: np.ndarray, unl: np.ndarray, delta: float = 0.1, gamma: float = 0.01) -> float:
    """The share of positives among the unlabelled, from scores of both that the fit has not seen."""
    at = np.unique(pos)
    above = lambda x: 1 - np.searchsorted(np.sort(x), at, "left") / len(x)
    p, u = above(pos), above(unl)
    slack = np.sqrt(np.log(4 / delta) / 2) * (1 / np.sqrt(len(pos)) + 1 / np.sqrt(len(unl)))
    best = int(np.argmin((u + (1 + gamma) * slack) / p))
    return float(min(u[best] / p[best], 1.0))


def estimated_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """Every second row is for the fit, the others for the estimate, and the other way round."""
    found = []
    for k in (0, 1):
        scorer = positive_against_unlabelled(pos[k::2], unl[k::2])
        found.append(share_above(scorer.scores(pos[1 - k :: 2]), scorer.scores(unl[1 - k :: 2])))
    return float(np.clip(np.mean(found), 0.01, 0.99))


def sample(docs: DataFrame, ids: DataFrame, n: int) -> np.ndarray:
    """Features of at most ``n`` documents with ids of the table ``ids``, one row per id."""
    total = max(ids.count(), 1)
    order = F.xxhash64("doc_id")
    few = ids.where(F.col("doc_id").isNotNull() & (F.pmod(order, F.lit(1 << 20)) <= (2 * n << 20) // total)).distinct()
    chosen = few.orderBy(order, "doc_id").limit(n)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # At most n numbers are broadcast; of the rows of one id the same one is always taken.
    one = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("r"))

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts):
            made = [features(t).astype(np.float32).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["doc_id", "seen"])

    found = one.select("doc_id", "r.text").mapInArrow(read, "doc_id long, seen binary").toArrow()  # at most n rows
    found = found.sort_by("doc_id")["seen"].to_pylist()
    return np.array([np.frombuffer(x, np.float32) for x in found], float).reshape(len(found), WIDTH)


def with_quality(
    docs: DataFrame, labels: DataFrame, unlabelled: DataFrame | None = None, into: str = "quality", *,
    sample_rows: int = 6000, prior: float | None = None, **options,
) -> DataFrame:
    """``docs`` plus the score 0 to 1 of each whole text.

    labels: doc_id, quality; only its positives are used. ``unlabelled``: the documents that stand for
    unlabelled web text, by default all; ``prior``: their share of good ones, estimated if not given.
    """
    unlabelled = docs if unlabelled is None else unlabelled
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("q")).dropna()
    good = marks.groupBy("doc_id").agg(F.min("q").alias("q")).where("q = 1").select("doc_id")
    pos = sample(docs, good, sample_rows)
    unl = sample(unlabelled, unlabelled.select(F.col("doc_id").cast("long").alias("doc_id")), sample_rows)
    scorer = None
    if min(len(pos), len(unl)) >= 4:
        scorer = fit(pos, unl, estimated_prior(pos, unl) if prior is None else prior, **options)
    sent = docs.sparkSession.sparkContext.broadcast(scorer)  # some hundred numbers

    def start():
        scorer = sent.value

        def score(texts: pa.Array) -> list[float]:
            if scorer is None or not len(texts):
                return [0.5] * len(texts)
            return _sigmoid(scorer.scores(np.array([features(t) for t in texts.to_pylist()]))).tolist()

        return score

    return with_text_column(docs, into, "double", start)
