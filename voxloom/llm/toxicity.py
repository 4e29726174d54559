"""Toxicity by a counterfactually regularised classifier.

A logistic regression over the words, and beginnings of words, that occur in a text. For every labelled text that names an
identity group a twin is made in which the term is swapped for another one of its kind, and the fit
penalises the squared difference of the two scores. So a term can only carry weight that its
counterparts carry too, and neutral mentions of a group are not taken for abuse.

The model is fitted on at most ``sample_rows`` labelled documents (chosen by a hash of doc_id, one row of each) and knows
at most ``vocabulary`` words, so what is sent to the tasks is bounded. Scoring reads every whole text.

Cases: null and empty texts get the score of no evidence; a document labelled more than once counts as
toxic if one label says so; null labels are ignored; without any usable label every score is 0.5;
repeated rows are scored alike; other
columns are kept as they are.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import batches, with_text_column, written

WORD = re.compile(r"[^\W\d_]+")
# Terms of one kind are swapped for each other. A parameter: these are examples in four languages.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "transgender"),
    ("woman", "man"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("african", "european", "american", "mexican", "chinese", "indian"),
    ("immigrants", "refugees", "natives"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
)


def words(text: str) -> set[str]:
    """The words of a text, and the beginnings of longer ones: abuse is often inflected."""
    found = set(WORD.findall(text.lower()))
    return found | {w[:4] + "*" for w in found if len(w) > 4} | {w[:5] + "*" for w in found if len(w) > 5}


def twins(found: set[str], groups: Sequence[Sequence[str]]) -> list[set[str]]:
    """The text's words with each identity term swapped for every other term of its kind."""
    out = []
    for group in groups:
        for term in found.intersection(group):
            out += [(found - words(term)) | words(other) for other in group if other != term]
    return out


def traces(groups: Sequence[Sequence[str]]) -> set[str]:
    """All that identity terms leave in a text's words."""
    return {w for group in groups for term in group for w in words(term)}


def associated(counts: Counter, toxic: Counter, rows: int, toxic_rows: int) -> dict[str, float]:
    """How far a word's share of toxic texts is from theirs overall, as a chi-squared value."""
    base = toxic_rows / rows if rows else 0.0
    spread = base * (1 - base) or 1.0
    return {w: n * (toxic[w] / n - base) ** 2 / spread * rows / max(rows - n, 1) for w, n in counts.items()}


class Rows:
    """Sets of word numbers as one flat array."""

    def __init__(self, sets: Sequence[set[str]], number: dict[str, int]):
        rows = [np.fromiter((number[w] for w in s if w in number), np.int64) for s in sets]
        self.size, self.width = len(rows), len(number)
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.word = np.concatenate(rows) if rows else np.zeros(0, np.int64)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.word], self.size)

    def gradient(self, slopes: np.ndarray) -> np.ndarray:
        return np.bincount(self.word, slopes[self.row], self.width)


def fit(
    sets: Sequence[set[str]], labels: Sequence[int], *, groups: Sequence[Sequence[str]] = IDENTITY_TERMS,
    counterfactual: float = 1.0, ridge: float = 0.1, min_chi2: float = 15.0, vocabulary: int = 20_000, steps: int = 600,
) -> tuple[dict[str, float], float]:
    """Weights of words and bias; the counterfactual term is the mean squared change of the score."""
    counts = Counter(w for s in sets for w in s)
    terms = traces(groups)
    chi2 = associated(counts, Counter(w for s, y in zip(sets, labels) if y for w in s), len(sets), sum(labels))
    kept = sorted((w for w in chi2 if chi2[w] >= min_chi2), key=lambda w: (-chi2[w], w))[:vocabulary]
    kept += [t for t in terms if t in counts]
    named = [(s, t) for s in sets for t in twins(s, groups)]
    kept = sorted(set(kept) | {t for _, twin in named for t in twin if t in terms})
    number = {w: i for i, w in enumerate(kept)}
    rows, left, right = Rows(sets, number), Rows([s for s, _ in named], number), Rows([t for _, t in named], number)
    y = np.asarray(labels, float)
    weights, bias = np.zeros(len(kept)), 0.0
    first, second = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for step in range(1, steps + 1 if len(sets) else 1):
        p = 1 / (1 + np.exp(-(rows.scores(weights) + bias)))
        slopes = (p - y) / len(y)
        gradient = np.append(rows.gradient(slopes) + ridge * weights / len(y), slopes.sum())
        if named and counterfactual:
            change = 2 * counterfactual * (left.scores(weights) - right.scores(weights)) / len(named)
            gradient[:-1] += left.gradient(change) - right.gradient(change)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        weights -= move[:-1]
        bias -= move[-1]
    return {w: float(weights[i]) for w, i in number.items() if weights[i]}, float(bias)


def sample(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """row, toxic, words of at most ``sample_rows`` labelled documents, one row per doc_id, written once."""
    toxic = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    chosen = toxic.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    # At most sample_rows rows of two numbers are broadcast; of the rows of one id the same one is always taken.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.first("toxic").alias("toxic"), F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("r")
    )

    def split(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts):
            made = [sorted(words(t or "")) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.list_(pa.string()))], ["row", "toxic", "words"])

    found = rows.select("doc_id", "toxic", "r.text").mapInArrow(split, "row long, toxic int, words array<string>")
    return written(found, "toxicity-sample")


def telling(rows: DataFrame, groups: Sequence[Sequence[str]], min_chi2: float) -> tuple[list[set[str]], list[int]]:
    """The sampled texts' words without those that tell nothing, which are nearly all of them.

    Words are counted in Spark; the driver gets the telling ones of each of the sampled texts.
    """
    n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    each = rows.select("row", "toxic", F.explode("words").alias("word"))
    counts = each.groupBy("word").agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic"))
    base = toxic / n if n else 0.0
    spread = base * (1 - base) or 1.0
    chi2 = F.col("n") * F.pow(F.col("toxic") / F.col("n") - base, 2) / spread * n / F.greatest(F.lit(n) - F.col("n"), F.lit(1))
    kept = counts.where((chi2 >= min_chi2) | F.col("word").isin(sorted(traces(groups)))).select("word")
    # Each of them once: no more than the texts have, whose words the driver gets below.
    sent = rows.sparkSession.sparkContext.broadcast(set(kept.toArrow()["word"].to_pylist()))

    def keep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            made = [[w for w in words if w in sent.value] for words in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.list_(pa.string()))], ["row", "toxic", "words"])

    held = rows.select("row", "toxic", "words").mapInArrow(keep, "row long, toxic int, words array<string>")
    held = held.orderBy("row").toArrow()  # bounded by sample_rows
    return [set(w) for w in held["words"].to_pylist()], held["toxic"].to_pylist()


def with_toxicity(
    docs: DataFrame, labels: DataFrame, into: str = "toxicity", *, sample_rows: int = 8000,
    groups: Sequence[Sequence[str]] = IDENTITY_TERMS, min_chi2: float = 15.0, **options,
) -> DataFrame:
    """``docs`` plus the score 0 to 1 of each whole text; ``labels`` are those to learn from."""
    sets, labels_of = telling(sample(docs, labels, sample_rows), groups, min_chi2)
    weights, bias = fit(sets, labels_of, groups=groups, min_chi2=min_chi2, **options)
    sent = docs.sparkSession.sparkContext.broadcast((weights, bias))  # bounded by vocabulary

    def start():
        weights, bias = sent.value

        def score(texts: pa.Array) -> list[float]:
            z = [bias + sum(weights[w] for w in weights.keys() & words(t)) for t in texts.to_pylist()]
            return (1 / (1 + np.exp(-np.array(z, float)))).tolist()

        return score

    return with_text_column(docs, into, "double", start)
