"""Approximate nearest neighbours of every point: a forest of sorted hash codes, then NN-descent.

Each tree gives every point a code, one bit per random hyperplane through the mean. Sorted by code, points
are cut into chunks, and inside a chunk the nearest are found exactly. Spark sorts by ranges, so no chunk
grows with the data, and equal codes are told apart by id. Then, in rounds, some of the neighbours of a
point (those it has, and those that have it) are compared with each other, and whoever finds a nearer one
keeps it; rounds end when distances hardly fall any more. The number of neighbours compared in a round
is bounded by the method; no neighbour found is given up for another but a nearer one.

Distances are half of the squared Euclidean ones: for vectors of unit length one minus the cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.operators.spanning import matrix
from voxloom.session import cut_lineage

CHUNK = 2048  # points compared with each other in a tree
TREES = 4
BITS = 48
COMPARED = 8  # of the neighbours of a point, and of those that have it as one, in each round
ROUNDS = 8
SETTLED = 0.002  # rounds end when the distances fall by a smaller share
NEAR = "id long, near array<struct<d:double,other:long>>"
PAIRS = "id long, d double, other long"


def half_squares(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row by row, so that a pair has one distance wherever it is met."""
    return ((left - right) ** 2).sum(-1) / 2


def nearest_inside(vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and distances of each row's k nearest other rows."""
    squares = np.einsum("ij,ij->i", vectors, vectors)
    rough = squares[:, None] + squares - 2 * vectors @ vectors.T
    np.fill_diagonal(rough, np.inf)
    at = np.argpartition(rough, k - 1, axis=1)[:, :k]
    return at, np.stack([half_squares(vectors, vectors[at[:, j]]) for j in range(k)], 1)


def tree(points: DataFrame, mean: np.ndarray, k: int, seed: int) -> DataFrame:
    """id, d, other: the k nearest inside the point's chunk."""
    planes = np.random.default_rng(seed).normal(size=(len(mean), BITS))  # made again in each task from the seed's array
    chunk = max(CHUNK, k + 1)

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                bits = (matrix(batch["vec"]) - mean) @ planes > 0
                yield batch.assign(code=bits @ (1 << np.arange(BITS, dtype=np.int64)))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for start in range(0, len(batch), chunk):
                held.append(batch.iloc[start : start + chunk])
                size += len(held[-1])
                while size >= 2 * chunk:  # what is left is never too small to find k
                    rows = pd.concat(held)
                    held, size = [rows.iloc[chunk:]], size - chunk
                    yield found(rows.iloc[:chunk])
        if size > 1:
            yield found(pd.concat(held))

    def found(rows: pd.DataFrame) -> pd.DataFrame:
        ids, vectors = rows["id"].to_numpy(), matrix(rows["vec"])
        at, d = nearest_inside(vectors, min(k, len(ids) - 1))
        return pd.DataFrame({"id": np.repeat(ids, at.shape[1]), "d": d.ravel(), "other": ids[at].ravel()})

    coded = points.select("id", "vec").mapInPandas(code, "id long, vec array<double>, code long")
    ordered = coded.repartitionByRange("code", "id").sortWithinPartitions("code", "id")
    return ordered.select("id", "vec").mapInPandas(search, PAIRS)


def best(rows: DataFrame, k: int) -> DataFrame:
    """id, near: the k nearest of all different ones in the rows (id, d, other), nearest first."""
    # Each task sends on at most k different neighbours of a point.
    place = F.dense_rank().over(Window.partitionBy("id").orderBy("d", "other"))
    kept = rows.withColumn("place", place).where(F.col("place") <= k)
    return kept.groupBy("id").agg(F.array_sort(F.collect_set(F.struct("d", "other"))).alias("near"))


def descended(points: DataFrame, near: DataFrame, k: int, width: int, seed: int) -> DataFrame:
    """id, near after comparing neighbours of one point with each other."""
    mixed = F.xxhash64("center", "member", F.lit(seed))
    ends = near.select("id", F.explode("near.other").alias("other"))
    sides = []
    for center, member in (("id", "other"), ("other", "id")):
        side = ends.select(F.col(center).alias("center"), F.col(member).alias("member"))
        place = F.row_number().over(Window.partitionBy("center").orderBy(mixed, "member"))
        sides.append(side.withColumn("place", place).where(F.col("place") <= COMPARED).drop("place"))
    meets = sides[0].unionByName(sides[1]).unionByName(near.select(F.col("id").alias("center"), F.col("id").alias("member"))).distinct()
    limit = F.when(F.size("near") >= k, F.element_at("near", -1)["d"]).otherwise(F.lit(float("inf")))
    held = points.select("id", "vec").join(near.select("id", limit.alias("limit")), "id")
    met = meets.join(held.withColumnRenamed("id", "member"), "member").select("center", "member", "limit", "vec")
    met = met.repartition("center").sortWithinPartitions("center", "member")  # at most 2 * COMPARED + 1 of a center

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # rows of the last center of a batch: more of them may follow
        for batch in batches:
            rows = columns(batch)
            if rest is not None:
                rows = [np.concatenate(pair) for pair in zip(rest, rows)]
            cut = np.searchsorted(rows[0], rows[0][-1]) if len(rows[0]) else 0
            rest = [r[cut:] for r in rows]
            yield from nearer(*(r[:cut] for r in rows))
        if rest is not None:
            yield from nearer(*rest)

    def columns(batch: pa.RecordBatch) -> list[np.ndarray]:
        vectors = batch.column(3).flatten().to_numpy()
        plain = [batch.column(c).to_numpy() for c in range(3)]
        return [*plain, vectors.reshape(len(plain[0]), -1 if len(plain[0]) else width)]

    def nearer(center: np.ndarray, member: np.ndarray, limit: np.ndarray, vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = []
        starts = np.flatnonzero(np.diff(center, prepend=center[:1] - 1))
        for start, stop in zip(starts, np.append(starts[1:], len(center))):
            some, ids = vectors[start:stop], member[start:stop]
            d = half_squares(some[:, None], some[None])
            near = d < limit[start:stop, None]
            np.fill_diagonal(near, False)
            row, other = np.nonzero(near)
            found.append((ids[row], d[row, other], ids[other]))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], ["id", "d", "other"])

    known = near.select("id", F.explode("near").alias("e")).select("id", "e.d", "e.other")
    return best(known.unionByName(met.mapInArrow(compare, PAIRS)), k)


def neighbour_graph(points: DataFrame, n: int, k: int, seed: int) -> DataFrame:
    """id, near ARRAY<STRUCT<d, other>>: up to k other points near every point, nearest first.

    points: id, vec ARRAY<DOUBLE> of one length, n rows with unique ids. A single point has no row.
    """
    k = min(k, n - 1)
    if k < 1:
        return points.sparkSession.createDataFrame([], NEAR)
    mean = points.agg(Summarizer.mean(array_to_vector("vec")).alias("m")).first()["m"].toArray()
    near = tree(points, mean, k, seed)
    for number in range(1, TREES):
        near = near.unionByName(tree(points, mean, k, seed + number))
    near = cut_lineage(best(near, k))
    total = F.sum(F.aggregate("near.d", F.lit(0.0), lambda a, x: a + x) / F.size("near")).alias("total")
    before = near.agg(total).first()["total"]
    for number in range(ROUNDS):
        near = cut_lineage(descended(points, near, k, len(mean), seed + number))
        now = near.agg(total).first()["total"]
        if before - now <= SETTLED * before:
            break
        before = now
    return near
