"""Nearest neighbours by vantage-point trees, one per shard.

Vectors are dealt into shards of bounded size by a hash of their id. A shard becomes a tree: a vantage
point splits the others at their median distance to it, and so on down to leaves of ``leaf`` vectors.
Each child keeps the least and greatest distance to the vantage point of the node. A query goes down the
nearer child first; by the triangle inequality nothing in a child is nearer than the query's distance to
the child's ring. A child is left out if ``factor`` times that bound exceeds the k-th best distance so
far: factor 1 is the exact search, a larger one skips more.

All queries of a block go through a tree together, so distances are computed as matrix products.
Queries are cut into blocks of bounded size; each shard meets each block once, and sends back k rows per
query, of which the best k are kept.

Cases: vectors that are null, zero or empty, or hold null or non-finite components, take no part; all
others need one common length (an error says so); rows that share an id are queries and candidates each of
their own, and only the query's own row is no candidate; ties go to the smaller id, then to the row;
fewer than k candidates give fewer rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.common import written

SHARD_ROWS = 1 << 14
BLOCK_ROWS = 1 << 14
LEAF = 128
FOUND = "query_row long, query_id long, row long, vec_id long, score double"


class Node:
    __slots__ = ("vantage", "children", "rows")

    def __init__(self, rows: np.ndarray | None = None):
        self.rows, self.vantage, self.children = rows, None, []


class Tree:
    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF, seed: int = 7):
        self.vectors, self.ids, self.numbers, self.leaf = vectors, ids, rows, leaf
        self.squares = np.einsum("ij,ij->i", vectors, vectors)
        self.rng = np.random.default_rng(seed)
        self.root = self._node(np.arange(len(vectors)))

    def _node(self, rows: np.ndarray) -> Node:
        """Built with a stack, so that equal vectors cannot make it too deep."""
        root = Node()
        todo = [(root, rows)]
        while todo:
            node, rows = todo.pop()
            if len(rows) <= self.leaf:
                node.rows = rows
                continue
            node.vantage = self.vectors[self.rng.choice(rows)]
            distances = np.sqrt(((self.vectors[rows] - node.vantage) ** 2).sum(1))
            order = np.argsort(distances, kind="stable")
            for half in np.array_split(order, 2):  # by place, so ties never pile up on one side
                child = Node()
                node.children.append((distances[half[0]], distances[half[-1]], child))
                todo.append((child, rows[half]))
        return root

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float) -> "Best":
        best = Best(len(queries), k)
        squares = np.einsum("ij,ij->i", queries, queries)
        self._visit(self.root, np.arange(len(queries)), queries, squares, own, best, factor)
        return best

    def _visit(self, node, at, queries, squares, own, best, factor) -> None:
        if not len(at):
            return
        if node.rows is not None:
            self._leaf(node.rows, at, queries, squares, own, best)
            return
        to = np.sqrt(((queries[at] - node.vantage) ** 2).sum(1))
        bounds = [np.maximum(0, np.maximum(low - to, to - high)) for low, high, _ in node.children]
        first = bounds[0] <= bounds[1]
        # Both orders: queries nearer to the inner ring, then those nearer to the outer one.
        for side, group in ((0, first), (1, ~first)):
            for child in (side, 1 - side):
                # A hair of slack: distances are rounded, and ties have to be seen.
                open_to = factor * bounds[child][group] <= best.limit(at[group]) * (1 + 1e-12) + 1e-12
                self._visit(node.children[child][2], at[group][open_to], queries, squares, own, best, factor)

    def _leaf(self, rows, at, queries, squares, own, best) -> None:
        near = squares[at][:, None] + self.squares[rows] - 2 * (queries[at] @ self.vectors[rows].T)
        limit = best.limit(at)
        slack = 1e-9 * (squares[at][:, None] + self.squares[rows])
        q, r = np.nonzero((near <= limit[:, None] ** 2 + slack) & (own[at][:, None] != self.numbers[rows]))
        if len(q):
            exact = np.sqrt(((queries[at[q]] - self.vectors[rows[r]]) ** 2).sum(1))
            best.add(at[q], self.ids[rows[r]], self.numbers[rows[r]], exact)


class Best:
    """The k nearest so far of each query: smallest distance, then smallest id, then row."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.distances = np.full((n, k), np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)
        self.numbers = np.full((n, k), np.iinfo(np.int64).max)

    def limit(self, at: np.ndarray) -> np.ndarray:
        return self.distances[at, -1]

    def add(self, at: np.ndarray, ids: np.ndarray, numbers: np.ndarray, distances: np.ndarray) -> None:
        touched = np.unique(at)
        at = np.concatenate([np.repeat(touched, self.k), at])
        ids = np.concatenate([self.ids[touched].ravel(), ids])
        numbers = np.concatenate([self.numbers[touched].ravel(), numbers])
        distances = np.concatenate([self.distances[touched].ravel(), distances])
        order = np.lexsort((numbers, ids, distances, at))
        at, ids, numbers, distances = at[order], ids[order], numbers[order], distances[order]
        starts = np.flatnonzero(np.diff(at, prepend=-1))
        rank = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
        kept = rank < self.k
        self.distances[at[kept], rank[kept]] = distances[kept]
        self.ids[at[kept], rank[kept]] = ids[kept]
        self.numbers[at[kept], rank[kept]] = numbers[kept]


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vec of the rows that take part."""
    vec = F.col("embedding").cast("array<double>")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).dropna()
    return rows.where(~bad & F.exists("vec", lambda x: x != 0))


def nearest(
    vectors: DataFrame, is_query: F.Column, *, k: int = 10, factor: float = 1.0, shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS, leaf: int = LEAF,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row for which ``is_query`` holds."""
    rows = written(usable(vectors).withColumn("row", F.monotonically_increasing_id()), "vantage-vectors")
    seen = rows.agg(F.count(F.lit(1)), F.min(F.size("vec")), F.max(F.size("vec")), F.count_if(is_query)).first()
    if seen[1] != seen[2]:
        raise ValueError(f"vectors have {seen[1]} to {seen[2]} components")
    shards, blocks = max(1, math.ceil(seen[0] / shard_rows)), max(1, math.ceil(seen[3] / block_rows))
    deal = F.xxhash64("vec_id", "vec")  # rows of one id, or equal vectors, are spread too
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    candidates = rows.select("row", "vec_id", "vec", F.pmod(deal, F.lit(shards)).cast("int").alias("shard"), every)
    queries = rows.where(is_query).select("row", "vec_id", "vec", F.pmod(deal, F.lit(blocks)).cast("int").alias("block"))
    to = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    queries = queries.select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), F.col("vec").alias("asked"), to, "block")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({c: np.zeros(0, "float64" if c == "score" else "int64") for c in ("query_row", "query_id", "row", "vec_id", "score")})
        left, right = left.sort_values(["vec_id", "row"]), right.sort_values(["query_id", "query_row"])
        tree = Tree(np.stack(left["vec"].to_numpy()), left["vec_id"].to_numpy(), left["row"].to_numpy(), leaf)
        own = right["query_row"].to_numpy()
        best = tree.search(np.stack(right["asked"].to_numpy()), own, k, factor)
        found = np.isfinite(best.distances)
        times = found.sum(1)
        return pd.DataFrame({
            "query_row": np.repeat(own, times), "query_id": np.repeat(right["query_id"].to_numpy(), times),
            "row": best.numbers[found], "vec_id": best.ids[found], "score": best.distances[found],
        })

    parts = candidates.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block")).applyInPandas(search, FOUND)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy("score", "vec_id", "row")).alias("rank")
    return parts.select("query_id", rank, "vec_id", "score").where(F.col("rank") <= k)
