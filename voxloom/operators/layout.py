"""Non-linear reduction: neighbour graph, fuzzy union of its memberships, layout by negative sampling.

The method is that of uniform manifold approximation (McInnes, Healy, Melville 2018). Vectors are scaled to
unit length, so distance is one minus the cosine; equal ones are one point. Positions start at the
principal components. In rounds, space is cut along turned axes into blocks; each block moves its points
for some epochs in one task, along its own edges (an edge belongs to one point that has it, so a point
brings at most as many as it has neighbours) and away from a bounded sample of all points. Other ends
outside the block stand still for the round; blocks are cut anew for the next one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.operators.arrays import unit
from voxloom.operators.neighbours import neighbour_graph
from voxloom.operators.reduction import reduced
from voxloom.operators.spanning import CELLS, SAMPLE, Cells, matrix, numbered
from voxloom.session import cut_lineage
from voxloom.settings import Settings

BLOCK = 4096  # points meant for one block
EPOCHS = 200
ROUNDS = 10
AWAY = 5  # points of the sample from which a point is pushed away for each edge drawn
PUSHERS = 8192
STEP = 4.0  # longest step along an axis


def curve(min_dist: float) -> tuple[float, float]:
    """a, b of 1 / (1 + a x^(2b)) nearest to: 1 up to min_dist, then falling exponentially. Gauss-Newton."""
    x = np.linspace(0, 3, 300)[1:]
    wanted = np.where(x < min_dist, 1.0, np.exp(min_dist - x))
    a, b = 1.5, 0.9
    for _ in range(50):
        power = x ** (2 * b)
        y = 1 / (1 + a * power)
        slopes = np.stack([-(y**2) * power, -(y**2) * a * power * 2 * np.log(x)], 1)
        step = np.linalg.lstsq(slopes, wanted - y, rcond=None)[0]
        a, b = a + step[0], b + step[1]
    return a, b


def bandwidths(d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row of distances (infinite: none) the nearest positive one, and the width at which
    memberships add up to log2(k)."""
    rho = np.where(d > 0, d, np.inf).min(1)
    rho[~np.isfinite(rho)] = 0.0
    gap = np.maximum(d - rho[:, None], 0.0)
    low, high, sigma = np.zeros(len(d)), np.full(len(d), np.inf), np.ones(len(d))
    for _ in range(64):
        much = np.exp(-gap / sigma[:, None]).sum(1) > math.log2(k)
        high, low = np.where(much, sigma, high), np.where(much, low, sigma)
        sigma = np.where(np.isfinite(high), (low + high) / 2, sigma * 2)
    known = np.isfinite(d)
    mean = np.where(known, d, 0).sum(1) / np.maximum(known.sum(1), 1)
    return rho, np.maximum(sigma, np.maximum(1e-3 * mean, 1e-12))


def fuzzy_union(near: DataFrame, k: int) -> DataFrame:
    """a, b, w: every pair of neighbours once, at a point that has the other, with the union of both memberships."""

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            sizes = batch["near"].map(len).to_numpy()
            inside = np.arange(sizes.max()) < sizes[:, None]
            d = np.full(inside.shape, np.inf)
            d[inside] = [e["d"] for near in batch["near"] for e in near]
            rho, sigma = bandwidths(d, max(k, 2))
            w = np.exp(-np.maximum(d - rho[:, None], 0.0) / sigma[:, None])
            others = [e["other"] for near in batch["near"] for e in near]
            yield pd.DataFrame({"id": np.repeat(batch["id"].to_numpy(), sizes), "other": others, "w": w[inside]})

    rows = near.mapInPandas(weigh, "id long, other long, w double")
    pair = [F.least("id", "other").alias("lo"), F.greatest("id", "other").alias("hi")]
    both = rows.groupBy(*pair).agg(F.sum("w").alias("sum"), (F.min("w") * F.max("w")).alias("product"), F.count("*").alias("n"), F.min("id").alias("a"))
    other = F.when(F.col("a") == F.col("lo"), F.col("hi")).otherwise(F.col("lo")).alias("b")
    return both.select("a", other, (F.col("sum") - F.when(F.col("n") > 1, F.col("product")).otherwise(0.0)).alias("w")).where("w > 0")


def moved(at: np.ndarray, free: int, a: np.ndarray, b: np.ndarray, share: np.ndarray, far: np.ndarray, inner: float, epochs: range, curve_ab: tuple[float, float], rng: np.random.Generator) -> np.ndarray:
    """Positions after some epochs; rows from ``free`` on stand still.

    Points are pushed away from points of the block with a chance of ``inner``, else from those in ``far``.
    """
    at = at.copy()
    ca, cb = curve_ab
    tails, heads, share = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([share, share])

    def step(rows: np.ndarray, slopes: np.ndarray, rate: float) -> None:
        inside = rows < free
        rows, slopes = rows[inside], np.clip(slopes[inside], -STEP, STEP)
        for axis in range(at.shape[1]):
            total = np.bincount(rows, slopes[:, axis], free)
            at[:free, axis] += rate * np.clip(total, -STEP, STEP)

    for epoch in epochs:
        rate = 1 - epoch / EPOCHS
        drawn = np.flatnonzero(rng.random(len(share)) < share)
        rng.shuffle(drawn)
        # About one edge of each point at a time, so that their pulls do not add up to too long a step.
        for part in np.array_split(drawn, max(1, math.ceil(len(drawn) / max(free, 1)))):
            tail, head = tails[part], heads[part]
            gap = at[tail] - at[head]
            square = (gap**2).sum(1)
            with np.errstate(divide="ignore", invalid="ignore"):
                pull = np.where(square > 0, -2 * ca * cb * square ** (cb - 1) / (1 + ca * square**cb), 0.0)[:, None] * gap
            step(tail, pull, rate)
            step(head, -pull, rate)
            tail = np.repeat(tail[tail < free], AWAY)
            pushers = at[rng.integers(0, free, len(tail))]
            if len(far):
                away = rng.random(len(tail)) >= inner
                pushers[away] = far[rng.integers(0, len(far), away.sum())]
            gap = at[tail] - pushers
            square = (gap**2).sum(1)
            push = np.where(square > 0, 2 * cb / ((0.001 + square) * (1 + ca * square**cb)), 0.0)[:, None] * gap
            step(tail, push, rate)
    return at


def placed_links(edges: DataFrame, blocks: DataFrame) -> DataFrame:
    """a, b, w of the edges plus own, the block of a, and to, the position of b if that is in another block.

    A block has its own points, so only positions outside of it travel, and the block of a is joined first.
    """
    owned = edges.join(blocks.select(F.col("id").alias("a"), F.col("block").alias("own")), "a")
    links = owned.join(blocks.select(F.col("id").alias("b"), F.col("vec").alias("to"), F.col("block").alias("there")), "b")
    return links.select("a", "b", "w", "own", F.when(F.col("there") != F.col("own"), F.col("to")).alias("to"))


def one_round(placed: DataFrame, edges: DataFrame, n: int, top: float, number: int, ab: tuple[float, float], seed: int) -> DataFrame:
    """placed (id, vec) after the epochs of one round."""
    spark = placed.sparkSession
    n_blocks = min(CELLS, math.ceil(n / BLOCK))
    want = max(PUSHERS, 2 * SAMPLE * n_blocks)  # at most 2 * SAMPLE * CELLS positions
    chosen = F.pmod(F.xxhash64("id", F.lit(seed + number)), F.lit(1 << 40)) <= int((1 << 40) * min(1.0, want / n))
    sample = matrix(placed.where(chosen).limit(2 * want).toPandas().sort_values("id")["vec"])
    turn = np.linalg.qr(np.random.default_rng(seed + number).normal(size=(sample.shape[1], sample.shape[1])))[0]
    cells, pushers = Cells(sample @ turn, n_blocks), sample[:: max(1, len(sample) // PUSHERS)]
    sent = spark.sparkContext.broadcast((turn, cells, pushers, cells.of(pushers @ turn)))
    epochs = range(number * EPOCHS // ROUNDS, (number + 1) * EPOCHS // ROUNDS)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn, cells = sent.value[:2]
        for batch in batches:
            if len(batch):
                yield batch.assign(block=cells.of(matrix(batch["vec"]) @ turn).astype(np.int32))

    def move(key, points: pd.DataFrame, links: pd.DataFrame) -> pd.DataFrame:
        points = points.sort_values("id")
        ids, at, free = points["id"].to_numpy(), matrix(points["vec"]), len(points)
        links = links.sort_values(["a", "b"])
        a, end = np.searchsorted(ids, links["a"].to_numpy()), links["b"].to_numpy()
        b = np.minimum(np.searchsorted(ids, end), free - 1)
        outside = np.flatnonzero(ids[b] != end)
        b[outside] = free + np.arange(len(outside))
        if len(outside):
            at = np.concatenate([at, matrix(links["to"].iloc[outside])])
        rng = np.random.default_rng([seed, number, key[0]])
        far = sent.value[2][sent.value[3] != key[0]]
        at = moved(at, free, a, b, links["w"].to_numpy() / top, far, free / n, epochs, ab, rng)
        return pd.DataFrame({"id": ids, "vec": list(at[:free])})

    blocks = cut_lineage(placed.mapInPandas(deal, "id long, vec array<double>, block int"))
    links = placed_links(edges, blocks)
    after = blocks.groupBy("block").cogroup(links.groupBy("own")).applyInPandas(move, "id long, vec array<double>")
    after = cut_lineage(after)
    sent.destroy()
    return after


def layout(vectors: DataFrame, neighbours: int, settings: Settings) -> DataFrame:
    """row_id, vec ARRAY<DOUBLE>: positions in ``layout_components`` dimensions.

    vectors: row_id, vec of one length, no nulls. Rows with vectors of one direction get one position. Two
    different directions have no shape to lay out: they get their principal components; a single one is 0.
    """
    rows = unit(vectors.select("row_id", F.col("vec").cast("array<double>").alias("vec")))
    points = numbered(rows.select("vec").distinct())
    n = points.count()
    small = Settings(pca_components=settings.layout_components)
    if n < 2:
        return rows.select("row_id", F.array_repeat(F.lit(0.0), settings.layout_components).alias("vec"))
    if n < 3:
        return reduced(rows, n, small)
    k = min(neighbours - 1, n - 1)  # the point itself counts as one of its neighbours
    edges = cut_lineage(fuzzy_union(neighbour_graph(points, n, k, settings.seed), neighbours))
    start = reduced(points.select(F.col("id").alias("row_id"), "vec"), n, small).withColumnRenamed("row_id", "id")
    start = cut_lineage(start)
    far = start.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x))))).first()[0] or 1.0
    # Equal projections of different vectors would never part: a hair of a shift for each.
    shift = lambda at: (F.pmod(F.xxhash64("id", at), F.lit(1000)) - 500) / F.lit(5e6)
    placed = start.select("id", F.transform("vec", lambda x, at: x * F.lit(10.0 / far) + shift(at)).alias("vec"))
    top = edges.agg(F.max("w")).first()[0]
    ab = curve(settings.layout_min_dist)
    for number in range(ROUNDS):
        placed = one_round(placed, edges, n, top, number, ab, settings.seed)
    named = points.select("id", F.col("vec").alias("of")).join(placed, "id").select("of", "vec")
    return rows.select("row_id", F.col("vec").alias("of")).join(named, "of").select("row_id", "vec")
