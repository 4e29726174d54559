"""Minimum spanning tree under mutual reachability, over cells of space, exact and without a cap.

Weighted points are dealt to the cells of a k-d tree made from a bounded sample. Core distances come
from a search in the point's own cell and in those other cells that its ball reaches. The tree grows by
lightest exits (Borůvka): inside a cell as long as no point outside can be nearer, then over all cells,
where a point is only sent to cells that could hold a lighter exit than its component already knows.
Inside a cell, leaves of about a hundred points with bounding boxes are searched nearest first.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxloom.session import cut_lineage, cut_round

CELL = 4096  # points meant for one cell
CELLS = 1 << 14  # at most so many cells: their boxes are broadcast
SAMPLE = 16  # sampled points for each cell
LEAF = 128
FEW = 1 << 21  # so many edges are joined to components inside one task
SMALL = 1 << 17  # a table of components with at most so many rows (two numbers each) is broadcast
POINT = "id long, weight long, vec array<double>, cell int"


# ---- inside one task -----------------------------------------------------------------------------------
def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Axis by axis in one order, so that both directions give the same value."""
    total, gap = np.zeros((len(left), len(right))), np.empty((len(left), len(right)))
    for one, two in zip(np.ascontiguousarray(left.T), np.ascontiguousarray(right.T)):
        np.subtract(one[:, None], two[None], out=gap)
        total += np.multiply(gap, gap, out=gap)
    return np.sqrt(total, out=total)


def box_distances(lo: np.ndarray, hi: np.ndarray, los: np.ndarray, his: np.ndarray) -> np.ndarray:
    """Least distances from one box (or point) to many; a hair less, so that rounding never hides a point."""
    gap = np.maximum(np.maximum(los - hi, lo - his), 0.0)
    return np.sqrt((gap**2).sum(-1)) * (1 - 1e-9)


class Leaves:
    """Points in leaves of a k-d tree with their bounding boxes."""

    def __init__(self, vectors: np.ndarray):
        self.rows: list[np.ndarray] = []
        left = [np.arange(len(vectors))] if len(vectors) else []
        while left:
            rows = left.pop()
            if len(rows) <= LEAF:
                self.rows.append(rows)
                continue
            some = vectors[rows]
            rows = rows[np.argpartition(some[:, np.argmax(np.ptp(some, axis=0))], len(rows) // 2)]
            left += [rows[: len(rows) // 2], rows[len(rows) // 2 :]]
        self.vectors = [vectors[r] for r in self.rows]
        width = vectors.shape[1] if vectors.ndim == 2 else 1
        self.lo = np.array([v.min(0) for v in self.vectors]).reshape(-1, width)
        self.hi = np.array([v.max(0) for v in self.vectors]).reshape(-1, width)


def nearest_weights(asked: Leaves, limit: np.ndarray, there: Leaves, weight: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """For each asked point the distances and weights of its up to ``reach`` nearest within ``limit``."""
    n = sum(len(r) for r in asked.rows)
    out_d, out_w = np.full((n, reach), np.inf), np.zeros((n, reach), np.int64)
    for rows, vectors, lo, hi in zip(asked.rows, asked.vectors, asked.lo, asked.hi):
        least = box_distances(lo, hi, there.lo, there.hi)
        best_d, best_w, bound = out_d[rows], out_w[rows], limit[rows]
        for leaf in np.argsort(least, kind="stable"):
            if least[leaf] > bound.max():
                break
            d = distances(vectors, there.vectors[leaf])
            d[d > bound[:, None]] = np.inf
            at = np.flatnonzero(np.isfinite(d).any(1))  # only those who gain a neighbour sort theirs anew
            if not len(at):
                continue
            d = np.concatenate([best_d[at], d[at]], 1)
            w = np.concatenate([best_w[at], np.broadcast_to(weight[there.rows[leaf]], (len(at), len(there.rows[leaf])))], 1)
            if d.shape[1] > 4 * reach:
                few = np.argpartition(d, reach - 1, axis=1)[:, :reach]
                d, w = np.take_along_axis(d, few, 1), np.take_along_axis(w, few, 1)
            order = np.argsort(d, axis=1, kind="stable")[:, :reach]
            best_d[at], best_w[at] = np.take_along_axis(d, order, 1), np.take_along_axis(w, order, 1)
            bound[at] = np.minimum(bound[at], reached(best_d[at], best_w[at], reach))
        out_d[rows], out_w[rows] = best_d, best_w
    return out_d, out_w


def reached(d: np.ndarray, w: np.ndarray, reach: int) -> np.ndarray:
    """The distance at which the weights add up to ``reach``; infinite if they do not."""
    enough = np.where(np.isfinite(d), w, 0).cumsum(1) >= reach
    return np.where(enough.any(1), d[np.arange(len(d)), enough.argmax(1)], np.inf)


class Exits:
    """The lightest edge found so far that leaves each component."""

    def __init__(self, n: int):
        self.w, self.a, self.b = np.full(n, np.inf), np.full(n, -1), np.full(n, -1)

    def search(
        self, asked: Leaves, core: np.ndarray, comp: np.ndarray, there: Leaves, core_there: np.ndarray, comp_there: np.ndarray, known: np.ndarray
    ) -> None:
        """Components are numbers below n on the asked side, and the same numbers (or -1) on the other.

        ``known``: no exit of an asked point is lighter than this (its core distance at first). It is raised by what is
        found and holds as long as components only grow, so that a point is looked at again only if it could still matter.
        """
        low = np.array([core_there[r].min() for r in there.rows])
        single = np.array([comp_there[r[0]] if (comp_there[r] == comp_there[r[0]]).all() else -2 for r in there.rows])
        for leaf in np.argsort([known[r].min() for r in asked.rows], kind="stable"):
            rows, vectors, lo, hi = asked.rows[leaf], asked.vectors[leaf], asked.lo[leaf], asked.hi[leaf]
            open_ = known[rows] < self.w[comp[rows]]
            if not open_.any():
                continue
            if not open_.all():
                rows, vectors = rows[open_], vectors[open_]
                lo, hi = vectors.min(0), vectors.max(0)
            own, nearest, rest = comp[rows], np.full(len(rows), np.inf), np.inf
            least = np.maximum(np.maximum(box_distances(lo, hi, there.lo, there.hi), low), core[rows].min())
            only = own[0] if (own == own[0]).all() else None
            for leaf in np.argsort(least, kind="stable"):
                if least[leaf] >= self.w[own].max():
                    rest = least[leaf]
                    break
                if only is not None and single[leaf] == only:
                    continue
                to = there.rows[leaf]
                w = np.maximum(np.maximum(distances(vectors, there.vectors[leaf]), core_there[to][None]), core[rows][:, None])
                w[own[:, None] == comp_there[to][None]] = np.inf
                at = w.argmin(1)
                found = w[np.arange(len(rows)), at]
                nearest = np.minimum(nearest, found)
                lighter = np.flatnonzero(found < self.w[own])[::-1]
                lighter = lighter[np.argsort(-found[lighter], kind="stable")]  # the lightest of a component is written last
                self.w[own[lighter]], self.a[own[lighter]], self.b[own[lighter]] = found[lighter], rows[lighter], to[at[lighter]]
            known[rows] = np.maximum(known[rows], np.minimum(nearest, rest))


def merged(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of every node's connected component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def inner_tree(vectors: np.ndarray, core: np.ndarray, border: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Edges (a, b, w) that are sure from inside the cell, and each point's component.

    ``border``: no point outside is nearer than this. An exit is sure if it is no heavier than anything
    that could leave its component across the border.
    """
    leaves, n = Leaves(vectors), len(vectors)
    outside, known = np.maximum(border, core), core.copy()
    comp, edges = np.arange(n), []
    while True:
        low = np.full(n, np.inf)
        np.minimum.at(low, comp, outside)
        found = Exits(n)
        found.w = np.nextafter(low, np.inf)  # nothing heavier is looked for
        found.search(leaves, core, comp, leaves, core, comp, known)
        sure = np.flatnonzero((found.a >= 0) & (found.w <= low))
        if not len(sure):
            break
        edges.append((found.a[sure], found.b[sure], found.w[sure]))
        label = merged(n, comp[found.a[sure]], comp[found.b[sure]])
        comp = label[comp]
    a, b, w = (np.concatenate(x) if x else np.zeros(0) for x in (zip(*edges) if edges else ((), (), ())))
    return a.astype(np.int64), b.astype(np.int64), w, comp


# ---- cells of space ------------------------------------------------------------------------------------
class Cells:
    """A balanced k-d tree over a sample; every point of space belongs to one cell."""

    def __init__(self, sample: np.ndarray, n_cells: int):
        self.depth = max(0, math.ceil(math.log2(max(n_cells, 1))))
        width = sample.shape[1]
        self.axis, self.at = np.zeros(1 << self.depth, np.int64), np.zeros(1 << self.depth)
        self.lo = np.full((2 << self.depth, width), -np.inf)
        self.hi = np.full((2 << self.depth, width), np.inf)
        held = {1: np.arange(len(sample))}
        for node in range(1, 1 << self.depth):
            rows = held.pop(node)
            some = sample[rows]
            axis = int(np.argmax(np.ptp(some, axis=0))) if len(rows) else 0
            cut = float(np.median(some[:, axis])) if len(rows) else 0.0
            self.axis[node], self.at[node] = axis, cut
            for kid, part in ((2 * node, rows[some[:, axis] < cut]), (2 * node + 1, rows[some[:, axis] >= cut])):
                held[kid] = part
                self.lo[kid], self.hi[kid] = self.lo[node], self.hi[node]
            self.hi[2 * node, axis] = self.lo[2 * node + 1, axis] = cut
        self.lo, self.hi = self.lo[1 << self.depth :], self.hi[1 << self.depth :]

    def of(self, vectors: np.ndarray) -> np.ndarray:
        node = np.ones(len(vectors), np.int64)
        for _ in range(self.depth):
            node = 2 * node + (vectors[np.arange(len(vectors)), self.axis[node]] >= self.at[node])
        return node - (1 << self.depth)


def matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64) if len(column) else np.zeros((0, 1))


def numbered(rows: DataFrame) -> DataFrame:
    """rows plus ``id``: 0, 1, ... without a gap, numbered inside the partitions."""
    held = cut_lineage(rows.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = held.groupBy(part.alias("_part")).count()  # a row per partition
    before = F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    joined = held.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return cut_lineage(joined.withColumn("id", F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at", "_part", "_start"))


def dealt(points: DataFrame, seed: int) -> tuple[DataFrame, Cells, int]:
    """points (id, weight, vec) plus their cell."""
    n = points.count()
    n_cells = min(CELLS, math.ceil(n / CELL))
    share = min(1.0, SAMPLE * n_cells / max(n, 1))
    few = points.select("vec") if n_cells == 1 else points.select("vec").sample(share, seed)
    sample = matrix(few.limit(2 * SAMPLE * n_cells).toPandas()["vec"])  # at most 2 * SAMPLE * CELLS vectors
    cells = Cells(sample, n_cells)
    sent = points.sparkSession.sparkContext.broadcast(cells)  # at most CELLS cuts

    def deal(batches):
        for batch in batches:
            vectors = matrix(batch["vec"])
            yield batch.assign(cell=sent.value.of(vectors).astype(np.int32) if len(batch) else batch["id"].astype(np.int32))

    return cut_round(points.select("id", "weight", "vec").mapInPandas(deal, POINT)), cells, n


def boxes_of(points: DataFrame, *lows) -> pd.DataFrame:
    """cell, lo, hi and further aggregates of every cell that holds points: at most CELLS rows."""
    width = points.select(F.size("vec")).first()[0]
    lo = F.array(*[F.min(F.col("vec")[k]) for k in range(width)]).alias("lo")
    hi = F.array(*[F.max(F.col("vec")[k]) for k in range(width)]).alias("hi")
    return points.groupBy("cell").agg(lo, hi, *lows).orderBy("cell").toPandas()


def parts_of(spark: SparkSession) -> int:
    return 4 * spark.sparkContext.defaultParallelism


def by_cell(rows: DataFrame, cell: str = "cell"):
    """rows grouped by cell. Cells hold about as many points each and are dealt in turn, not by a hash that crowds some tasks."""
    return rows.repartitionById(parts_of(rows.sparkSession), cell).groupBy(cell)


# ---- core distances --------------------------------------------------------------------------------------
def core_distances(points: DataFrame, reach: int) -> DataFrame:
    """points plus core: the distance at which ``reach`` comments are reached, the point's own first."""
    boxes = boxes_of(points)
    number, lo, hi = boxes["cell"].to_numpy(), matrix(boxes["lo"]), matrix(boxes["hi"])
    sent = points.sparkSession.sparkContext.broadcast((number, lo, hi))
    found = "id long, to int, vec array<double>, bound double, d array<double>, w array<long>"

    def entries(ids, cells, vectors, bounds, d, w):
        return pd.DataFrame({"id": ids, "to": cells, "vec": list(vectors), "bound": bounds, "d": list(d), "w": list(w)})

    def inside(rows: pd.DataFrame) -> pd.DataFrame:
        """A row of own neighbours per point (to = -1), and one for each other cell its ball reaches."""
        number, lo, hi = sent.value
        vectors = matrix(rows["vec"])
        leaves = Leaves(vectors)
        d, w = nearest_weights(leaves, np.full(len(rows), np.inf), leaves, rows["weight"].to_numpy(), reach)
        bound, ids = reached(d, w, reach), rows["id"].to_numpy()
        out = [entries(ids, np.full(len(ids), -1), [[]] * len(ids), bound, *kept(d, w))]
        for at in leaves.rows:
            near = np.flatnonzero(box_distances(vectors[at].min(0), vectors[at].max(0), lo, hi) <= bound[at].max())
            for k in near[number[near] != rows["cell"].iloc[0]]:
                asks = at[box_distances(vectors[at], vectors[at], lo[k], hi[k]) <= bound[at]]
                if len(asks):
                    out.append(entries(ids[asks], np.full(len(asks), number[k]), vectors[asks], bound[asks], [[]] * len(asks), [[]] * len(asks)))
        return pd.concat(out)

    def kept(d, w):
        return [x[np.isfinite(x)] for x in d], [x[np.isfinite(y)] for x, y in zip(w, d)]

    def other(there: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if there.empty or asks.empty:
            return pd.DataFrame({"id": [], "d": [], "w": []}, dtype=object)
        asked = Leaves(matrix(asks["vec"]))
        d, w = nearest_weights(asked, asks["bound"].to_numpy(), Leaves(matrix(there["vec"])), there["weight"].to_numpy(), reach)
        d, w = kept(d, w)
        return pd.DataFrame({"id": asks["id"].to_numpy(), "d": d, "w": w})

    own = cut_round(by_cell(points).applyInPandas(inside, found))
    more = by_cell(points).cogroup(by_cell(own.where("to >= 0"), "to")).applyInPandas(other, "id long, d array<double>, w array<long>")
    lists = own.where("to < 0").select("id", "d", "w").unionByName(more).select("id", F.arrays_zip("d", "w").alias("e"))
    every = F.array_sort(F.flatten(F.collect_list("e")))
    step = lambda s, e: F.when(s["n"] < reach, F.struct((s["n"] + e["w"]).alias("n"), e["d"].alias("core"))).otherwise(s)
    core = F.aggregate(every, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("core")), step)["core"]
    return cut_round(points.join(lists.groupBy("id").agg(core.alias("core")), "id"))


# ---- spanning tree ---------------------------------------------------------------------------------------
EDGES = "a long, b long, w double"


def spanning_tree(points: DataFrame, cells: Cells) -> DataFrame:
    """a, b, w of a minimum spanning tree of points (id, vec, cell, core).

    Between equal weights any edge may be taken, even one too many: which points are connected at a
    given weight stays the same.
    """
    spark = points.sparkSession
    sent = spark.sparkContext.broadcast((cells.lo, cells.hi))

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        lo, hi = (x[rows["cell"].iloc[0]] for x in sent.value)
        vectors, ids = matrix(rows["vec"]), rows["id"].to_numpy()
        border = np.minimum(vectors - lo, hi - vectors).min(1)
        a, b, w, comp = inner_tree(vectors, rows["core"].to_numpy(), border)
        a, b = ids[a], ids[b]
        edges = pd.DataFrame({"id": -1, "comp": -1, "a": np.minimum(a, b), "b": np.maximum(a, b), "w": w})
        low = pd.Series(ids).groupby(comp).transform("min").to_numpy()
        return pd.concat([pd.DataFrame({"id": ids, "comp": low, "a": -1, "b": -1, "w": 0.0}), edges])

    grown = cut_round(by_cell(points).applyInPandas(grow, "id long, comp long, a long, b long, w double"))
    tree = [grown.where("id < 0").select("a", "b", "w")]
    points = points.join(grown.where("id >= 0").select("id", "comp"), "id")
    points = cut_round(points.repartitionById(parts_of(spark), "cell").sortWithinPartitions("cell"))
    while not points.agg(F.min("comp") == F.max("comp")).first()[0]:
        edges = cut_round(lightest_exits(points))
        tree.append(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "w"))
        joined = components(edges.select(F.col("comp_a").alias("u"), F.col("comp_b").alias("v")))
        joined = joined.select(F.col("id").alias("comp"), "component")
        moved = points.join(F.broadcast(joined) if edges.count() <= SMALL // 2 else joined, "comp", "left")
        points = cut_round(moved.withColumn("comp", F.coalesce("component", "comp")).drop("component"))
    out = tree[0]
    for part in tree[1:]:
        out = out.unionByName(part)
    return out.distinct()


def lightest_exits(points: DataFrame) -> DataFrame:
    """For every component an edge of least weight that leaves it: a, b, w, comp_a, comp_b."""
    spark = points.sparkSession
    schema = "comp_a long, w double, a long, b long, comp_b long"

    def best(found: Exits, comps, ids, comp, ids_there, comp_there) -> pd.DataFrame:
        got = np.flatnonzero(found.a >= 0)
        a, b = found.a[got], found.b[got]
        return pd.DataFrame({"comp_a": comps[got], "w": found.w[got], "a": ids[a], "b": ids_there[b], "comp_b": comp_there[b]})

    def inside(rows: pd.DataFrame) -> pd.DataFrame:
        comps, comp = np.unique(rows["comp"].to_numpy(), return_inverse=True)
        leaves, core, ids = Leaves(matrix(rows["vec"])), rows["core"].to_numpy(), rows["id"].to_numpy()
        found = Exits(len(comps))
        if len(comps) > 1:
            found.search(leaves, core, comp, leaves, core, comp, core.copy())
        return best(found, comps, ids, comp, ids, comps[comp])

    lightest = lambda rows: rows.groupBy("comp_a").agg(F.min(F.struct("w", "a", "b", "comp_b")).alias("e")).select("comp_a", "e.*")
    near = cut_round(lightest(by_cell(points).applyInPandas(inside, schema)))
    boxes = boxes_of(points, F.min("core").alias("core"), F.min("comp").alias("one"), F.max("comp").alias("two"))
    # Components that fill their cells alone know no exit yet: one to a point of another cell is a bound.
    known = cut_round(near.unionByName(bounds_of_whole_cells(points, near)))
    bounds = known.select(F.col("comp_a").alias("comp"), F.col("w").alias("bound"))
    # Most points can be in one component: a broadcast leaves them where they are, in order of their cells.
    bounded = points.join(F.broadcast(bounds) if known.count() <= SMALL else bounds, "comp", "left")
    sent = spark.sparkContext.broadcast((
        boxes["cell"].to_numpy(), matrix(boxes["lo"]), matrix(boxes["hi"]), boxes["core"].to_numpy(),
        np.where(boxes["one"] == boxes["two"], boxes["one"], -1),
    ))

    def ask(batches):
        number, lo, hi, low, one = sent.value
        for batch in batches:
            vectors, core = matrix(batch["vec"]), batch["core"].to_numpy()
            comp, bound, cell = batch["comp"].to_numpy(), batch["bound"].fillna(np.inf).to_numpy(), batch["cell"].to_numpy()
            rows, to = [], []
            for own in np.unique(cell):
                asked = np.flatnonzero((cell == own) & (core < bound))
                if not len(asked):
                    continue
                near = np.maximum(box_distances(vectors[asked].min(0), vectors[asked].max(0), lo, hi), low) < bound[asked].max()
                for k in np.flatnonzero(near & (number != own)):
                    least = np.maximum(box_distances(vectors[asked], vectors[asked], lo[k], hi[k]), low[k])
                    at = asked[(least < bound[asked]) & (comp[asked] != one[k])]
                    rows.append(at)
                    to.append(np.full(len(at), number[k]))
            at = np.concatenate(rows) if rows else np.zeros(0, int)
            yield batch.iloc[at].assign(to=np.concatenate(to) if to else at)

    asks = bounded.select("id", "vec", "core", "comp", "cell", "bound").mapInPandas(
        ask, "id long, vec array<double>, core double, comp long, cell int, bound double, to int"
    )

    def other(there: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if there.empty or asks.empty:
            return pd.DataFrame({c.split()[0]: [] for c in schema.split(", ")}, dtype=object)
        comps, comp = np.unique(asks["comp"].to_numpy(), return_inverse=True)
        place = np.minimum(np.searchsorted(comps, there["comp"].to_numpy()), len(comps) - 1)
        same = np.where(comps[place] == there["comp"].to_numpy(), place, -1)
        found = Exits(len(comps))
        found.w = np.full(len(comps), np.inf)
        np.minimum.at(found.w, comp, asks["bound"].fillna(np.inf).to_numpy())
        core = asks["core"].to_numpy()
        found.search(Leaves(matrix(asks["vec"])), core, comp, Leaves(matrix(there["vec"])), there["core"].to_numpy(), same, core.copy())
        return best(found, comps, asks["id"].to_numpy(), comp, there["id"].to_numpy(), there["comp"].to_numpy())

    far = by_cell(points).cogroup(by_cell(asks, "to")).applyInPandas(other, schema)
    return lightest(known.unionByName(far))


def bounds_of_whole_cells(points: DataFrame, near: DataFrame) -> DataFrame:
    """An exit, not always the lightest, for components that see no other one in their own cells.

    Such a component has its cells to itself, so there are at most CELLS of them.
    """
    ones = points.groupBy("cell", "comp").agg(F.min(F.struct("core", "id", "vec")).alias("p")).select("cell", "comp", "p.*")
    held = ones.groupBy("cell").agg(F.min(F.struct("core", "id", "comp", "vec")).alias("p")).select("p.*").toPandas()  # one row per cell
    sent = points.sparkSession.sparkContext.broadcast((matrix(held["vec"]), *(held[c].to_numpy() for c in ("core", "id", "comp"))))

    def pair(batches):
        vectors, core, ids, comps = sent.value
        for batch in batches:
            if batch.empty:
                continue
            w = np.maximum(np.maximum(distances(matrix(batch["vec"]), vectors), core[None]), batch["core"].to_numpy()[:, None])
            w[batch["comp"].to_numpy()[:, None] == comps[None]] = np.inf
            at = w.argmin(1)
            out = pd.DataFrame({"comp_a": batch["comp"].to_numpy(), "w": w[np.arange(len(at)), at], "a": batch["id"].to_numpy(), "b": ids[at], "comp_b": comps[at]})
            yield out[np.isfinite(out["w"])]

    alone = ones.join(near.select(F.col("comp_a").alias("comp")), "comp", "left_anti").select("id", "vec", "core", "comp")
    found = alone.mapInPandas(pair, "comp_a long, w double, a long, b long, comp_b long")
    return found.groupBy("comp_a").agg(F.min(F.struct("w", "a", "b", "comp_b")).alias("e")).select("comp_a", "e.*")


def components(edges: DataFrame) -> DataFrame:
    """id, component (its smallest id) for all ids of edges u, v, in rounds of stars to the smallest neighbour.

    Each round links the larger neighbours of a node to the smallest node it knows, then its smaller
    ones, by a minimum per key and a join, until nothing moves. When few edges are left, one task ends the work.
    """
    both = lambda rows: rows.unionByName(rows.select(F.col("v").alias("u"), F.col("u").alias("v")))
    tidy = lambda rows: rows.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def few(batches):
        rows = pd.concat([pd.DataFrame({"u": [], "v": []}, dtype=np.int64), *batches])
        ids, ends = np.unique(rows[["u", "v"]].to_numpy(), return_inverse=True)
        ends = ends.reshape(-1, 2)
        yield pd.DataFrame({"id": ids, "component": ids[merged(len(ids), ends[:, 0], ends[:, 1])]})

    held, last = cut_round(tidy(edges)), None
    while True:
        digest = F.xxhash64("u", "v")
        now = held.agg(F.count("*"), F.bit_xor(digest), F.sum(F.shiftright(digest, 24))).first()
        if now[0] <= FEW:
            return held.coalesce(1).mapInPandas(few, "id long, component long")
        if now == last:
            break
        last = now
        lows = both(held).groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        up = both(held).where("v > u").join(lows, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        held = tidy(up.unionByName(lows.select("u", F.col("m").alias("v"))))
        lows = held.groupBy("u").agg(F.min("v").alias("m"))
        down = held.join(lows, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        held = cut_round(tidy(down.unionByName(lows.select("u", F.col("m").alias("v")))))
    roots = held.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return held.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
