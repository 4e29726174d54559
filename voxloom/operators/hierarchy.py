"""Clusters of a density hierarchy, read off a spanning tree without holding the tree in one place.

The tree's edges are cut into ranges of weight. What lighter ranges connect is contracted, by halving:
the lighter half of the ranges is joined to components, the heavier half is renamed to them, and both
halves go on by themselves. Then every range is a small problem of its own: a task joins its edges in
order of weight and reports

- for each node it sees, the cluster it is in, or that it is still too small and goes on as part of the
  component named by its smallest member, in the next range where that name occurs;
- for each cluster its share of the stability, and the cluster it splits off from.

Clusters are named by where they end (their lowest component with the minimum size). A name may stand
for a component of a lighter range; names are followed by pointer jumping. The best choice of clusters
is a maximum over a tree: leaves report to their parents, and runs of clusters that wait for one child
only are shortened to half in each round, so the number of rounds is logarithmic even for a long run.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.operators.spanning import components
from voxloom.session import cut_round

RANGE = 1 << 17  # edges meant for one range of weights
KEY = 42  # bits of a node's number; the range stands above them
FEW = 1 << 17  # so many clusters are chosen from inside one task
NONE = -(1 << 62)  # no cluster: what never reaches the minimum size


# ---- ranges of weight --------------------------------------------------------------------------------
def ranges_of(edges: DataFrame) -> tuple[DataFrame, int]:
    """edges plus range; equal weights share one."""
    n = edges.count()
    parts = max(1, math.ceil(n / RANGE))
    if parts == 1:
        return edges.withColumn("range", F.lit(0)), 1
    cuts = edges.agg(F.percentile_approx("w", [k / parts for k in range(1, parts)], 100 * parts)).first()[0]
    cuts = sorted(set(cuts))
    sent = edges.sparkSession.sparkContext.broadcast(np.array(cuts))  # one number per range

    def place(batches):
        for batch in batches:
            yield batch.assign(range=np.searchsorted(sent.value, batch["w"].to_numpy(), "left"))

    return edges.mapInPandas(place, "a long, b long, w double, range int"), len(cuts) + 1


def contracted(edges: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """edges a, b, w, range between the components of lighter ranges, and nodes range, id, size.

    sizes: id, size of all nodes. A component is named by its smallest member.
    """
    edges, parts = ranges_of(edges)
    edges = cut_round(edges.withColumn("group", F.lit(0)))
    nodes = sizes.select(F.lit(0).alias("group"), "id", "size")
    width = 1 << max(0, math.ceil(math.log2(parts)))
    key = lambda column: F.shiftleft(F.col("group").cast("long"), KEY).bitwiseOR(F.col(column)).alias(column)
    while width > 1:
        half = width // 2
        upper = F.col("range") >= F.col("group") + half
        light = edges.where(~upper).select(key("a").alias("u"), key("b").alias("v"))
        joined = components(light).select(
            F.shiftright("id", KEY).cast("int").alias("group"), F.col("id").bitwiseAND(F.lit((1 << KEY) - 1)).alias("id"),
            F.col("component").bitwiseAND(F.lit((1 << KEY) - 1)).alias("to"),
        )
        joined = cut_round(joined)
        heavy = edges.where(upper)
        for end in ("a", "b"):
            renamed = joined.select("group", F.col("id").alias(end), F.col("to").alias("_to"))
            heavy = heavy.join(renamed, ["group", end], "left").withColumn(end, F.coalesce("_to", end)).drop("_to")
        summed = nodes.join(joined, ["group", "id"], "left").groupBy("group", F.coalesce("to", "id").alias("id")).agg(F.sum("size").alias("size"))
        later = F.col("group") + half
        edges = cut_round(edges.where(~upper).unionByName(heavy.where("a <> b").withColumn("group", later)))
        nodes = nodes.unionByName(summed.withColumn("group", later))
        used = edges.select("group", F.col("a").alias("id")).unionByName(edges.select("group", F.col("b").alias("id"))).distinct()
        nodes = cut_round(nodes.join(used, ["group", "id"], "left_semi"))
        width = half
    return edges.select("a", "b", "w", "range"), nodes.select(F.col("group").alias("range"), "id", "size")


# ---- one range -----------------------------------------------------------------------------------------
FOUND = "kind string, node long, name long, value double"


def code(range_: int, node: int) -> int:
    """The name that a node of a range has as a cluster of its own."""
    return (range_ << KEY) | node


def read_range(
    range_: int, ids: list[int], size: list[int], single: list[bool], edges: pd.DataFrame, least: int, finest: float
) -> pd.DataFrame:
    """What the edges of a range say about its nodes; single: a point, not a component of lighter ranges.

    Rows (kind, node, name, value): "in" (a node is in a cluster), "up" (a node goes on in the component
    called ``name``), "root" (a component with the label ``node`` is a cluster when the range ends),
    "split" (cluster ``name`` splits off from cluster ``node``) and "share" (of a cluster's stability).
    """
    place = {i: k for k, i in enumerate(ids)}
    above, total, low, single = list(range(len(ids))), list(size), list(ids), list(single)
    name = [code(range_, i) if n >= least else None for i, n in zip(ids, size)]
    small = [[k] if name[k] is None else [] for k in range(len(ids))]
    rows: list[tuple] = []
    share: dict[int, float] = {}
    parts = 0

    def top(k: int) -> int:
        while above[k] != k:
            above[k] = above[above[k]]
            k = above[k]
        return k

    def join(root: int, kids: list[int], w: float) -> None:
        nonlocal parts
        whole, lowest = sum(total[k] for k in kids), min(low[k] for k in kids)
        nodes = [s for k in kids for s in small[k]]
        own = None
        if whole >= least:
            # A single point that is joined at the least weight of all is never alone.
            large = [k for k in kids if name[k] is not None and not (single[k] and w <= finest)]
            nodes += [k for k in kids if name[k] is not None and single[k] and w <= finest]
            if len(large) == 1:
                own = name[large[0]]
            else:
                parts += 1
                own = -code(range_, parts)
                rows.extend(("split", own, name[k], 0.0) for k in large)
            share[own] = share.get(own, 0.0) + whole / w
            for k in large:
                share[name[k]] = share.get(name[k], 0.0) + (total[k] / finest if single[k] else 0.0) - total[k] / w
            rows.extend(("in", ids[s], own, 0.0) for s in nodes)
            nodes = []
        total[root], low[root], small[root], name[root], single[root] = whole, lowest, nodes, own, False

    edges = edges.sort_values("w", kind="stable")
    ends_a, ends_b, weights = edges["a"].tolist(), edges["b"].tolist(), edges["w"].tolist()
    at = 0
    while at < len(weights):
        w, joined = weights[at], {}
        while at < len(weights) and weights[at] == w:
            a, b = top(place[ends_a[at]]), top(place[ends_b[at]])
            at += 1
            if a == b:
                continue
            one, two = joined.pop(a, None) or [a], joined.pop(b, None) or [b]
            if len(one) < len(two):
                a, b, one, two = b, a, two, one
            above[b] = a
            one.extend(two)
            joined[a] = one
        for root, kids in joined.items():
            join(root, kids, w)
    for k in range(len(ids)):
        if above[k] == k:
            rows.extend(("up", ids[s], low[k], 0.0) for s in small[k])
            if name[k] is not None:
                rows.append(("root", low[k], name[k], 0.0))
    rows.extend(("share", 0, c, value) for c, value in share.items())
    return pd.DataFrame(rows, columns=["kind", "node", "name", "value"])


# ---- all ranges ------------------------------------------------------------------------------------------
def read_ranges(edges: DataFrame, sizes: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """What all ranges say (range, kind, node, name, value), and the nodes each sees (range, id, next).

    ``next`` is the next range in which a component of that name occurs, null if there is none.
    """
    edges, nodes = contracted(edges, sizes)
    order = Window.partitionBy("id").orderBy("range")
    nodes = nodes.withColumns({"next": F.lead("range").over(order), "single": F.lag("range").over(order).isNull()})
    nodes = cut_round(nodes)
    finest = edges.agg(F.min("w")).first()[0]

    def read(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = (left[c].tolist() for c in ("id", "size", "single"))
        return read_range(int(key[0]), *columns, right, least, finest).assign(range=int(key[0]))

    found = nodes.groupBy("range").cogroup(edges.groupBy("range")).applyInPandas(read, f"{FOUND}, range int")
    return cut_round(found), nodes.select("range", "id", "next")


def pointers(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """code, to: where each node, and each name of a component, leads in the end; names without row are final."""
    named = lambda range_, node: F.shiftleft(F.col(range_).cast("long"), KEY).bitwiseOR(F.col(node))
    inside = found.where("kind = 'in'").select(named("range", "node").alias("code"), F.col("name").alias("to"))
    later = nodes.select("range", F.col("id").alias("label"), "next")
    up = found.where("kind = 'up'").withColumnRenamed("name", "label").join(later, ["range", "label"])
    up = up.select(named("range", "node").alias("code"), F.coalesce(named("next", "label"), F.lit(NONE)).alias("to"))
    root = found.where("kind = 'root'").withColumnRenamed("node", "label").join(later, ["range", "label"])
    root = root.where("next is not null").select(named("next", "label").alias("code"), F.col("name").alias("to"))
    held = cut_round(inside.unionByName(up).unionByName(root))
    while True:
        step = held.select(F.col("code").alias("to"), F.col("to").alias("further"))
        moved = held.where("to >= 0").join(step, "to").select("code", F.col("further").alias("now"))
        moved = cut_round(moved)
        if moved.isEmpty():
            return held
        held = cut_round(held.join(moved, "code", "left").select("code", F.coalesce("now", "to").alias("to")))


def clusters_of(found: DataFrame, nodes: DataFrame, leads: DataFrame) -> DataFrame:
    """c, parent (null: the root), s (stability)."""
    final = leads.select(F.col("code").alias("name"), F.col("to").alias("_to"))
    ended = lambda rows: rows.join(final, "name", "left").withColumn("name", F.coalesce("_to", "name")).drop("_to")
    s = ended(found.where("kind = 'share'").select("name", "value")).groupBy(F.col("name").alias("c")).agg(F.sum("value").alias("s"))
    split = ended(found.where("kind = 'split'").select("name", F.col("node").alias("parent")))
    return s.join(split.select(F.col("name").alias("c"), "parent"), "c", "left")


# ---- the choice --------------------------------------------------------------------------------------------
def best_values(clusters: DataFrame) -> DataFrame:
    """clusters plus val: the larger of the own stability and the sum of val over the children.

    A cluster that waits for one child x has val = max(a, b + x); of two such in a row the upper one can
    wait for what the lower one waits for.
    """
    null = lambda kind: F.lit(None).cast(kind)
    state = clusters.select("c", "parent", "s", null("double").alias("val"), null("double").alias("a"), null("double").alias("b"), null("long").alias("dep"))
    while True:
        waits = F.col("val").isNull()
        kids = state.where("parent is not null").groupBy(F.col("parent").alias("c")).agg(
            F.coalesce(F.sum("val"), F.lit(0.0)).alias("got"), F.sum(waits.cast("int")).alias("open"), F.max(F.when(waits, F.col("c"))).alias("last")
        )
        state = state.join(kids, "c", "left")
        fresh = waits & F.col("dep").isNull()
        one = fresh & (F.col("open") == 1)
        state = state.select(
            "c", "parent", "s",
            F.when(fresh & (F.coalesce("open", F.lit(0)) == 0), F.greatest("s", F.coalesce("got", F.lit(0.0)))).otherwise(F.col("val")).alias("val"),
            F.when(one, F.col("s")).otherwise(F.col("a")).alias("a"), F.when(one, F.col("got")).otherwise(F.col("b")).alias("b"),
            F.when(one, F.col("last")).otherwise(F.col("dep")).alias("dep"),
        )
        state = cut_round(state)
        below = state.select(F.col("c").alias("dep"), F.col("val").alias("x"), F.col("a").alias("xa"), F.col("b").alias("xb"), F.col("dep").alias("xdep"))
        state = state.join(below, "dep", "left")
        on = F.col("val").isNull() & F.col("x").isNull() & F.col("xdep").isNotNull()
        state = state.select(
            "c", "parent", "s", F.coalesce("val", F.greatest("a", F.col("b") + F.col("x"))).alias("val0"), F.col("x"),
            F.when(on, F.greatest(F.col("a"), F.col("b") + F.col("xa"))).otherwise(F.col("a")).alias("a"),
            F.when(on, F.col("b") + F.col("xb")).otherwise(F.col("b")).alias("b"),
            F.when(on, F.col("xdep")).otherwise(F.col("dep")).alias("dep"), F.col("val").alias("had"),
        )
        # greatest() skips nulls: without x there is no value yet.
        val = F.coalesce("had", F.when(F.col("x").isNotNull(), F.col("val0")))
        state = cut_round(state.withColumn("val", val).select("c", "parent", "s", "val", "a", "b", "dep"))
        if state.where("val is null").isEmpty():
            return state.select("c", "parent", "s", "val")


def choose(clusters: pd.DataFrame) -> pd.DataFrame:
    """``chosen`` inside one task."""
    names, s = clusters["c"].to_numpy(), clusters["s"].tolist()
    place = {c: k for k, c in enumerate(names.tolist())}
    inner = clusters["parent"].notna().tolist()
    up = [place.get(int(p), -1) if there else -1 for p, there in zip(clusters["parent"], inner)]
    order, kids = [], [[] for _ in up]
    for k, p in enumerate(up):
        (kids[p] if p >= 0 else order).append(k)
    for k in order:  # grows: parents come before their children
        order.extend(kids[k])
    below, best = [0.0] * len(up), [None] * len(up)
    for k in reversed(order):
        if up[k] >= 0:
            below[up[k]] += max(s[k], below[k])
    for k in order:
        best[k] = best[up[k]] if up[k] >= 0 else None
        if best[k] is None and inner[k] and s[k] >= below[k]:
            best[k] = int(names[k])
    return pd.DataFrame({"c": names, "best": pd.array(best, "Int64")})


def chosen(clusters: DataFrame) -> DataFrame:
    """c, best: the topmost cluster above (or itself) that is at least as stable as the best choice below it.

    The root is never taken; best is null where there is none. Few clusters are read by one task, more in rounds.
    """
    clusters = cut_round(clusters)
    if clusters.count() <= FEW:
        def few(batches):
            batches = list(batches)
            if batches:
                yield choose(pd.concat(batches))

        rows = clusters.select("c", F.col("parent").cast("string").alias("parent"), "s")  # numbers would lose digits beside nulls
        return cut_round(rows.coalesce(1).mapInPandas(few, "c long, best long"))
    valued = best_values(clusters)
    below = valued.where("parent is not null").groupBy(F.col("parent").alias("c")).agg(F.sum("val").alias("below"))
    taken = F.col("parent").isNotNull() & (F.col("s") >= F.coalesce("below", F.lit(0.0)))
    state = valued.join(below, "c", "left").select("c", F.col("parent").alias("up"), F.when(taken, F.col("c")).alias("best"))
    state = cut_round(state)
    while not state.where("up is not null").isEmpty():
        step = state.select(F.col("c").alias("up"), F.col("up").alias("_up"), F.col("best").alias("_best"))
        moved = state.join(step, "up", "left")
        state = cut_round(moved.select("c", F.col("_up").alias("up"), F.coalesce("_best", "best").alias("best")))
    return state.select("c", "best")


def cluster_of_points(edges: DataFrame, sizes: DataFrame, least: int) -> DataFrame:
    """id, cluster (a number without meaning, null is noise) of all points; edges a, b, w span them.

    sizes: id, size. All weights of the edges are levels of the hierarchy.
    """
    found, nodes = read_ranges(edges, sizes, least)
    leads = pointers(found, nodes)
    best = chosen(clusters_of(found, nodes, leads))
    first = nodes.groupBy("id").agg(F.min("range").alias("range"))
    first = first.select("id", F.shiftleft(F.col("range").cast("long"), KEY).bitwiseOR(F.col("id")).alias("code"))
    ends = first.join(leads, "code", "left").select("id", F.coalesce("to", "code").alias("c"))
    return ends.join(best, "c", "left").select("id", F.col("best").alias("cluster"))
